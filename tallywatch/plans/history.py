"""Each customer's transactions in time order, with what the rules need from them.

Everything comes from one exchange on the customer and one sort. A count over the
last few minutes is a difference of running totals: every transaction enters the
ordered history once at its own time and once, as a narrow expiry mark, when it
leaves the window. Unlike a sliding frame or a self-join, its cost does not depend
on how many transactions share a window.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.config import HotKeyPolicy, RuleLimits
from tallywatch.functions import moments
from tallywatch.functions.columns import MINUTE_US
from tallywatch.plans.hot import Split, find_split

# Kinds of entries, in their order at equal times: the transaction itself, its exit
# from the velocity window, a failure's exit from the failure window, and from the
# failure window of the rows that exit there.
ROW, OUT_OF_VELOCITY, OUT_OF_FAILURES, OUT_TWICE = 0, 1, 2, 3

IS_ROW = f"kind = {ROW}"
HERE = "struct(key, ingest_seq, transaction_id, country, status)"
FAILURE = f"CAST({IS_ROW} AND coalesce(status = 'failed', false) AS BIGINT)"

BLOCK_BEFORE = "(PARTITION BY customer_id ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
BLOCK_AFTER = "(PARTITION BY customer_id ORDER BY block DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def _is(kind: int) -> str:
    return f"CAST(kind = {kind} AS BIGINT)"


def _marks(limits: RuleLimits, velocity: bool, windowed: bool) -> str:
    """The entries of one transaction, as rows of (kind, key)."""
    at, step = "unix_micros(transaction_ts)", limits.failure_minutes * MINUTE_US

    def mark(kind: int, later: int) -> str:
        return f"named_struct('kind', {kind}, 'key', {at} + {later}L)"

    always = [mark(ROW, 0)] + ([mark(OUT_OF_VELOCITY, limits.velocity_minutes * MINUTE_US)] if velocity else [])
    if not windowed:
        return f"inline(array({', '.join(always)}))"
    failed = [mark(OUT_OF_FAILURES, step), mark(OUT_TWICE, 2 * step)]
    return (f"inline(CASE WHEN status = 'failed' THEN array({', '.join(always + failed)})"
            f" ELSE array({', '.join(always)}) END)")


def split_for(tx: DataFrame, policy: HotKeyPolicy | None = None, limits: RuleLimits = RuleLimits(),
              at_most: int | None = None) -> Split | None:
    """The split of hot customers for these transactions; ``at_most`` rows, if known."""
    return find_split(tx, lambda rows: rows.selectExpr("customer_id", "ingest_seq", _marks(limits, True, True)),
                      policy or HotKeyPolicy(), at_most)


@dataclass(frozen=True)
class History:
    """An ordered history under construction. Input rows must be clean."""

    rows: DataFrame
    limits: RuleLimits
    split: Split | None
    marked: bool  # does it still hold expiry marks?
    pending: tuple[str, ...] = ()  # columns to compute together

    @property
    def df(self) -> DataFrame:
        return self.rows.selectExpr("*", *self.pending) if self.pending else self.rows

    # -- windows ---------------------------------------------------------------
    @property
    def _by(self) -> str:
        return f"PARTITION BY customer_id{', block' if self.split else ''}"

    @property
    def _in_order(self) -> str:
        return f"{self._by} ORDER BY key, kind, ingest_seq"

    @property
    def _up_to(self) -> str:
        return f"({self._in_order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

    @property
    def _before(self) -> str:
        return f"({self._in_order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

    @property
    def _with_peers(self) -> str:
        return f"({self._by} ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"

    def _carried(self, name: str, default: str = "NULL") -> str:
        """A value from other blocks of the customer; the default when there are none."""
        return f"coalesce({name}, {default})" if self.split else default

    def _and(self, *columns: str) -> History:
        """Add columns next to the pending ones: same window, same pass."""
        return replace(self, pending=self.pending + columns)

    def _then(self, *columns: str) -> History:
        """Add columns that read pending ones."""
        return replace(self, rows=self.df, pending=columns)

    def _total(self, name: str, measure: str) -> str:
        """Running total in row order, the current row included."""
        return f"(sum({measure}) OVER {self._up_to} + {self._carried(f'c_{name}', '0L')})"

    def _total_with_peers(self, name: str, measure: str) -> str:
        """Running total including all peers, also those in later blocks."""
        total = f"sum({measure}) OVER {self._with_peers}"
        if not self.split:
            return f"({total})"
        later = f"CASE WHEN key = _next_key THEN {self._carried(f't_{name}', '0L')} ELSE 0L END"
        return f"({total} + {self._carried(f'c_{name}', '0L')} + {later})"

    # -- steps -----------------------------------------------------------------
    def add_velocity(self) -> History:
        """``n_velocity``: transactions in the last minutes, peers included;
        ``n_velocity_seq``: the same without later peers."""
        row = _is(ROW)
        return self._and(
            f"{self._total('gone', _is(OUT_OF_VELOCITY))} AS _gone", f"{self._total('rows', row)} AS _nth",
        )._then(
            f"{self._total_with_peers('rows', row)} - _gone AS n_velocity", "_nth - _gone AS n_velocity_seq",
        )

    def add_failure_windows(self) -> History:
        """``n_failures``: failures in the last minutes, on failed rows;
        ``n_clusters``: how many of the failures in the last minutes reached the
        limit at their own time, on successful rows."""
        out, limit = _is(OUT_OF_FAILURES), self.limits.min_failures
        h = self._and(
            f"{self._total('out', out)} AS _out", f"{self._total('out_twice', _is(OUT_TWICE))} AS _out_twice",
        )._then(
            f"CASE WHEN {FAILURE} = 1 THEN {self._total_with_peers('failures', FAILURE)} - _out END AS n_failures",
            # The same count, seen again at the time the failure leaves the window.
            f"CASE WHEN {out} = 1 THEN {self._total_with_peers('out', out)} - _out_twice END AS _n_left",
        )._then(
            f"CAST(coalesce(n_failures >= {limit}, false) AS BIGINT) AS _reached",
            f"CAST(coalesce(_n_left >= {limit}, false) AS BIGINT) AS _left",
        )
        h = h._with_cluster_carry()
        return h._then(f"{h._total('left', '_left')} AS _all_left")._then(
            f"CASE WHEN {IS_ROW} AND status = 'success' THEN {h._total_with_peers('reached', '_reached')} - _all_left END"
            " AS n_clusters")

    def rows_only(self) -> History:
        return replace(self, rows=self.df.where(IS_ROW), marked=False, pending=()) if self.marked else self

    def add_neighbours(self) -> History:
        """``prev`` and ``next``: the customer's transaction before and after."""
        return self._and(
            *[f"coalesce({f}({HERE}) OVER ({self._in_order}), {self._carried(c)}) AS {name}" if self.split
              else f"{f}({HERE}) OVER ({self._in_order}) AS {name}"
              for f, c, name in (("lag", "c_prev", "prev"), ("lead", "c_next", "next"))])

    def add_baseline(self) -> History:
        """``n_prior`` and the totals of ``moments`` over strictly earlier rows, and the row's own digits."""
        w = self._before

        def total(measure: str, name: str) -> str:
            return f"coalesce({measure} OVER {w}, 0L) + {self._carried(f'c_{name}', '0L')} AS {name}"

        measured = replace(self, rows=moments.measured(self.df), pending=())
        return measured._and(f"count(amount) OVER {w} + {self._carried('c_n', '0L')} AS {moments.N}",
                             *[total(f"sum({x})", name) for name, x in moments.TOTALS.items()])

    def add_failure_runs(self) -> History:
        """``run_size``: length of the run of adjacent failures a failed row is in;
        ``follows_run`` and ``follows_us``: on a success right after a run, the run's
        length and the time since its last failure. Needs neighbours."""
        step, follow = (m * MINUTE_US for m in (self.limits.failure_minutes, self.limits.success_minutes))

        def apart(other: str, gap: str) -> str:
            return f"NOT coalesce({other}.status = 'failed' AND {gap} <= {step}, false)"

        h = self._and(f"{self._total('failures', FAILURE)} AS _nth_failure")._then(
            f"CASE WHEN status = 'failed' AND {apart('prev', 'key - prev.key')} THEN _nth_failure END AS _first",
            f"CASE WHEN status = 'failed' AND {apart('next', 'next.key - key')} THEN _nth_failure END AS _last",
        )._with_run_carry()
        after = f"status = 'success' AND prev.status = 'failed' AND key - prev.key <= {follow}"
        return h._then(
            f"coalesce(max(_first) OVER {h._up_to}, {h._carried('r_first')}) AS _run_first",
            f"coalesce(_last, lead(_last) IGNORE NULLS OVER ({h._in_order}), {h._carried('r_last')}) AS _run_last",
        )._then(
            "CASE WHEN status = 'failed' THEN _run_last - _run_first + 1 END AS run_size",
            f"CASE WHEN {after} THEN _nth_failure - _run_first + 1 END AS follows_run",
            f"CASE WHEN {after} THEN key - prev.key END AS follows_us",
        )

    # -- values from other blocks ----------------------------------------------
    def _per_block(self, *measures: str, measured: bool = False) -> DataFrame:
        """One row per block of a hot customer: a few times max_blocks rows in all."""
        rows = self.df.where("block >= 0")
        return (moments.measured(rows) if measured else rows).groupBy("customer_id", "block").agg(*map(F.expr, measures))

    def _join_blocks(self, carried: DataFrame) -> History:
        joined = self.df.join(F.broadcast(carried), ["customer_id", "block"], "left")
        return replace(self, rows=joined, pending=())

    def _with_cluster_carry(self) -> History:
        if not self.split:
            return self
        totals, peers = {"reached": "_reached", "left": "_left"}, {"reached": "_reached"}
        per_block = self._per_block(*_sums(totals, peers))
        return self._join_blocks(_carry_totals(per_block, totals, peers).select(
            "customer_id", "block", "c_reached", "c_left", "t_reached"))

    def _with_run_carry(self) -> History:
        if not self.split:
            return self
        per_block = self._per_block("max(_first) AS _first", "min(_last) AS _last")
        return self._join_blocks(per_block.selectExpr(
            "customer_id", "block", f"max(_first) OVER {BLOCK_BEFORE} AS r_first", f"min(_last) OVER {BLOCK_AFTER} AS r_last"))

    def _with_base_carry(self) -> History:
        """Everything that follows from the entries alone, in one summary."""
        if not self.split:
            return self
        totals = {"rows": _is(ROW), "gone": _is(OUT_OF_VELOCITY), "failures": FAILURE,
                  "out": _is(OUT_OF_FAILURES), "out_twice": _is(OUT_TWICE)}
        peers = {n: totals[n] for n in ("rows", "failures", "out")}
        only_rows = f"FILTER (WHERE {IS_ROW})"
        per_block = self._per_block(
            *_sums(totals, peers),
            f"min({HERE}) {only_rows} AS _head", f"max({HERE}) {only_rows} AS _tail",
            f"count(amount) {only_rows} AS _n", *[f"coalesce(sum({x}) {only_rows}, 0L) AS _{name}" for name, x in moments.TOTALS.items()],
            measured=True,
        )
        before, sums = BLOCK_BEFORE, ["n", *moments.TOTALS]
        blocks = _carry_totals(per_block, totals, peers).selectExpr(
            "*",
            f"last(_tail, true) OVER {before} AS c_prev", f"last(_head, true) OVER {BLOCK_AFTER} AS c_next",
            *[f"coalesce(sum(_{name}) OVER {before}, 0L) AS c_{name}" for name in sums],
        )
        return self._join_blocks(blocks.selectExpr(
            "customer_id", "block", *[f"c_{n}" for n in totals], *[f"t_{n}" for n in peers],
            "c_prev", "c_next", *[f"c_{name}" for name in sums]))


def _sums(totals: dict[str, str], peers: dict[str, str]) -> list[str]:
    """Totals of a block, and of its rows at the very time the block starts."""
    return [
        "max(_start_key) AS _start_key", "max(_next_key) AS _next_key",
        *[f"sum({m}) AS _s_{n}" for n, m in totals.items()],
        *[f"coalesce(sum({m}) FILTER (WHERE key = _start_key), 0L) AS _h_{n}" for n, m in peers.items()],
    ]


def _carry_totals(per_block: DataFrame, totals: dict[str, str], peers: dict[str, str]) -> DataFrame:
    """``c_*``: totals of earlier blocks. ``t_*``: totals of the rows in later blocks
    that share the time at which the next block starts."""
    in_order = "(PARTITION BY customer_id ORDER BY block)"
    same_time = "(PARTITION BY customer_id, _start_key ORDER BY block DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    onward = per_block.selectExpr("*", *[f"sum(_h_{n}) OVER {same_time} AS _o_{n}" for n in peers])
    return onward.selectExpr(
        "*",
        *[f"coalesce(sum(_s_{n}) OVER {BLOCK_BEFORE}, 0L) AS c_{n}" for n in totals],
        *[f"CASE WHEN lead(_start_key) OVER {in_order} = _next_key THEN lead(_o_{n}) OVER {in_order} ELSE 0L END AS t_{n}"
          for n in peers],
    )


def start(tx: DataFrame, limits: RuleLimits = RuleLimits(), split: Split | None = None,
          velocity: bool = False, windowed: bool = False) -> History:
    """Put clean transactions in order; ask for the expiry marks the steps will need."""
    marked = velocity or windowed
    if marked:
        payload = [c for c in tx.columns if c not in ("customer_id", "ingest_seq")]
        entries = tx.selectExpr("*", _marks(limits, velocity, windowed)).selectExpr(
            "customer_id", "ingest_seq", "kind", "key", *[f"CASE WHEN {IS_ROW} THEN {c} END AS {c}" for c in payload])
    else:
        entries = tx.selectExpr("*", f"{ROW} AS kind", "unix_micros(transaction_ts) AS key")
    return History(split.assign(entries) if split else entries, limits, split, marked)._with_base_carry()
