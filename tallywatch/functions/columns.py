"""Small SQL expressions shared by checks, rules and reports.

Expressions are SQL text: one call hands Spark a whole expression, where the Column
API needs a call to the JVM for each operator in it.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable

MINUTE_US = 60_000_000
HOUR_US = 60 * MINUTE_US
DAY_US = 24 * HOUR_US


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def timestamp(at: dt.datetime | None = None) -> str:
    """A fixed point in time, or the start of the query when none is given."""
    if at is None:
        return "current_timestamp()"
    at = at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)
    micros = round((at - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) / dt.timedelta(microseconds=1))
    return f"timestamp_micros({micros})"


def missing(name: str, is_text: bool = True) -> str:
    """NULL or, for text, the empty string."""
    return f"({name} IS NULL OR {name} = '')" if is_text else f"({name} IS NULL)"


def listed(values: Iterable[str]) -> str:
    return ", ".join(quoted(v) for v in values)


def lookup(values: dict[str, str], key: str) -> str:
    """A small constant map as an expression; NULL for keys it lacks."""
    return f"CASE {key} " + " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in values.items()) + " END"


def pick(values: Iterable[str], index: str) -> str:
    """The value at a zero-based position of a constant list."""
    return f"get(array({listed(values)}), CAST({index} AS INT))"


def text(*parts: str) -> str:
    """The expressions joined as text; constants come ``quoted``."""
    return f"concat({', '.join(parts)})"


def padded(prefix: str, number: str, width: int) -> str:
    """``prefix`` and the number, zero-filled to at least ``width`` digits."""
    digits = f"CAST({number} AS STRING)"
    return text(quoted(prefix), f"lpad({digits}, greatest(length({digits}), {width}), '0')")


def phrase(pattern: str, plain: dict[str, object], values: dict[str, str]) -> str:
    """The pattern as text: braces of ``plain`` filled in now, those of ``values`` by expressions."""
    parts = re.split(r"\{(\w+)\}", pattern)
    pieces = [(p, True) if i % 2 == 0 else (str(plain[p]), True) if p in plain else (values[p], False) for i, p in enumerate(parts)]
    joined: list[tuple[str, bool]] = []
    for piece, fixed in pieces:
        if fixed and joined and joined[-1][1]:
            piece = joined.pop()[0] + piece
        joined.append((piece, fixed))
    return text(*(quoted(p) if fixed else p for p, fixed in joined if p))


def cents(amount: str) -> str:
    """A decimal amount as whole cents, half up; NULL beyond 64 bits."""
    return f"try_cast(CAST({amount} AS DECIMAL(38,2)) * 100 AS BIGINT)"


def money_text(amount: str) -> str:
    """An amount with two decimals, half up, as wide as the type allows."""
    return f"CAST(CAST({amount} AS DECIMAL(38,2)) AS STRING)"


def tenths_text(value: str) -> str:
    """A number with one decimal; very large ones as they are."""
    return f"coalesce(CAST(try_cast({value} AS DECIMAL(18,1)) AS STRING), CAST({value} AS STRING))"


def mean_text(total: str, n: str, fallback: str) -> str:
    """Mean of ``n`` amounts summing to ``total``, with two decimals, half up; the
    fallback where the total is beyond its type."""
    twice = f"(CAST(CAST({total} AS DECIMAL(38,2)) * 100 AS DECIMAL(38,0)) * 2 + {n})"
    whole = f"CAST(({twice} - {twice} % ({n} * 2)) / ({n} * 2) AS DECIMAL(38,0))"
    return f"coalesce(CAST(CAST({whole} / 100 AS DECIMAL(38,2)) AS STRING), CAST({fallback} AS STRING))"


def rounded_minutes(gap_us: str) -> str:
    """Microseconds to whole minutes, an exact half going to the even minute."""
    whole, rest, half = f"({gap_us} div {MINUTE_US})", f"({gap_us} % {MINUTE_US})", MINUTE_US // 2
    return f"({whole} + CASE WHEN {rest} > {half} OR ({rest} = {half} AND {whole} % 2 = 1) THEN 1 ELSE 0 END)"


def whole_minutes(gap_us: str) -> str:
    """Microseconds to whole minutes, cut off."""
    return f"({gap_us} div {MINUTE_US})"
