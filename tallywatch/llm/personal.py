"""Personal data in texts: base patterns, and further spans chosen by boosted trees. DataFrame operations only.

Base spans are the matches of four patterns that pass a check each (email, ip, card, phone). Loose generators of high
recall propose further spans, which may overlap. Boosted trees score these by format and context; they learn from
proposals on base matches, good where the match passed its check and bad where it failed, of all documents: of four
fifths the trees, of the fifth that they don't learn from the threshold, for a precision of PRECISION. Proposals with equal features are
one row with their number; more such rows than COLLECTED stay on the executors, which add them up for each level of a tree.
A proposal is added if it reaches the threshold and touches no base match that passed, none of its own kind that failed, and no
number of a card's length that failed. Without both labels nothing is added.

Offsets are code points, ends exclusive. Null texts count as empty. Rows that repeat get the same result each.

The work stays close to linear in a text's length and matches, also where very many matches stand in a very long text: running
sums over matches go by groups of about the square root of their number, context is read from the parts between matches,
overlaps are found by bisection, and redacted texts are put together from pieces.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.llm.common import rowed, unrowed

KINDS = ("email", "ip", "card", "phone")
#: The base patterns, written so that Java's matcher neither recurses nor starts anew inside a run it has failed on.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?:@|\x20?[\[({](?:at|AT)[\])}]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[\[({](?:dot|DOT)[\])}]\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.|\[\.\])[0-9]++(?:\.|\[\.\])[0-9]++(?:\.|\[\.\])[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20._/-]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+|00|\()?[0-9][\x20()./0-9-]{5,20}[0-9](?![0-9A-Za-z])",
}
#: What a text must hold for a pattern to match.
NEEDS = {"email": r"@|[\[({](?:at|AT)[\])}]", "ip": "[0-9]", "card": "[0-9]{1}", "phone": "[0-9]"}
VALID = {
    "email": "true",
    "ip": "forall(split(s.hit, '[.]'), x -> case when length(ltrim('0', x)) > 3 then false else cast(concat('0', ltrim('0', x)) as int) <= 255 end)",
    "card": """case when length(regexp_replace(s.hit, '[ -]', '')) between 16 and 19 then aggregate(
        transform(split(reverse(regexp_replace(s.hit, '[ -]', '')), ''), (x, i) -> cast(concat('0', x) as int) * (1 + i % 2)),
        0, (a, x) -> a + x - if(x > 9, 9, 0)) % 10 = 0 else false end""",
    "phone": "length(regexp_replace(s.hit, '[^0-9]', '')) between 8 and 15",
}
CONTEXT = "(?i)mail|phone|tel|call|fax|mobile|contact|card|visa|pay|addr|host|server"
#: Features of a proposal c in a text, as SQL.
FEATURES = {
    "kind": "c.kind",
    "length": "length(c.hit)",
    "digits": "length(regexp_replace(c.hit, '[^0-9]', ''))",
    "marks": "length(regexp_replace(c.hit, '[A-Za-z0-9]', ''))",
    "groups": "size(split(c.hit, '[^0-9]+'))",
    "plus": "if(startswith(c.hit, '+'), 1, 0)",
    "variety": "size(array_distinct(split(regexp_replace(c.hit, '[^0-9]', ''), '')))",
    "hinted": f"if(c.before rlike '{CONTEXT}', 1, 0)",
    "joined": "if(right(c.before, 1) rlike '[A-Za-z0-9=\"/]', 1, 0)",
    "followed": "if(c.after rlike '[A-Za-z0-9%\"/]', 1, 0)",
}
#: Trees, depth, step and the precision asked for.
TREES, DEPTH, STEP, PRECISION = 20, 3, 0.3, 0.95
#: Rows of different features that the driver fits by itself, at most.
COLLECTED = 100_000

#: Code points before a match that are its context.
BEFORE = 24


def _matches(pattern: str, needs: str) -> tuple[Column, Column]:
    """The matches in text, and the parts between them."""
    text, none = F.col("text"), F.array().cast("array<string>")
    possible = F.rlike(text, F.lit(needs))
    return F.when(possible, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none), F.when(possible, F.split(text, pattern, -1)).otherwise(none)


def _spans(df: DataFrame, prefix: str, patterns: dict[str, str]) -> DataFrame:
    """Adds prefix_kind for each kind: start, end and text of the matches."""
    hits = {k: _matches(p, NEEDS[k]) for k, p in patterns.items()}
    df = df.withColumns({f"{prefix}_{k}_m": m for k, (m, _) in hits.items()})
    df = df.withColumns({f"{prefix}_{k}_p": F.when(F.size(f"{prefix}_{k}_m") > 0, p) for k, (_, p) in hits.items()})
    df = df.withColumns({f"{prefix}_{k}_s": F.expr(_ends(f"{prefix}_{k}_m", f"{prefix}_{k}_p")) for k in patterns})
    # The context is the part between this match and the one before, with the latter's end where the part is short.
    found = f"""transform({{c}}_m, (h, i) -> named_struct(
        'start', get({{c}}_s, i) - length(h), 'end', get({{c}}_s, i), 'hit', h,
        'before', right(concat(if(i > 0, right(get({{c}}_m, i - 1), {BEFORE}), ''), right(get({{c}}_p, i), {BEFORE})), {BEFORE}),
        'after', left(concat(left(get({{c}}_p, i + 1), 1), coalesce(left(get({{c}}_m, i + 1), 1), '')), 1)))"""
    df = df.withColumns({f"{prefix}_{k}": F.expr(found.format(c=f"{prefix}_{k}")) for k in patterns})
    return df.drop(*(f"{prefix}_{k}_{x}" for k in patterns for x in "mps"))


def _ends(hits: str, parts: str) -> str:
    """Where each match ends: running sums of the lengths of parts and matches, by groups whose starts are summed up first."""
    length = f"transform({hits}, (h, i) -> cast(length(get({parts}, i)) + length(h) as bigint))"
    sums = """aggregate({0}, named_struct('at', {1}, 'out', cast(array() as array<bigint>)),
        (a, x) -> named_struct('at', a.at + x, 'out', array_append(a.out, a.at + x)), a -> a.out)"""
    totals = "transform(sequence(0, cast((size(l) - 1) div g as int)), j -> aggregate(slice(l, j * g + 1, g), 0L, (a, x) -> a + x))"
    within = sums.format("slice(l, j * g + 1, g)", "if(j = 0, 0L, get(t, j - 1))")
    whole = f"flatten(transform(sequence(0, cast((size(l) - 1) div g as int)), j -> {within}))"
    bound = f"get(transform(array({sums.format(totals, '0L')}), t -> {whole}), 0)"
    bound = f"get(transform(array(cast(ceil(sqrt(size(l))) as int)), g -> {bound}), 0)"
    return f"if(size({hits}) = 0, cast(array() as array<bigint>), get(transform(array({length}), l -> {bound}), 0))"


def _proposals(df: DataFrame) -> DataFrame:
    """Adds tried_kind (base matches), base_kind (passed) and proposed (start, end, kind and features)."""
    df = _spans(_spans(df, "tried", BASE), "loose", LOOSE)
    df = df.withColumns({f"base_{k}": F.expr(f"filter(tried_{k}, s -> {VALID[k]})") for k in KINDS})
    every = ", ".join(f"transform(loose_{k}, s -> named_struct('start', s.start, 'end', s.end, 'hit', s.hit, 'before', s.before, 'after', s.after, 'kind', {i}))" for i, k in enumerate(KINDS))
    features = ", ".join(f"'{name}', cast({sql} as int)" for name, sql in FEATURES.items())
    df = df.withColumn("proposed", F.expr(f"concat({every})"))
    return df.withColumn("proposed", F.expr(
        f"transform(proposed, c -> named_struct('start', c.start, 'end', c.end, {features}))")).drop(*(f"loose_{k}" for k in KINDS))


def _touches(spans: str) -> str:
    """Whether proposal c touches one of the spans, a column of them in order, none over another: the last one that starts before c's end, by bisection."""
    last = f"""aggregate(sequence(1, 31), named_struct('low', 0, 'high', size({spans})), (b, x) -> if(b.low >= b.high, b,
        if(get({spans}, shiftright(b.low + b.high, 1)).start < c.end,
           named_struct('low', shiftright(b.low + b.high, 1) + 1, 'high', b.high), named_struct('low', b.low, 'high', shiftright(b.low + b.high, 1)))), b -> b.low)"""
    return f"(size({spans}) > 0 and coalesce(get({spans}, {last} - 1).end > c.start, false))"


def _own(prefix: str) -> str:
    """Whether proposal c touches a span of its own kind."""
    return "(" + " or ".join(f"(c.kind = {i} and {_touches(f'{prefix}_{k}')})" for i, k in enumerate(KINDS)) + ")"


#: Numbers of a card's length that failed, and matches that passed.
_REFUSED = "filter(tried_card, s -> length(regexp_replace(s.hit, '[ -]', '')) between 16 and 19)"
_PASSED = "(" + " or ".join(_touches(f"base_{k}") for k in KINDS) + ")"


class Trees:
    """Boosted trees on integer features, as nested (feature, cut, left, right) with numbers as leaves."""

    def __init__(self, trees: list, bias: float, threshold: float):
        self.trees, self.bias, self.threshold = trees, bias, threshold

    def sql(self, of: str) -> str:
        def write(node) -> str:
            if not isinstance(node, tuple):
                return f"{node:.9g}D"
            return f"if({of}.{node[0]} < {node[1]}, {write(node[2])}, {write(node[3])})"
        return " + ".join([f"{self.bias:.9g}D", *map(write, self.trees)])

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray, names: list[str], check: np.ndarray) -> Trees:
        """check: rows that only calibrate the threshold."""
        learn = ~check
        if not len(y) or len(set(y[learn].tolist())) < 2:
            return cls([], 0.0, math.inf)
        share = (weight * y)[learn].sum() / weight[learn].sum()
        margin = np.full(len(y), math.log(share / (1 - share)))
        model = cls([], float(margin[0]), math.inf)

        def grow(rows: np.ndarray, slope: np.ndarray, curve: np.ndarray, depth: int):
            total, heavy = slope[rows].sum(), curve[rows].sum()
            best = (1e-6, None)
            for f in range(x.shape[1]) if depth else ():
                order = rows[np.argsort(x[rows, f], kind="stable")]
                values, g, h = x[order, f], np.cumsum(slope[order]), np.cumsum(curve[order])
                at = np.flatnonzero(values[1:] != values[:-1])
                if len(at):
                    gain = g[at] ** 2 / (h[at] + 1) + (total - g[at]) ** 2 / (heavy - h[at] + 1) - total**2 / (heavy + 1)
                    i = int(gain.argmax())
                    if gain[i] > best[0]:
                        best = (gain[i], (f, int(values[at[i] + 1])))
            if best[1] is None:
                return float(STEP * total / (heavy + 1))
            f, cut = best[1]
            left = x[rows, f] < cut
            return names[f], cut, grow(rows[left], slope, curve, depth - 1), grow(rows[~left], slope, curve, depth - 1)

        def apply(node, rows: np.ndarray) -> None:
            if not isinstance(node, tuple):
                margin[rows] += node
                return
            left = x[rows, names.index(node[0])] < node[1]
            apply(node[2], rows[left])
            apply(node[3], rows[~left])

        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            tree = grow(np.flatnonzero(learn), weight * (y - p), weight * p * (1 - p), DEPTH)
            apply(tree, np.arange(len(y)))
            model.trees.append(tree)
        held = np.flatnonzero(check if check.any() else learn)
        order = held[np.argsort(-margin[held], kind="stable")]
        good, every = np.cumsum((weight * y)[order]), np.cumsum(weight[order])
        last = np.append(margin[order][1:] != margin[order][:-1], True)  # equal margins stand or fall together
        fine = np.flatnonzero(last & (good / every >= PRECISION))
        if len(fine):
            model.threshold = float(margin[order][fine[-1]])
        return model


def _learned(docs: DataFrame) -> DataFrame:
    """The features of proposals on base matches of all documents, whether the match passed (good), whether only the threshold sees them (held), and their count."""
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return (
        _proposals(docs).withColumn("good", F.expr(f"transform(proposed, c -> {_own('base')})"))
        .withColumn("tried", F.expr(f"transform(proposed, c -> {_own('tried')})"))
        .select("doc_id", F.explode(F.expr("arrays_zip(proposed, good, tried)")).alias("c")).where("c.tried")
        .select(*(F.col(f"c.proposed.{x}").alias(x) for x in FEATURES), F.col("c.good").cast("int").alias("good"),
                F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False)).alias("held"))
        .groupBy(*FEATURES, "good", "held").count()
    )


def fit(docs: DataFrame, collected: int = COLLECTED) -> Trees:
    """The trees and their threshold, from all documents."""
    names = list(FEATURES)
    rows = _learned(docs).persist()
    try:
        if rows.count() > collected:
            return _fit_apart(rows, names)
        table = rows.orderBy(F.desc("count"), *names, "good", "held").toArrow()
    finally:
        rows.unpersist()
    x = np.stack([table[c].to_numpy() for c in names], 1).astype(np.int64)
    y, weight = (table[c].to_numpy().astype(float) for c in ("good", "count"))
    return Trees.fit(x, y, weight, names, table["held"].to_numpy())


def _fit_apart(rows: DataFrame, names: list[str]) -> Trees:
    """Trees.fit where the rows stay on the executors; the driver gets the best cut of each node."""
    rows = rows.select(F.struct(*names).alias("c"), "good", "held", "count")
    learn = rows.where("NOT held")
    every, good = learn.agg(F.sum("count"), F.sum(F.col("count") * F.col("good"))).first()
    if not every or good in (0, every):
        return Trees([], 0.0, math.inf)
    model = Trees([], math.log(good / (every - good)), math.inf)
    for _ in range(TREES):
        model.trees.append(_tree_apart(learn, model, names))

    held = rows.where("held")
    scored = (held if not held.isEmpty() else learn).groupBy(F.expr(model.sql("c")).alias("margin")).agg(
        F.sum(F.col("count") * F.col("good")).alias("good"), F.sum("count").alias("every"))
    # The running sums from the highest margin down: of bands of margins first, then within each band.
    scored = scored.withColumn("band", F.signum("margin") * F.floor(F.log1p(F.abs("margin")) * 1000))
    above, within = Window.orderBy(F.desc("band")), Window.partitionBy("band").orderBy(F.desc("margin"))
    sums = {"good": F.sum("good"), "every": F.sum("every")}
    bands = scored.groupBy("band").agg(*(x.alias(c) for c, x in sums.items()))
    bands = bands.select("band", *((x.over(above) - F.col(c)).alias(f"{c}_above") for c, x in sums.items()))
    upto = scored.join(bands, "band").select("margin", *((x.over(within) + F.col(f"{c}_above")).alias(c) for c, x in sums.items()))
    threshold = upto.where(F.col("good") / F.col("every") >= PRECISION).agg(F.min("margin")).first()[0]
    model.threshold = math.inf if threshold is None else threshold
    return model


def _tree_apart(learn: DataFrame, model: Trees, names: list[str]):
    """The next tree of the model; node n splits into 2n and 2n + 1."""
    splits, leaves = {}, {}

    def place(node: int) -> str:
        if node not in splits:
            return str(node)
        f, cut = splits[node]
        return f"if(c.{f} < {cut}, {place(2 * node)}, {place(2 * node + 1)})"

    def built(node: int):
        return (*splits[node], built(2 * node), built(2 * node + 1)) if node in splits else leaves[node]

    values = F.explode(F.array(*(F.struct(F.lit(i).alias("f"), F.col(f"c.{name}").alias("value")) for i, name in enumerate(names))))
    whole = Window.partitionBy("node", "f")
    upto = whole.orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slopes = learn.withColumn("p", F.expr(f"1 / (1 + exp(-({model.sql('c')})))")).select(
        "c", F.expr("count * (good - p)").alias("slope"), F.expr("count * p * (1 - p)").alias("curve"))
    for level in range(DEPTH):
        best = (
            slopes.select(F.expr(place(1)).alias("node"), "slope", "curve", values.alias("v")).where(f"node >= {1 << level}")
            .groupBy("node", F.col("v.f").alias("f"), F.col("v.value").alias("value")).agg(F.sum("slope").alias("slope"), F.sum("curve").alias("curve"))
            .select("node", "f", "value", F.lead("value").over(whole.orderBy("value")).alias("cut"), F.sum("slope").over(upto).alias("g"),
                    F.sum("curve").over(upto).alias("h"), F.sum("slope").over(whole).alias("total"), F.sum("curve").over(whole).alias("heavy"))
            .withColumn("gain", F.when(F.col("cut").isNotNull(), F.expr("g * g / (h + 1) + (total - g) * (total - g) / (heavy - h + 1) - total * total / (heavy + 1)")))
            .groupBy("node").agg(F.max(F.struct("gain", (-F.col("f")).alias("f"), (-F.col("value")).alias("value"), "cut", "g", "h", "total", "heavy")).alias("best"))
            .select("node", "best.*").collect()
        )
        for r in best:
            leaves[r.node] = STEP * r.total / (r.heavy + 1)
            if r.gain is not None and r.gain > 1e-6:
                splits[r.node] = names[-r.f], r.cut
                leaves[2 * r.node] = STEP * r.g / (r.h + 1)
                leaves[2 * r.node + 1] = STEP * (r.total - r.g) / (r.heavy - r.h + 1)
    return built(1)


def find(docs: DataFrame, model: Trees | None = None) -> DataFrame:
    """All columns of docs, base_kind and all_kind (spans in order) for each kind. docs has no null text."""
    model = model or fit(docs)
    kept = docs.columns
    found = _proposals(docs).withColumn("refused", F.expr(_REFUSED))
    if math.isinf(model.threshold):
        added = "filter(proposed, c -> false)"
    else:
        added = f"filter(proposed, c -> {model.sql('c')} >= {model.threshold:.9g}D and not {_PASSED} and not {_own('tried')} and not {_touches('refused')})"
    found = found.withColumn("added", F.expr(added))
    plain = "array_sort(array_distinct(transform({0}, s -> named_struct('start', s.start, 'end', s.end))))"
    return found.select(
        *kept, *(F.expr(plain.format(f"base_{k}")).alias(f"base_{k}") for k in KINDS),
        *(F.expr(plain.format(
            f"concat(transform(base_{k}, s -> named_struct('start', s.start, 'end', s.end)), "
            f"transform(filter(added, c -> c.kind = {i}), s -> named_struct('start', s.start, 'end', s.end)))")).alias(f"all_{k}")
          for i, k in enumerate(KINDS)))


def _listed(prefix: str) -> Column:
    parts = ", ".join(f"transform({prefix}_{k}, s -> concat('{k}:', s.start, ':', s.end))" for k in KINDS)
    return F.expr(f"concat_ws(',', concat({parts}))")


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row."""
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return find(docs).select(
        "doc_id", *(F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("all").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """docs with each span of the text replaced by its kind in brackets; overlapping ones by the first's."""
    every = ", ".join(f"transform(all_{k}, s -> named_struct('start', s.start, 'end', s.end, 'name', '[{k.upper()}]'))" for k in KINDS)
    rows = rowed(docs)
    found = find(rows, fit(docs)).withColumn("every", F.expr(f"array_sort(concat({every}))"))
    return unrowed(found.withColumn("text", F.expr(_replaced())), docs)


#: Code points of a piece of a text, from which parts are cut.
PIECE = 4096


def _replaced() -> str:
    """The text with the spans of ``every`` replaced by their names: of those that overlap the first one's stands for all."""
    # The end of all spans so far, before each span: by groups, as running sums are.
    ahead = """aggregate({0}, named_struct('at', {1}, 'out', cast(array() as array<bigint>)),
        (a, x) -> named_struct('at', greatest(a.at, x), 'out', array_append(a.out, a.at)), a -> a.out)"""
    tops = "transform(sequence(0, cast((size(e) - 1) div g as int)), j -> array_max(slice(e, j * g + 1, g)))"
    within = ahead.format("slice(e, j * g + 1, g)", "get(t, j)")
    reached = f"flatten(transform(sequence(0, cast((size(e) - 1) div g as int)), j -> {within}))"
    reached = f"get(transform(array({ahead.format(tops, '0L')}), t -> {reached}), 0)"
    reached = f"get(transform(array(cast(ceil(sqrt(size(e))) as int)), g -> {reached}), 0)"
    reached = f"get(transform(array(transform(every, s -> s.end)), e -> {reached}), 0)"
    pieces = f"transform(sequence(0, cast(length(text) div {PIECE} as int)), j -> substring(text, j * {PIECE} + 1, {PIECE}))"
    first, last = f"cast(x.a div {PIECE} as int)", f"cast((x.b - 1) div {PIECE} as int)"
    cut = f"""if(x.b <= x.a, '', if({first} = {last}, substring(get(p, {first}), cast(x.a % {PIECE} + 1 as int), cast(x.b - x.a as int)),
        concat(substring(get(p, {first}), cast(x.a % {PIECE} + 1 as int)), array_join(slice(p, {first} + 2, {last} - {first} - 1), ''),
               substring(get(p, {last}), 1, cast((x.b - 1) % {PIECE} + 1 as int)))))"""
    # What stands from the end of all former spans to the span, and its name; where it overlaps them, nothing.
    parts = f"""transform(every, (s, i) -> if(s.start < get(r, i), '', get(transform(
        array(named_struct('a', get(r, i), 'b', s.start)), x -> concat({cut}, s.name)), 0)))"""
    rest = f"get(transform(array(named_struct('a', array_max(transform(every, s -> s.end)), 'b', cast(length(text) as bigint))), x -> {cut}), 0)"
    whole = f"concat(array_join({parts}, ''), {rest})"
    return f"if(size(every) = 0, text, get(transform(array({pieces}), p -> get(transform(array({reached}), r -> {whole}), 0)), 0))"
