"""Spelling variants: near words of a vocabulary by composing its acceptor with a one-edit transducer and itself.

Words that differ by one edit agree in their first ``KEY`` or in their last ``KEY`` code points, as they have at least
2 * KEY. So the composition is enumerated by initial state: the state that the acceptor is in after a shared beginning
(its edit comes later), and that of the reversed acceptor after a shared ending (kept where the beginnings differ, so no
pair is found twice). A partition holds the words that reach one initial state: their rests are made into a minimal
acceptor, and ``composed`` walks pairs of its states, (p, p) before the edit and (p, q) behind it.

A state that over ``GROUP`` words reach is not given to one task. It is left by one more code point, as often as needed: words
that agree there go on to the next states. Words that are edited just there have the same rest behind the edit, so they
meet in a join on the word without that code point: few words share one, at most twice the alphabet. Each
level is a pass over the words that are still in such states; there are no more levels than code points in a word.

Per partition only a word's number of near words and the best of them are returned, and added up by word. Forms lead to ever more frequent words, so
following them ends; paths are doubled in each round, in a join of the words that have a form.

Null texts hold no words; a null id counts as an empty text in the hash that deletes code points. Repeated rows count again. Of
near words with the same n the smallest in code-point order is the form. Empty tables give no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.llm.common import saved

#: A word's code points, and occurrences in all texts, at least; how many times as frequent a form is.
LETTERS, OCCURRENCES, RATIO = 6, 5, 5
#: One code point of a run is deleted where this divides its hash.
DELETED = 199
#: Shared code points of a partition's words; words that a task composes at most.
KEY, GROUP = 3, 20_000

RUN = f"[A-Za-z\\\\u00C0-\\\\u00FF]{{{LETTERS},}}"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOUND = "word string, n_near long, best_n long, best string"


# -- the vocabulary ------------------------------------------------------------------
def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: all words of the texts. Runs too short to be words are never looked at; counts are combined map-side."""
    runs = docs.selectExpr(
        "coalesce(CAST(doc_id AS STRING), '') AS id", f"explode(regexp_extract_all(text, '{RUN}', 0)) AS run"
    ).selectExpr("id", f"translate(run, '{UPPER}', '{LOWER}') AS run")
    hashed = runs.selectExpr("run", "crc32(CAST(concat(id, ':', run) AS BINARY)) AS h")
    at = "CAST(h % length(run) AS INT)"
    cut = f"concat(substring(run, 1, {at}), substring(run, {at} + 2))"
    words = hashed.selectExpr(f"CASE WHEN h % {DELETED} = 0 THEN {cut} ELSE run END AS word").where(f"length(word) >= {LETTERS}")
    return words.groupBy("word").agg(F.count("*").alias("n")).where(f"n >= {OCCURRENCES}")


# -- acceptors -----------------------------------------------------------------------
class State:
    """A state of a minimal acceptor: its arcs by letter, and whether a word ends here."""

    __slots__ = ("arcs", "final", "number")

    def __init__(self) -> None:
        self.arcs: dict[str, State] = {}
        self.final = False
        self.number = -1


def acceptor(words: list[str]) -> State:
    """The minimal acceptor of sorted, distinct words; equal states are merged as soon as no word can change them."""
    known: dict[tuple, State] = {}

    def merged(state: State) -> State:
        same = (state.final, tuple((c, s.number) for c, s in state.arcs.items()))
        found = known.setdefault(same, state)
        if found is state:
            state.number = len(known)
        return found

    path, last = [State()], ""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            state = path.pop()
            path[-1].arcs[last[len(path) - 1]] = merged(state)

    for word in words:
        shared = next((i for i, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
        close(shared)
        for c in word[shared:]:
            path[-1].arcs[c] = state = State()
            path.append(state)
        path[-1].final, last = True, word
    close(0)
    return path[0]


def _both(p: State, q: State) -> Iterator[str]:
    """The words that both states accept."""
    stack = [(p, q, "")]
    while stack:
        p, q, read = stack.pop()
        if p.final and q.final:
            yield read
        small, large = (p.arcs, q.arcs) if len(p.arcs) <= len(q.arcs) else (q.arcs, p.arcs)
        for c in small:
            if c in large:
                stack.append((p.arcs[c], q.arcs[c], read + c))


def composed(start: State) -> Iterator[tuple[str, str]]:
    """The accepted pairs (u, v) of acceptor, one-edit transducer and acceptor, u longer than v or else smaller: some more than once.

    Before the edit both acceptors are in the same state, reached by the same letters. The transducer then replaces a
    letter (both move, by different letters) or deletes one (the first moves alone), and copies what follows.
    """
    stack = [(start, "")]
    while stack:
        state, read = stack.pop()
        arcs = state.arcs
        for c, p in arcs.items():
            stack.append((p, read + c))
            for rest in _both(p, state):
                yield read + c + rest, read + rest
            for d, q in arcs.items():
                if c < d:
                    for rest in _both(p, q):
                        yield read + c + rest, read + d + rest


class Best:
    """Per word: how many near words, and of them the most frequent, the smallest among equals."""

    def __init__(self, counts: dict[str, int]):
        self.counts = counts
        self.found: dict[str, list] = {}

    def add(self, u: str, v: str) -> None:
        n, entry = self.counts[v], self.found.setdefault(u, [0, 0, ""])
        entry[0] += 1
        if n > entry[1] or n == entry[1] and v < entry[2]:
            entry[1:] = n, v

    def rows(self) -> pd.DataFrame:
        return pd.DataFrame([(w, *e) for w, e in self.found.items()], columns=["word", "n_near", "best_n", "best"])


def near_within(counts: dict[str, int], shared: int, backwards: bool) -> pd.DataFrame:
    """The near words among words with the same first (last, if backwards) ``shared`` code points, differing after (before)
    them; if backwards, only those with different first ``KEY`` code points."""
    rests = sorted(w[::-1][shared:] if backwards else w[shared:] for w in counts)
    key = next(iter(counts))
    key = key[::-1][:shared] if backwards else key[:shared]
    pairs = {(key + u, key + v) for u, v in composed(acceptor(rests))}
    best = Best(counts)
    for u, v in pairs:
        if backwards:
            u, v = u[::-1], v[::-1]
            if u[:KEY] == v[:KEY]:
                continue
        best.add(u, v)
        best.add(v, u)
    return best.rows()


# -- partitions ----------------------------------------------------------------------
def _within(words: DataFrame, shared: int, backwards: bool) -> DataFrame:
    """Near words in each initial state (``state``) of at most GROUP words."""
    def near(group: pd.DataFrame) -> pd.DataFrame:
        return near_within(dict(zip(group["word"], group["n"].astype(int))), shared, backwards)

    return words.groupBy("state").applyInPandas(near, FOUND)


def _across(words: DataFrame, at: int, backwards: bool) -> DataFrame:
    """Near words of one state that agree in ``at`` code points and are edited just there: one row for each such word and side."""
    place = "reverse(word)" if backwards else "word"
    rest = f"concat(substring({place}, 1, {at}), substring({place}, {at} + 2))"
    # A word with the same code points on both sides of the edit has it one place later.
    longer = words.selectExpr("word", "n", f"{rest} AS rest", f"substring({place}, {at} + 1, 1) AS letter")
    whole = words.selectExpr("word AS other", "n AS other_n", f"{place} AS rest", f"substring({place}, {at} + 1, 1) AS next")
    deleted = longer.where("letter <> ''").join(whole, "rest").where("letter <> next")
    replaced = longer.where("letter <> ''").join(
        longer.where("letter <> ''").selectExpr("word AS other", "n AS other_n", "rest", "letter AS next"), "rest").where("letter <> next")
    pairs = deleted.selectExpr("word", "n", "other", "other_n").unionAll(
        deleted.selectExpr("other", "other_n", "word", "n")).unionAll(replaced.selectExpr("word", "n", "other", "other_n"))
    if backwards:
        pairs = pairs.where(f"left(word, {KEY}) <> left(other, {KEY})")
    return pairs.groupBy("word").agg(F.count("*").alias("n_near"), _best("other_n", "other"))


def _best(n: str, word: str):
    """The most frequent word, the smallest in code-point order among equals, as best_n and best."""
    return F.expr(f"min(struct(-{n} AS less, {word} AS best)) AS top")


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """word, n_near, best_n, best of the words that have near words."""
    found = []
    for backwards in (False, True):
        shared, left = KEY, words.select("word", "n")
        while True:
            state = f"left({'reverse(word)' if backwards else 'word'}, {shared})"
            keyed = left.selectExpr("*", f"{state} AS state")
            # Written first: the list's size tells Spark whether it may be broadcast.
            large = saved(keyed.groupBy("state").count().where(f"count > {group}").select("state"))
            small = keyed.join(large, "state", "left_anti")
            found.append(_within(small, shared, backwards).selectExpr(
                "word", "n_near", "struct(-best_n AS less, best) AS top"))
            if large.isEmpty():
                break
            left = saved(keyed.join(large, "state", "left_semi").select("word", "n"))
            found.append(_across(left, shared, backwards).select("word", "n_near", "top"))
            shared += 1
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("top").alias("top")).selectExpr(
        "word", "n_near", "-top.less AS best_n", "top.best AS best")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root of the words that have a form: paths of 1, 2, 4... forms until none goes on."""
    paths = saved(forms.selectExpr("word", "form AS root"))
    while True:
        onward = paths.selectExpr("word AS root", "root AS further")
        longer = saved(paths.join(onward, "root", "left").selectExpr("word", "coalesce(further, root) AS root", "further IS NOT NULL AS moved"))
        if longer.where("moved").isEmpty():
            return longer.select("word", "root")
        paths = longer.select("word", "root")


def variants(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts."""
    words = saved(vocabulary(docs))
    is_form = f"best_n >= {RATIO} * n"
    known = saved(words.join(near_words(words, group), "word", "left").selectExpr(
        "word", "n", "coalesce(n_near, 0L) AS n_near", f"CASE WHEN {is_form} THEN best END AS form", f"CASE WHEN {is_form} THEN best_n END AS form_n"))
    roots = _roots(known.where("form IS NOT NULL"))
    return known.join(roots, "word", "left").selectExpr("word", "form", "coalesce(root, word) AS root", "n", "n_near", "form_n")
