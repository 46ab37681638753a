"""Small tables with the odd rows that every operator has to bear."""

from __future__ import annotations

LONG = "word " * 30_000 + "end"
DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, key long, spans int, score string"


def odd_docs(spark, more=()):
    """Nulls, empty and very long texts, repeated rows, columns with names that operators use themselves."""
    texts = [
        (1, "the quick brown fox jumps over the lazy dog near the river bank " * 3), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (6, LONG),
        (7, "short"), (7, "short"), (8, "Żółć 日本語 😀 text\nwith lines\n\nand a break"), (None, "no id here"), (None, None), *more,
    ]
    rows = [(i, t, None if i == 3 else "en", "src", len(t or ""), "r", i, 7, "s") for i, t in texts]
    return spark.createDataFrame(rows, DOC_SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def collected(df):
    return [tuple(r) for r in df.collect()]
