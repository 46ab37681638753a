from __future__ import annotations

import importlib
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallywatch.llm import personal, toxicity
from tallywatch.llm.common import ready
from tests.llm import test_neardup, test_personal, test_repeats, test_toxicity
from tests.llm.helpers import empty_docs, odd_docs


def tables(spark, folder):
    rows = test_toxicity.corpus(300)
    docs = odd_docs(ready(spark), [(1000 + i, t) for i, t, _ in rows] + [(2000 + i, t) for i, t in test_repeats.corpus(3)] + test_personal.corpus(2)[:60])
    labels = spark.createDataFrame([(1000 + i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    return docs


def redacted(text):
    """The text with its base spans replaced, overlapping ones by the first's kind."""
    out, at = "", 0
    for start, end, kind in sorted((a, b, k) for k, a, b in test_personal.brute(text)):
        if start >= at:
            out += text[at:start] + f"[{kind.upper()}]"
        at = max(at, end)
    return out + text[at:]


def test_stages_equal_brute_force(spark, tmp_path):
    folder = f"file://{tmp_path}"
    tables(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    state = [r.asDict() for r in docs.collect()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        if name == "toxicity":
            state = [r | {"text": r["text"] or ""} for r in state if model.score(r["text"] or "") < 0.5]
        elif name == "near_duplicates":
            rows = [(r["doc_id"], r["text"]) for r in state]
            first = {}
            for r, (i, _, _, kept), root in sorted(
                    zip(state, test_neardup.brute(rows, 5, 80), test_neardup.roots(rows, 5, 80)), key=lambda x: x[0]["text"]):
                if kept:
                    first.setdefault((i, root) if root is not None else len(first), r)
            state = list(first.values())
        elif name == "repeats":
            left = []
            for r, (_, _, gone, _, _) in zip(state, test_repeats.brute([(r["doc_id"], r["text"]) for r in state])):
                left.append((r, gone))
            assert {(r.doc_id, len(r.text.encode())) for r in docs.collect()} == {(r["doc_id"], len(r["text"].encode()) - gone) for r, gone in left}
            state = [r.asDict() for r in docs.collect()]
        elif name == "personal_data":
            wanted = {r["doc_id"]: redacted(r["text"]) for r in state}
            found = {r.doc_id: r.text for r in docs.collect()}
            assert sum(found[i] == t for i, t in wanted.items()) >= 0.9 * len(wanted)  # the others have added spans
            assert all(found[i] == t for i, t in wanted.items() if not any(c.isdigit() for c in t))
            state = [r.asDict() for r in docs.collect()]
        if name != "packing":
            wanted = sorted(((r["doc_id"], r["text"]) for r in state), key=repr)
            assert sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr) == wanted, name
            if name in ("repeats", "personal_data"):
                assert docs.where(F.length("text") != F.col("n_chars")).isEmpty()
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = sorted(((r["doc_id"], zlib.crc32(np.array([*library.encode(r["text"], add_special_tokens=False).ids, 2], "<u4").tobytes())) for r in state if len(r["text"]) < 900), key=repr)
    found = [(r.doc_id, r.ids_crc32) for r in docs.where("start = 0").collect()]
    assert set(wanted) <= set(found)
    ran = corpus_pipeline.run(spark, folder)
    assert sorted(ran.drop("sequence_id", "offset").collect(), key=repr) == sorted(docs.drop("sequence_id", "offset").collect(), key=repr)


def test_empty_tables(spark, tmp_path):
    folder = f"file://{tmp_path}"
    empty_docs(ready(spark)).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_order_of_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeats", "personal_data", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and importlib.import_module("__spark_entry__").queries()["pipeline"] is corpus_pipeline.run
    assert personal.KINDS == ("email", "ip", "card", "phone") and pytest
