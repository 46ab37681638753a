"""From documents to packed sequences: five stages, each written as Parquet and read again by the next.

Toxic documents go, one document of each near-duplicate group stays, byte strings that an earlier document holds are cut
out, personal data is replaced by its kind, and what is left is packed. All stages but the last return the columns of
documents, n_chars counted anew where the text changes. Null texts count as empty and stay. Rows without an id are no
near-duplicates of others. Rows that share an id are documents of their own; of those among them that are near-duplicates of
each other the one with the smallest text stays. Texts without words are near-duplicates of none and stay. Empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallywatch.llm import neardup, packing, personal, repeats, toxicity
from tallywatch.llm.common import ready, rowed, saved, table, unrowed


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below one half; the model is fitted on the labelled ones among docs."""
    model = toxicity.fit(docs, table(ready(spark), sf_dir, "labels"))
    return unrowed(toxicity.score(rowed(docs), model).where("predicted = 0"), docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by five-word shingles at a similarity of 0.8."""
    ready(spark)
    kept = neardup.grouped(docs, k=5, percent=80).where("kept").select("doc_id", "body", "component").distinct()
    rows = rowed(docs).withColumn("body", F.xxhash64("text"))
    alone = rows.where("doc_id IS NULL").select("row", "text")
    stays = rows.join(kept, ["doc_id", "body"])
    first = Window.partitionBy("doc_id", "component").orderBy("text", F.to_json("row"))
    linked = stays.where("component IS NOT NULL").withColumn("place", F.row_number().over(first)).where("place = 1")
    without_words = stays.where("component IS NULL").select("row", "text")
    return unrowed(linked.select("row", "text").union(without_words).union(alone), docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that also start in a document with a smaller id."""
    ready(spark)
    return _counted(repeats.without_repeats(docs))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    ready(spark)
    return _counted(personal.redact(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    ready(spark)
    return packing.pack(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("repeats", without_repeats),
    ("personal_data", without_personal_data),
    ("packing", packed),
]
#: SQL can express neither the trained model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(ready(spark), sf_dir, "documents")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
