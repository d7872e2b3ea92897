"""A corpus pipeline over ``documents``: five stages, each one of the operators of ``gradeframe.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of ``documents``.
``run`` applies them to the ``documents`` of a folder, writing each stage's rows
as Parquet under ``spark.checkpoint.dir`` and reading them again, so a lost
executor costs a stage's tasks at most.

Columns that a stage adds never leave it, and extra columns of ``documents``
are carried to the last stage, whatever they are called. A NULL or repeated doc_id
joins nothing: documents are told apart by id and text, and rows that agree in
both are one document from the second stage on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeframe.llm import mixing, packing, paragraphs, quality, simhash
from gradeframe.llm.catalog import BYTE_BPE
from gradeframe.llm.common import apart, read, ship, stored


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as 1."""
    weights = quality.train(docs, read(spark, sf_dir, "labels"))
    inner, names = apart(docs, ("text",))
    return quality.scored(inner, weights).where("predicted = 1").select(*names).toDF(*names.values())


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the one with the smallest doc_id (NULL last),
    of several texts with that id the one with the smallest hash. What links to nothing stays."""
    ship(spark)
    inner, names = apart(docs, ("doc_id", "text"))
    inner = inner.withColumn("row", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))  # id and text
    found = simhash.near_duplicates(inner.select(F.col("row").alias("doc_id"), "text"), words=4, radius=4)
    groups = found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("group")).distinct()
    ids = inner.select("row", "doc_id").distinct()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.col("row"))).alias("first")
    stays = ids.join(groups, "row").groupBy("group").agg(first).select(F.col("first.row").alias("row"))
    kept = inner.join(stays, "row", "left_semi").withColumn("again", F.xxhash64(F.lit("again"), "doc_id", F.coalesce("text", F.lit(""))))
    return kept.dropDuplicates(["row", "again"]).select(*names).toDF(*names.values())


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document keeps; documents left with no text go."""
    ship(spark)
    inner, names = apart(docs, ("doc_id", "text", "n_chars"))
    cleaned = paragraphs.dedup_substrings(inner).where((F.col("removed_words") == 0) | (F.length("text") > 0))
    chars = F.when(F.col("removed_words") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return cleaned.withColumn("n_chars", chars).select(*names).toDF(*names.values())


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources by the weights 5, 2, 1: a row per document and repetition."""
    ship(spark)
    return mixing.mixed_texts(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents in sequences of at most 1024 tokens."""
    ship(spark)
    return packing.pack(docs, BYTE_BPE, end_id=2, capacity=1024)


STAGES = [
    ("quality_classifier", quality_filter),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("source_mixing", mix),
    ("best_fit_packing", pack),
]

#: SQL cannot express hashed regression, banding or packing; the tests hold the
#: stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
