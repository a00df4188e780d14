"""Documents to packed training sequences, one stage after the other.

``run`` writes what each stage returns to the shared folder of the cluster and reads it again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lmtables.llm import heavy_light, quotient_dedup, source_schedule, vector_packing, zstd_quality
from lmtables.llm.queries import let_workers_import
from lmtables.llm.rows import ROW, first_of_groups, numbered
from lmtables.session import stage, unstage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts; it learns from the labelled ones among them."""
    let_workers_import(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return zstd_quality.accept(docs, zstd_quality.fit(docs, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest doc_id."""
    let_workers_import(spark)
    rows = numbered(docs)
    found = quotient_dedup.exact_duplicates(rows, key=ROW).where("group_size > 1")
    return first_of_groups(rows, found.select(ROW, F.col("keep_id").alias("group")), "doc_id")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of five-word shingles connect (similarity 0.8 or more) that with the smallest doc_id."""
    let_workers_import(spark)
    rows = numbered(docs)
    joined = heavy_light.jaccard_components(rows, key=ROW, words=5, percent=80, most_left=0.75)
    found = stage(joined, "components")
    unstage(joined)
    several = found.groupBy("component_id").count().where("count > 1").select("component_id")
    grouped = found.join(several, "component_id").select(ROW, F.col("component_id").alias("group"))
    kept = first_of_groups(rows, grouped, "doc_id")
    unstage(found)
    return kept


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, to the nearest whole number; not at all where that is 0."""
    let_workers_import(spark)
    rows = numbered(docs)
    taken = source_schedule.mix(rows, row=ROW).taken()
    times = F.round(F.col("taken") / F.col("size")).cast("int")
    copies = taken.where("size > 0").select(F.col("row").alias(ROW), times.alias("_copies")).where("_copies > 0")
    repeated = rows.join(copies, ROW).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return repeated.select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    let_workers_import(spark)
    return vector_packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# SQL has neither zstandard nor a tokenizer; tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
