"""A training-data pipeline over ``documents``: five stages, each an operator of ``floorline.llm``.

Every stage takes all that the one before kept and returns the columns of
``documents``; the last returns the sampled segmentations.  ``run`` writes each
stage's result to the cluster's shared folder and reads it again.  Duplicates and
repeated passages are judged by ``doc_id``, the smallest of a group staying.  All
stages take null and empty texts, null ids, repeated rows, empty tables and
further columns, as their operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floorline.llm.common import stored
from floorline.llm.decontamination import benchmark_hits
from floorline.llm.minhash import near_duplicates
from floorline.llm.quality import fit_quality, score_rows
from floorline.llm.segmentations import sample_segmentations
from floorline.llm.substring_dedup import substring_dedup


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model accepts; it is fitted on the labelled ones among ``docs``."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_rows(docs, model, "quality_score__").filter("quality_score__ >= 0.7").drop("quality_score__")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8): that with the smallest id, one row of it.

    Rows with a null id are all kept.
    """
    dropped = near_duplicates(docs).filter("NOT kept").select(F.col("doc_id").alias("dropped_id")).distinct()
    left = docs.join(dropped, F.col("doc_id") == F.col("dropped_id"), "left_anti")
    alone = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id())
    return left.withColumn("alone__", alone).dropDuplicates(["doc_id", "alone__"]).select(docs.columns)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words that an earlier document has.

    A text that loses nothing stays as it is, otherwise what is kept is joined by
    one space and ``n_chars`` is counted anew; a text that loses all is empty.
    """
    found = substring_dedup(docs, keep_columns=True)
    changed = F.col("n_removed") > 0
    own = {"text": F.col("kept"), "n_chars": F.when(changed, F.char_length("kept").cast("long")).otherwise(F.col("row.n_chars"))}
    return found.select(*(own.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    found = benchmark_hits(docs, table(spark, sf_dir, "benchmark")).filter("contaminated").select(
        F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("hit_hash"))
    return docs.join(found, same, "left_anti")


def segment(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Distinct sampled segmentations of every document's text, and the text decoded from each."""
    return sample_segmentations(docs, decode=True)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("substrings", substrings), ("decontaminate", decontaminate),
          ("segment", segment)]
# The quality model and the sampling have no SQL; each stage is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
