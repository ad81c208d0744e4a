"""Cleaning pipeline over ``documents``: each stage works on all that its predecessor kept.

Language ID, near-duplicates, benchmark decontamination, mixing, sharding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shotframe.llm import decontam, langid, minhash, mixing, sharding
from shotframe.llm.shared import load, stored

SHARDS = 8
#: Documents of at least this similarity (percent) are near-duplicates.
NEAR_PERCENT = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told.

    Null, empty and letterless texts go, and those whose spelling is of no
    language that the labelled documents teach.  Repeated rows all stay or go,
    columns of any name stay as they are.
    """
    net = langid.fit(docs, F.lit(True))
    found = langid.identify(docs, net, pred_col="__told_language", score_col="__told_score", reject=True)
    return found.where(F.col("__told_language") != langid.UNDETERMINED).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str, percent: int = NEAR_PERCENT) -> DataFrame:
    """One document of each near-duplicate group, that with the smallest id.

    Null and empty texts have no shingles and stay, as do rows without an id.  Of rows that share an id the one with
    the smallest text stays.  Texts of any length are compared whole; an empty table stays empty.
    """
    return minhash.deduplicated(docs, percent=percent)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items.

    Null and empty texts stay, of repeated rows all stay or go, whole texts are searched; columns may have any name.
    """
    return decontam.clean(docs, load(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents that meets the target weights.

    Null sources and languages are a value like others; texts without words weigh nothing and stay.  Equal rows
    share their draw.  A column ``mix`` of the table stays as it is.
    """
    return mixing.mixed(docs.withColumnRenamed("mix", "_mix")).where("mix.kept").drop("mix").withColumnRenamed("_mix", "mix")


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard and its slot there.

    Null texts count one byte, null ids are a key like others, equal rows lie together; columns ``shard`` and
    ``slot`` of the table are replaced.
    """
    return sharding.sharded(docs, SHARDS)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mix", mix), ("shard", shard)]

#: Trained models and similarity components are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each one's result written to the shared folder and read back."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
