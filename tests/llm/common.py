"""Edge rows and small helpers for the corpus operators."""

import os
import sys

import pyarrow.parquet as pq

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = [f"w{i}" for i in range(400)]


def table(name, folder=SMALL):
    return pq.read_table(f"{folder}/{name}.parquet").to_pylist()


def words(a, b):
    return " ".join(WORDS[i % 400] for i in range(a, b))


def edge_docs():
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    long = words(0, 399) + " " + " ".join(f"x{i}" for i in range(30000))
    return [
        (1, words(0, 60), "en", "a", 1), (2, words(0, 60), "en", "a", 1), (2, words(0, 60), "en", "a", 1),
        (3, words(0, 58) + " other end", None, None, None), (4, None, "en", "b", 0), (5, "", "de", "b", 0),
        (6, " \n\t ", "de", None, 0), (7, "two words", "en", "a", 9), (8, "TWO\twords", "en", "a", 9),
        (None, words(0, 60), "en", "a", 1), (None, None, None, None, None), (9, long, "en", "c", 1),
        (10, long, "fr", "c", 1), (11, "1234 !?", "fr", "c", 1)]


def edge_frame(spark):
    """The edge rows with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(edge_docs(), DOCS)
    return df.withColumns({c: F.lit(k) for k, c in enumerate(
        ("node", "component", "score", "shard", "slot", "mix", "digest", "fingerprint", "h", "key", "kept"))})


def empty_frame(spark):
    return spark.createDataFrame([], DOCS)
