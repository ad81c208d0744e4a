"""Registered queries of the operators over the given tables, and their SQL where it can say the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, codes, decontam, imatch, langid, minhash, mixing, neighbours, oracle, quality, ranked, sharding, toxicity, urls,
               warc)
from ..session import scratch_path
from .shared import load, stored

TOKENIZER = "word_bpe_49k.json"


def remainder(id_: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(id_.cast("string").cast("binary")), F.lit(n))


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate documents by b-bit MinHash."""
    return minhash.near_duplicates(load(spark, sf_dir, "documents"), percent=85)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives and read back."""
    path = scratch_path(spark, "warc")
    warc.write_warc(load(spark, sf_dir, "pages"), path, "page_id", "url", "html")
    return warc.read_warc(spark, path).select(F.col("row_id").alias("page_id"), "payload_bytes", "payload_digest",
                                              "record_type", "refers_to", "error")


def op3_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items."""
    return decontam.contaminated(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the URLs of all pages."""
    return urls.judged(load(spark, sf_dir, "pages").select("page_id", "url"))


def op5_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near-equal bytes."""
    text = F.col("text")
    out = sharding.sharded(load(spark, sf_dir, "documents").select(
        "doc_id", "text", sharding.size_of(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32")), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    import public_tokenizers

    return bpe.token_counts(load(spark, sf_dir, "documents"), str(public_tokenizers.path(TOKENIZER)))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted languages of all documents."""
    docs = load(spark, sf_dir, "documents")
    rest = remainder(F.col("doc_id"), 5)
    net = langid.fit(docs, rest != 0)
    held = docs.select("doc_id", "text", F.coalesce(rest == 0, F.lit(False)).alias("held_out"))
    return langid.identify(held, net, text_back=False).select("doc_id", "held_out", "lang_pred", "score")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, called at 0.3 and at the threshold of each language."""
    docs = load(spark, sf_dir, "documents")
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"), remainder(F.col("doc_id"), 4) != 2)
    return toxicity.score(docs, model, lang_col="lang").select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"), "decision")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raked weights, sampling probabilities and the sample over all documents."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mixing.mixed(docs).select("doc_id", "mix.*")


def op10_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    docs = load(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lots = imatch.SUBSETS
    words = imatch.lexicon(docs.select(imatch.terms_of(F.col("text")).alias("terms")), thin=lots)
    pairs = neighbours.with_next(docs, "doc_id", "text", "following",
                                 lambda df: imatch.with_fingerprint(df, "text", words, thin=lots))
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("following.text"), F.lit(1), half))
    prints = imatch.with_fingerprint(pairs.withColumn("edited", edited), "edited", words, "edited_fingerprint", thin=lots)
    prints = prints.select("doc_id", n.cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                           "fingerprint", "edited_fingerprint", F.col("following.fingerprint").alias("next_fingerprint"))
    return prints.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                         imatch.likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                         imatch.likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all embeddings."""
    return codes.compressed(load(spark, sf_dir, "embeddings"))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdicts on all documents, learnt from the labelled ones."""
    docs = load(spark, sf_dir, "documents")
    return quality.judged(docs, load(spark, sf_dir, "labels"))


def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    return ranked.search(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_minhash, op2_warc, op3_decontam, op4_urls, op5_shards, op6_tokens,
                                    op7_langid, op8_toxicity, op9_mixing, op10_imatch, op11_codes, op12_quality,
                                    op13_ranked)}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
