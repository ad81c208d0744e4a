"""Ranked lexical search by accumulator-limited term-at-a-time evaluation.

The documents are the unit of distribution: every task ranks its own
documents for all items, and the best of the tasks are merged.  One pass
turns each text into its length and the frequencies of the terms that the
items ask for (a table in the shared folder); counts over that table give the
corpus figures N, L and df; a second pass scores.

Within a task an item's terms are taken rarest first.  Each adds its share to
the accumulators of the documents that hold it.  Once the largest shares that
the remaining terms can still give add up to less than the k-th best partial
score, no document without an accumulator can come among the best k: from
there on no accumulators are made, those that cannot reach the k-th score are
left, and the survivors are updated exactly.  The k-th score of the documents
that a task has seen is carried from batch to batch.

Items are worked on in blocks of a bounded number of (item, term) pairs, so
what a task is sent does not grow with the number of items.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut, slices
from .words import NOT_ALNUM, word_hashes

#: (Item, term) pairs of a block; an item with more stands alone.
BLOCK_PAIRS = 500_000
#: Lanes in which the tasks' results are merged first.
LANES = 64


def _item_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``key, item, terms`` per row: a key of its own and the hashes of its distinct terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, buf, offsets in slices(batch.column(1)):
                hashes, first, _, _ = word_hashes(buf, offsets, NOT_ALNUM)
                terms = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(terms)), pa.array(terms, pa.list_(pa.int64()))],
                                                 ["item", "terms"])

    kind = items.select(F.col(item_col)).schema[0].dataType.simpleString()
    found = items.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("text"))
    return cut(found.mapInArrow(run, f"item {kind}, terms array<bigint>").withColumn("key", F.monotonically_increasing_id()))


def _index(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``id, n, terms, tfs`` of every document with a term: its length, and places in the vocabulary with frequencies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, buf, offsets in slices(batch.column(1)):
                hashes, first, _, _ = word_hashes(buf, offsets, NOT_ALNUM)
                n = np.diff(first)
                place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
                asked = np.flatnonzero(vocabulary[place] == hashes)
                row = np.repeat(np.arange(len(n)), n)[asked]
                pairs, tf = np.unique(row * len(vocabulary) + place[asked], return_counts=True)
                bounds = np.searchsorted(pairs, np.arange(len(n) + 1) * len(vocabulary)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(bounds), pa.array(x.astype(np.int32)))
                         for x in (pairs % len(vocabulary), tf)]
                out = pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(n)), pa.array(n.astype(np.int64)), *lists],
                                                 ["id", "n", "terms", "tfs"])
                yield out.filter(pa.array(n > 0))

    return cut(docs.mapInArrow(run, "id bigint, n bigint, terms array<int>, tfs array<int>"))


def length_norm(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """A document's m: 10 + (90 n N) div L, in exact integers."""
    if len(n) and int(n.max()) * 90 * n_docs < 2**63:
        return 10 + 90 * n * n_docs // n_terms
    return np.array([10 + 90 * x * n_docs // n_terms for x in n.tolist()], dtype=np.int64)


class Block:
    """The postings of one batch of documents, by term, with each posting's share of the score."""

    def __init__(self, n, term, tf, row, weights, n_docs: int, n_terms: int):
        m = length_norm(n, n_docs, n_terms)
        order = np.argsort(term, kind="stable")
        self.rows = row[order]
        tf = tf[order].astype(np.int64)
        self.shares = weights[term[order]] * (1_000_000_000 * tf // (1000 * tf + 8 * m[self.rows]))
        self.first = np.searchsorted(term[order], np.arange(len(weights) + 1))
        self.most = np.zeros(len(weights), np.int64)
        held = np.flatnonzero(np.diff(self.first))
        if len(held):
            self.most[held] = np.maximum.reduceat(self.shares, self.first[held])
        self.sums = np.zeros(len(n), np.int64)
        self.made = self.updated = 0

    def best(self, terms: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) that hold the best ``k`` of an item among all rows of a score of at least ``least``.

        ``terms`` come rarest first.  A row not returned has a score of 0, of
        under ``least``, or of under that of ``k`` rows returned.
        """
        terms = terms[self.most[terms] > 0]
        rest = np.append(np.cumsum(self.most[terms][::-1])[::-1], 0)
        sums, kth, at = self.sums, max(least, 1), 0
        while at < len(terms) and rest[at] >= kth:
            a, b = self.first[terms[at]], self.first[terms[at] + 1]
            sums[self.rows[a:b]] += self.shares[a:b]
            self.made += b - a
            at += 1
            if at < len(terms) and len(sums) > k and sums.max() > rest[at]:
                kth = max(kth, int(np.partition(sums, -k)[-k]))
        live = np.flatnonzero(sums >= max(1, kth - int(rest[at])))
        scores = sums[live]
        sums[:] = 0
        for t in terms[at:]:
            a, b = self.first[t], self.first[t + 1]
            place = np.minimum(a + np.searchsorted(self.rows[a:b], live), b - 1)
            hit = self.rows[place] == live
            scores[hit] += self.shares[place[hit]]
            self.updated += int(hit.sum())
        if len(scores) > k:
            kth = max(kth, int(np.partition(scores, -k)[-k]))
        good = scores >= kth
        return live[good], scores[good]


def _lead(scores: np.ndarray, ids: np.ndarray, unknown: np.ndarray, k: int):
    """The first ``k`` by falling score, then rising id, rows without an id last."""
    order = np.lexsort((ids, unknown, -scores))[:k]
    return scores[order], ids[order], unknown[order]


def _scored(index: DataFrame, keys: np.ndarray, terms: list[np.ndarray], weights: np.ndarray, n_docs: int, n_terms: int,
            k: int) -> DataFrame:
    """``key, id, score``: each task's best ``k`` documents of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        lead = [(none, none, none.astype(bool))] * len(keys)
        for batch in batches:
            ids = np.asarray(batch.column(0).fill_null(0))
            unknown = np.asarray(batch.column(0).is_null())
            n = np.asarray(batch.column(1))
            lists = batch.column(2)
            row = np.repeat(np.arange(len(n)), np.asarray(lists.value_lengths()))
            block = Block(n, np.asarray(lists.flatten()), np.asarray(batch.column(3).flatten()), row, weights, n_docs, n_terms)
            for i, own in enumerate(terms):
                old = lead[i]
                rows, scores = block.best(own, k, int(old[0][-1]) if len(old[0]) == k else 0)
                if len(rows):
                    lead[i] = _lead(np.append(old[0], scores), np.append(old[1], ids[rows]), np.append(old[2], unknown[rows]), k)
        for key, (scores, ids, unknown) in zip(keys, lead):
            if len(scores):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(scores), key)), pa.array(ids, mask=unknown), pa.array(scores)],
                                                 ["key", "id", "score"])

    return index.mapInArrow(run, "key bigint, id bigint, score bigint")


def _first(rows: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents of the highest scores above 0 of every item.

    Every row of ``docs`` is a document and every row of ``items`` an item, so
    repeated rows are ranked, or asked for, each time.  Equal scores go by
    ascending id, rows without an id last.  Null texts and texts without a term
    are no documents; such items, and any with an empty table of documents,
    have no rows.  Whole texts of any length are read; other columns, whatever
    their names, are ignored.
    """
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = _item_terms(items, item_col, item_text_col).where(F.size("terms") > 0)
    pairs = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = max(1, -(-pairs // block_pairs))
    found = []
    for b in range(n_blocks):
        rows = asked.where(F.pmod(F.xxhash64("key"), F.lit(n_blocks)) == b).select("key", "terms").collect()
        if not rows:
            continue
        vocabulary = np.unique(np.concatenate([np.array(r.terms) for r in rows]).astype(np.int64).view(np.uint64))
        index = _index(texts, vocabulary)
        n_docs, n_terms = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            continue
        df = np.zeros(len(vocabulary), np.int64)
        for t, n in index.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            df[t] = n
        weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
        weights[df == 0] = 0
        terms = []
        for r in rows:
            own = np.searchsorted(vocabulary, np.array(r.terms, np.int64).view(np.uint64))
            own = np.sort(own[weights[own] > 0])
            terms.append(own[np.argsort(df[own], kind="stable")])
        found.append(_scored(index, np.array([r.key for r in rows]), terms, weights, n_docs, n_terms, k))
    if not found:
        empty = asked.where(F.lit(False))
        return empty.select(F.col("item").alias("item_id"), F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"),
                            F.lit(0).cast("bigint").alias("score"))
    some = reduce(DataFrame.unionByName, found).withColumn("lane", F.pmod(F.spark_partition_id(), F.lit(LANES)))
    best = _first(_first(some, k, "key", "lane").drop("rank", "lane"), k, "key")
    return best.join(asked.select("key", "item"), "key").select(
        F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")
