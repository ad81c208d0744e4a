"""Quality rules: statistics of whole texts, and boosted trees over them.

Statistics are worked out per text in numpy from one pass over its bytes.
The trees (``boosting.py``) learn from a bounded sample of labelled documents;
shares of symbols, of repeated words and of repeated lines may only lower the
score.  The lowest score that is kept is set on labelled rows left out of the
fit, so that nearly all good ones stay.

Words are runs of bytes other than space and 0x09 to 0x0D, taken as they are;
lines end at line feeds.  Equal words, word windows and lines are told by
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting
from .sampling import bounded_sample
from .shared import cut, slices
from .words import BYTE_VALUE, SPACES, mix, span_hashes, word_hashes

#: The columns of the contract, then further counts that the trees look at.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_bytes", "n_chars", "n_lines", "n_digits", "n_upper", "n_lower", "n_marks", "n_exclaims", "n_plain_words", "n_distinct_words",
        "n_twins", "n_top_word", "n_long_words"]
#: Features from the counts, and the direction in which each may move the score.
FEATURES = {"words": 0, "word_length": 0, "symbols": -1, "dup_lines": -1, "repeats": -1, "twins": -1, "line_words": 0,
            "digits": 0, "upper": 0, "marks": 0, "exclaims": -1, "plain_words": 1, "distinct": 0, "top_word": -1, "long_words": 0}
#: Labelled documents of each label that the fit may see, and the part of them that sets the least score.
DOCS_PER_LABEL, HELD_BACK = 3000, 0.3
#: The share of good documents left out of the fit that the least score must keep.
KEEP_GOOD = 0.995
LONG_WORD = 24


def _flags(*ranges) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for low, high in ranges:
        out[low: high + 1] = True
    return out


_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_DIGITS, _UPPER, _LOWER = _flags((48, 57)), _flags((65, 90)), _flags((97, 122))
_MARKS = _flags((33, 47), (58, 64), (91, 96), (123, 126))
_FOLLOWING = _flags((128, 191))
_EXCLAIM = _flags((33, 33))


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flags are set between neighbouring places of ``at``."""
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[at])


def _groups(text: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, number of the (text, hash) group by order, size of each group)."""
    order = np.lexsort((hashes, text))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (text[order][1:] != text[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    group = np.cumsum(new) - 1
    return order, group, np.bincount(group)


def statistics(buf: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """``COUNTS`` and ``MORE`` of every text of a buffer."""
    n = len(offsets) - 1
    words, first, starts, ends = word_hashes(buf, offsets, SPACES, lower=False)
    n_words = np.diff(first)
    text = np.repeat(np.arange(n), n_words)
    out = {"n_words": n_words, "n_bytes": np.diff(offsets), "n_chars": _per_text(~_FOLLOWING[buf], offsets)}
    out["word_chars"] = _per_text(~_FOLLOWING[buf] & ~SPACES[buf], offsets)
    for name, flags in (("n_symbols", _SYMBOLS), ("n_digits", _DIGITS), ("n_upper", _UPPER), ("n_lower", _LOWER),
                        ("n_marks", _MARKS), ("n_exclaims", _EXCLAIM)):
        out[name] = _per_text(flags[buf], offsets)
    # lines with a word, and those of them that repeat an earlier one
    feeds = np.flatnonzero(buf == 10)
    line_text = np.concatenate([np.arange(n), np.searchsorted(offsets, feeds, "right") - 1])
    begin, end = np.concatenate([offsets[:-1], feeds + 1]), np.concatenate([np.zeros(n, np.int64), feeds])
    order = np.lexsort((begin, line_text))
    begin, line_text = begin[order], line_text[order]
    last = np.ones(len(begin), dtype=bool)
    last[:-1] = line_text[1:] != line_text[:-1]
    end = np.where(last, offsets[line_text + 1], np.append(begin[1:], 0) - 1)
    inside = np.concatenate([[0], np.cumsum(~SPACES[buf])])
    used = inside[end] > inside[begin]
    begin, end, line_text = begin[used], end[used], line_text[used]
    out["n_lines"] = np.bincount(line_text, minlength=n)
    order, group, size = _groups(line_text, span_hashes(buf, begin, end, BYTE_VALUE))
    owner = np.zeros(len(size), np.int64)
    owner[group] = line_text[order]
    out["n_dup_lines"] = out["n_lines"] - np.bincount(owner, minlength=n)
    # words in windows of three that occur twice or more
    repeated = np.zeros(len(words), dtype=bool)
    if len(words) >= 3:
        own = np.flatnonzero(text[:-2] == text[2:])
        window = mix(mix(mix(words[own]) + words[own + 1]) + words[own + 2])
        order, group, size = _groups(text[own], window)
        twice = own[order[size[group] > 1]]
        for k in range(3):
            repeated[twice + k] = True
    out["n_repeat_words"] = _per_text(repeated, first)
    twin = np.zeros(len(words), dtype=bool)
    twin[1:] = (words[1:] == words[:-1]) & (text[1:] == text[:-1])
    out["n_twins"] = _per_text(twin, first)
    odd = np.concatenate([[0], np.cumsum(_MARKS[buf] | _DIGITS[buf])])
    out["n_plain_words"] = _per_text(odd[ends - 1] == odd[starts], first)
    out["n_long_words"] = _per_text(ends - starts > LONG_WORD, first)
    order, group, size = _groups(text, words)
    owner = np.zeros(len(size), np.int64)
    owner[group] = text[order]
    out["n_distinct_words"] = np.bincount(owner, minlength=n)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner, size)
    out["n_top_word"] = top
    return out


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    """Rows of ``FEATURES`` from counts; every share of nothing is 0."""

    def share(a: str, b: str) -> np.ndarray:
        return c[a] / np.maximum(c[b], 1)

    return np.stack([np.log1p(c["n_words"]), share("word_chars", "n_words"), share("n_symbols", "n_words"),
                     share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"), share("n_twins", "n_words"),
                     share("n_words", "n_lines"), share("n_digits", "n_chars"),
                     c["n_upper"] / np.maximum(c["n_upper"] + c["n_lower"], 1), share("n_marks", "n_words"),
                     share("n_exclaims", "n_words"), share("n_plain_words", "n_words"), share("n_distinct_words", "n_words"),
                     share("n_top_word", "n_words"), share("n_long_words", "n_words")], axis=1)


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and all counts of every whole text; a null text is empty."""
    names = COUNTS + MORE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, buf, offsets in slices(batch.column(1)):
                c = statistics(buf, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(offsets) - 1)] + [pa.array(c[k].astype(np.int64)) for k in names],
                    ["doc_id", *names])

    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id bigint, " + ", ".join(f"{k} bigint" for k in names)))


@dataclass
class Judge:
    forest: boosting.Forest
    least: float


def train(x: np.ndarray, y: np.ndarray, seed: int = 5) -> Judge | None:
    """Trees with the least score that keeps ``KEEP_GOOD`` of the good rows left out; None unless both labels occur."""
    if len(set(y.tolist())) < 2:
        return None
    back = np.random.default_rng(seed).random(len(y)) < HELD_BACK
    if len(set(y[~back].tolist())) < 2 or not y[back].any():
        back[:] = False
    forest = boosting.train(x[~back], y[~back], np.array(list(FEATURES.values())))
    held = back if back.any() else ~back
    good = forest.probability(x[held][y[held] == 1])
    return Judge(forest, min(0.5, float(np.quantile(good, 1 - KEEP_GOOD, method="lower"))))


def fit(counts: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
        docs_per_label: int = DOCS_PER_LABEL) -> Judge | None:
    """A judge from at most ``docs_per_label`` (with a fifth of slack) labelled rows of each label; 1 is good.

    Labels other than 0 and 1 and null ids are left out; of several labels of
    one id the highest counts.
    """
    marks = labels.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("int").alias("label")).where(
        "id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    rows = counts.join(marks, counts.doc_id == marks.id).drop("id")
    sample = sorted(tuple(r) for r in bounded_sample(rows, "label", F.col("doc_id"), docs_per_label))
    if not sample:
        return None
    table = np.array(sample, dtype=np.int64).T
    return train(features(dict(zip(COUNTS + MORE, table[1:-1]))), table[-1])


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "quality", docs_per_label: int = DOCS_PER_LABEL) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``kept`` and ``score`` of every whole text.

    ``base_failed``: fewer than 50 words, or over half of the words in windows
    of three words that occur twice or more.  Such texts are not kept; others
    are if the trees' score reaches the least score.  Null and empty texts have
    counts of 0 and fail.  Repeated rows repeat, a null id stays null, other
    columns are ignored, whatever their names.  Without labels of both kinds
    the score is null and the base rules alone decide.
    """
    counts = cut(counted(docs, id_col, text_col))
    judge = fit(counts, labels, id_col, label_col, docs_per_label)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c = {k: np.asarray(batch.column(i + 1)) for i, k in enumerate(COUNTS + MORE)}
            p = judge.forest.probability(features(c))
            yield pa.RecordBatch.from_arrays(batch.columns[:len(COUNTS) + 1] + [pa.array(p)], ["doc_id", *COUNTS, "score"])

    if judge is None:
        scored = counts.select("doc_id", *COUNTS, F.lit(None).cast("double").alias("score"))
    else:
        scored = counts.mapInArrow(run, "doc_id bigint, " + ", ".join(f"{k} bigint" for k in COUNTS) + ", score double")
    good = F.lit(True) if judge is None else F.col("score") >= judge.least
    return scored.select("doc_id", *COUNTS, failed.alias("base_failed"), (~failed & good).alias("kept"), "score")
