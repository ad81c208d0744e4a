"""Toxicity scores by a convolutional text classifier trained in numpy.

Words are hashed into a table of embeddings; filters of several widths slide
over them, each filter's largest value over the whole text is kept, and a
logistic layer weighs those.  The fit sees a bounded sample of labelled
documents; part of it is held back to calibrate a decision threshold per
language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import bounded_sample
from .shared import cut, slices
from .words import NOT_LETTER, word_hashes

#: log2 of the embedding rows, and values in each; row 0 pads.
BUCKET_BITS = 16
DIMS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Labelled documents of each label that the fit may see, and the words of all their texts together.
DOCS_PER_LABEL = 4000
MOST_WORDS = 20_000_000
EPOCHS = 4
#: A small sample is gone through more often, up to this many steps.
LEAST_STEPS = 400
BATCH = 64
RATE = 0.005
#: Words (embedding rows) in fewer texts of the sample keep a zero embedding, so that rare words
#: are not learnt by heart.
MIN_TEXTS = 8
#: Texts by which a word's log odds are drawn to those of the sample, for the start of its first value.
PRIOR_TEXTS = 4.0
#: Share of a text's words hidden at each step, so that no filter rests on one word of a text.
HIDDEN_WORDS = 0.3
#: Part of the sample that calibrates thresholds.
HELD_BACK = 0.2


@dataclass
class TextCnn:
    weights: dict[str, np.ndarray]
    #: Decision threshold by language; the default for others.
    thresholds: dict[str, float] = field(default_factory=dict)
    default_threshold: float = 0.5


def word_buckets(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of all words (runs of letters) of a buffer, each text followed by pads; where texts start."""
    hashes, first, _, _ = word_hashes(buf, offsets, NOT_LETTER)
    rows = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    rows[rows == 0] = 1
    pads = max(WIDTHS)
    starts = first + pads * np.arange(len(first))
    out = np.zeros(len(rows) + pads * (len(first) - 1), np.int64)
    out[np.arange(len(rows)) + pads * np.repeat(np.arange(len(first) - 1), np.diff(first))] = rows
    return out, starts


def _start(rng: np.random.Generator) -> dict[str, np.ndarray]:
    w = {"e": rng.normal(0, 0.02, (2**BUCKET_BITS, DIMS)), "o": rng.normal(0, 0.3, len(WIDTHS) * FILTERS),
         "c": np.zeros(1)}
    w["e"][0] = 0
    for width in WIDTHS:
        w[f"k{width}"] = rng.normal(0, (width * DIMS) ** -0.5, (width * DIMS, FILTERS))
        w[f"b{width}"] = np.zeros(FILTERS)
    return {k: v.astype(np.float32) for k, v in w.items()}


def _pooled(w: dict[str, np.ndarray], rows: np.ndarray, starts: np.ndarray):
    """(text, filter) maxima, and for each width the inputs of its filters and their values."""
    table = w["e"][rows]
    pools, tape = [], []
    for width in WIDTHS:
        n = len(rows) - width + 1
        seen = table if width == 1 else np.concatenate([table[k: n + k] for k in range(width)], axis=1)
        values = seen @ w[f"k{width}"]
        values += w[f"b{width}"]
        np.maximum(values, 0, out=values)
        pools.append(np.maximum.reduceat(values, starts[:-1], axis=0))
        tape.append((seen, values))
    return np.concatenate(pools, axis=1), tape


def probabilities(w: dict[str, np.ndarray], rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    pools, _ = _pooled(w, rows, starts)
    return 1 / (1 + np.exp(-np.clip(pools @ w["o"] + w["c"], -30, 30)))


def _adam(w, state, key, grad, step, rate, rows=slice(None)):
    first, second = state[key]
    first[rows] += 0.1 * (grad - first[rows])
    second[rows] += 0.01 * (grad * grad - second[rows])
    w[key][rows] -= rate * (first[rows] / (1 - 0.9**step)) / (np.sqrt(second[rows] / (1 - 0.99**step)) + 1e-7)


def train_weights(texts: list[tuple[np.ndarray, int]], seed: int = 11) -> dict[str, np.ndarray]:
    """Weights fitted to (padded embedding rows, label 0 or 1)."""
    rng = np.random.default_rng(seed)
    w = _start(rng)
    seen_in = np.bincount(np.concatenate([np.unique(t) for t, _ in texts]), minlength=2**BUCKET_BITS)
    rare = seen_in < MIN_TEXTS
    rare[0] = True
    w["e"][rare] = 0
    ones = np.bincount(np.concatenate([np.unique(t) for t, y in texts if y]), minlength=2**BUCKET_BITS)
    share = sum(y for _, y in texts) / len(texts)
    odds = np.log((ones + PRIOR_TEXTS * share) / (seen_in - ones + PRIOR_TEXTS * (1 - share))) - np.log(
        share / (1 - share))
    w["e"][:, 0] = np.where(rare, 0, odds)
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    step, rounds = 0, -(-len(texts) // BATCH)
    epochs = max(EPOCHS, LEAST_STEPS // rounds)
    total = epochs * rounds
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            part = [texts[i] for i in order[at: at + BATCH]]
            rows = np.concatenate([t for t, _ in part])
            rows = np.where(rng.random(len(rows)) < HIDDEN_WORDS, 0, rows)
            starts = np.concatenate([[0], np.cumsum([len(t) for t, _ in part])])
            pools, tape = _pooled(w, rows, starts)
            p = 1 / (1 + np.exp(-np.clip(pools @ w["o"] + w["c"], -30, 30)))
            error = ((p - np.array([y for _, y in part])) / len(part)).astype(np.float32)
            to_pools = error[:, None] * w["o"][None, :] * (pools > 0)
            grads = {"o": pools.T @ error, "c": error.sum(keepdims=True)}
            touched, moved = [], []
            for i, width in enumerate(WIDTHS):
                seen, values = tape[i]
                g = to_pools[:, i * FILTERS: (i + 1) * FILTERS]
                spots = np.stack([a + values[a: min(b, len(values))].argmax(axis=0)
                                  for a, b in zip(starts[:-1], starts[1:])])
                kernel = w[f"k{width}"]
                grads[f"k{width}"] = np.einsum("dfx,df->xf", seen[spots], g)
                grads[f"b{width}"] = g.sum(axis=0)
                back = g[:, :, None] * kernel.T[None, :, :]
                for k in range(width):
                    touched.append(rows[spots + k].ravel())
                    moved.append(back[:, :, k * DIMS: (k + 1) * DIMS].reshape(-1, DIMS))
            ids, where = np.unique(np.concatenate(touched), return_inverse=True)
            flow = np.zeros((len(ids), DIMS), np.float32)
            np.add.at(flow, where, np.concatenate(moved))
            step += 1
            rate = RATE * (1 - (step - 1) / total)
            for k, g in grads.items():
                _adam(w, state, k, g, step, rate)
            flow[rare[ids]] = 0
            _adam(w, state, "e", flow, step, rate, ids)
    return w


def best_threshold(scores: np.ndarray, labels: np.ndarray) -> float:
    """The score from which on calling label 1 gives the best F1."""
    order = np.argsort(-scores)
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + max(1, labels.sum()))
    return float(scores[order][int(f1.argmax())])


def train(texts: list[str], labels: list[int], languages: list[str | None], seed: int = 11,
          min_calibration: int = 50) -> TextCnn | None:
    """A classifier of texts, with thresholds by language; None unless both labels occur."""
    raw = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    return train_rows([word_buckets(r, np.array([0, len(r)]))[0] for r in raw], labels, languages, seed, min_calibration)


def train_rows(rows: list[np.ndarray], labels: list[int], languages: list[str | None], seed: int = 11,
               min_calibration: int = 50) -> TextCnn | None:
    """As ``train``, from the embedding rows of each text."""
    if len(set(labels)) < 2:
        return None
    rng = np.random.default_rng(seed)
    back = rng.random(len(rows)) < HELD_BACK
    ys = np.array(labels)
    if len(set(ys[~back])) < 2 or len(set(ys[back])) < 2:
        back[:] = False
    w = train_weights([(r, int(y)) for r, y, b in zip(rows, ys, back) if not b], seed)
    model = TextCnn(w)
    if back.any():
        held = np.flatnonzero(back)
        scores = np.array([probabilities(w, rows[i], np.array([0, len(rows[i])]))[0] for i in held])
        model.default_threshold = best_threshold(scores, ys[held])
        tags = np.array([str(languages[i]) for i in held])
        for tag in set(tags):
            own = tags == tag
            if own.sum() >= min_calibration and 0 < ys[held][own].sum() < own.sum():
                model.thresholds[tag] = best_threshold(scores[own], ys[held][own])
    return model


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", label_col: str = "toxic", docs_per_label: int = DOCS_PER_LABEL) -> TextCnn | None:
    """Fit on at most ``docs_per_label`` (with a fifth of slack) labelled documents of each label where ``learn`` holds.

    Whole texts of any length take part: the tasks turn those of the sample
    into embedding rows, two bytes a word, and the documents are taken in the
    order of the draw until their words would pass ``MOST_WORDS``.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(
        "id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.max("label").alias("label"))
    usable = docs.where(learn & F.col(text_col).isNotNull())
    # the sample is drawn without the texts; those of its rows, a bounded number, are worked on afterwards
    rows = usable.select(F.col(id_col).cast("bigint").alias("id"), F.col(lang_col).alias("lang")).join(marks, "id").distinct()
    sample = {r.id: r for r in bounded_sample(rows, "label", F.col("id"), docs_per_label)}
    if not sample:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, buf, offsets in slices(batch.column(1)):
                found, starts = word_buckets(buf, offsets)
                found = found.astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(offsets) - 1),
                     pa.array([found[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])], pa.binary())], ["id", "words"])

    ids = docs.sparkSession.createDataFrame([(i,) for i in sorted(sample)], "id bigint")
    texts = cut(usable.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
                .join(F.broadcast(ids), "id").mapInArrow(run, "id bigint, words binary")
                .groupBy("id").agg(F.min("words").alias("words")))
    sizes = {r.id: r.n // 2 for r in texts.select("id", F.octet_length("words").alias("n")).collect()}
    order = [i for i in sample if i in sizes]
    total = np.cumsum([sizes[i] for i in order])
    chosen = [i for i, t in zip(order, total.tolist()) if t <= MOST_WORDS]
    found = sorted((sample[r.id].label, str(r.id), bytes(r.words), sample[r.id].lang)
                   for r in texts.where(F.col("id").isin(chosen) if len(chosen) < len(order) else F.lit(True)).collect())
    return train_rows([np.frombuffer(f[2], np.uint16).astype(np.int64) for f in found], [f[0] for f in found], [f[3] for f in found])


def score(docs: DataFrame, model: TextCnn | None, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str | None = None) -> DataFrame:
    """``doc_id, score`` of every whole text; only the text is read.

    With ``lang_col`` a column ``decision`` follows: 1 where the score reaches
    the model's threshold of the row's language, or its default for other and
    null languages, else 0; without a model always 0.

    Null, empty and wordless texts get the score of a text of pads.  Without a
    model (no labels of both kinds) every score is 0.  Repeated rows repeat, a
    null id stays null, other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, buf, offsets in slices(batch.column(1), 1 << 18):
                if model is None:
                    p = np.zeros(len(offsets) - 1)
                else:
                    p = probabilities(model.weights, *word_buckets(buf, offsets))
                columns = [batch.column(0).slice(at, len(p)), pa.array(p.astype(np.float64))]
                if lang_col is not None:
                    tags = batch.column(2).slice(at, len(p)).to_pylist()
                    least = [np.inf if model is None else model.thresholds.get(t, model.default_threshold) for t in tags]
                    columns.append(pa.array((p >= np.array(least)).astype(np.int32)))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "score"] + ["decision"] * (lang_col is not None)
    tag = [] if lang_col is None else [F.col(lang_col).cast("string").alias("lang")]
    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *tag)
            .mapInArrow(run, "doc_id bigint, score double" + ", decision int" * (lang_col is not None)))
