"""Language identification by a bidirectional gated recurrent network over bytes.

The network labels every byte of a text; a document's probabilities are the
mean over its letter bytes.  Texts are cut into windows of ``WINDOW`` bytes
that run side by side in numpy; the whole text is read.  Training is
backpropagation through time over a window, with Adam, on a bounded sample
of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sampling import bounded_sample
from .shared import slices
from .words import NOT_LETTER

WINDOW = 64
HIDDEN = 8
#: Labelled documents per language that the fit may see, and windows of each.
DOCS_PER_LANGUAGE = 400
WINDOWS_PER_DOC = 8
EPOCHS = 4
#: A small sample is gone through more often, up to this many steps.
LEAST_STEPS = 200
BATCH = 192
RATE = 0.01
#: What a text without letters is called.
UNDETERMINED = "und"

_LETTER = ~NOT_LETTER
_HAS_LETTER = regex.compile(r"\p{L}").search

#: log2 of the places for triples of bytes seen in training; the part of the sample's documents that adds none but
#: sets the least share of known triples, as this part of what all but one in 200 of its documents reach.
SEEN_BITS, LEFT_OUT, SLACK = 18, 0.25, 0.75


@dataclass
class Network:
    """Weights of both directions and the output layer, and what training has seen of each language's spelling."""

    languages: list[str]
    weights: dict[str, np.ndarray]
    #: Packed bits of the seen triples, and the share of known ones below which a text is in no learned language.
    seen: np.ndarray | None = None
    least_known: float = 0.0


_SMALL = np.arange(256, dtype=np.uint32)
_SMALL[65:91] += 32


def _triples(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each triple of bytes (A-Z lower-cased), and whether its middle is of a letter."""
    low = _SMALL[data]
    code = (low[:-2] << np.uint32(16) | low[1:-1] << np.uint32(8) | low[2:]) * np.uint32(2654435761)
    return code >> np.uint32(32 - SEEN_BITS), _LETTER[data[1:-1]]


def known_shares(net: Network, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Share of the letters' byte triples of each text that training has seen; 1 for a text without any."""
    n = len(offsets) - 1
    if net.seen is None or len(buf) < 3:
        return np.ones(n)
    place, letter = _triples(buf)
    known = (net.seen[place >> np.uint32(3)] >> (np.uint32(7) - (place & np.uint32(7))).astype(np.uint8) & 1).astype(bool)
    whole = np.concatenate([[0], np.cumsum(letter)])
    good = np.concatenate([[0], np.cumsum(letter & known)])
    begin = np.minimum(offsets[:-1], len(letter))
    end = np.maximum(np.minimum(offsets[1:] - 2, len(letter)), begin)
    total = whole[end] - whole[begin]
    return np.where(total > 0, (good[end] - good[begin]) / np.maximum(total, 1), 1.0)


def learn_spelling(net: Network, docs: list[list[bytes]], seed: int = 9) -> None:
    """Sets the seen triples and the least known share from the windows of each document of the sample."""
    out = np.random.default_rng(seed).random(len(docs)) < LEFT_OUT
    bits = np.zeros(1 << SEEN_BITS, dtype=bool)
    for windows, left_out in zip(docs, out):
        for w in windows if not left_out else []:
            if len(w) >= 3:
                place, letter = _triples(np.frombuffer(w, np.uint8))
                bits[place[letter]] = True
    net.seen = np.packbits(bits)
    held = [b" ".join(w) for w, left_out in zip(docs, out) if left_out]
    if held:
        shares = known_shares(net, np.frombuffer(b"".join(held), np.uint8), np.concatenate([[0], np.cumsum([len(h) for h in held])]))
        net.least_known = SLACK * float(np.quantile(shares, 0.005, method="lower"))


def _start(n_out: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    w: dict[str, np.ndarray] = {"c": np.zeros(n_out)}
    for d in "fb":
        w["x" + d] = rng.normal(0, 0.3, (256, 3 * HIDDEN))
        w["x" + d][:, : 2 * HIDDEN] += 0.5
        w["u" + d] = rng.normal(0, 0.5 * HIDDEN**-0.5, (3 * HIDDEN, HIDDEN))
        w["b" + d] = np.zeros((HIDDEN, 1))
        w["v" + d] = rng.normal(0, HIDDEN**-0.5, (n_out, HIDDEN))
    return {k: v.astype(np.float32) for k, v in w.items()}


def _direction(w: dict[str, np.ndarray], d: str, data: np.ndarray, keep: bool):
    """States (step, unit, window) of one direction over bytes (step, window).

    A gated recurrent unit whose gates are clipped to 0..1 and whose candidate
    is x / (1 + |x|): the same shape as sigmoid and tanh at a fraction of the cost.
    """
    steps, size = data.shape
    x, u, b = w["x" + d], w["u" + d], w["b" + d]
    h = np.zeros((HIDDEN, size), np.float32)
    states = np.empty((steps, HIDDEN, size), np.float32)
    tape = []
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        a = np.ascontiguousarray(x.take(data[t], axis=0).T)
        g = u @ h
        gates = a[: 2 * HIDDEN]
        gates += g[: 2 * HIDDEN]
        np.clip(gates, 0, 1, out=gates)
        z, r = gates[:HIDDEN], gates[HIDDEN:]
        inner = g[2 * HIDDEN:]
        inner += b
        new = a[2 * HIDDEN:]
        new += r * inner
        scale = np.abs(new)
        scale += 1
        new /= scale
        if keep:
            tape.append((t, h, gates, inner, new, scale))
        h = h - new
        h *= z
        h += new
        states[t] = h
    return states, tape


def _probabilities(w: dict[str, np.ndarray], forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    """(step, language, window)."""
    p = w["vf"] @ forward
    p += w["vb"] @ backward
    p += w["c"][:, None]
    np.clip(p, -40, 40, out=p)
    np.exp(p, out=p)
    p /= p.sum(axis=1, keepdims=True)
    return p


def _gradients(w: dict[str, np.ndarray], data: np.ndarray, wanted: np.ndarray, weight: np.ndarray):
    """Gradients of the mean cross-entropy over the weighted positions of a batch."""
    runs = {d: _direction(w, d, data, True) for d in "fb"}
    p = _probabilities(w, runs["f"][0], runs["b"][0])
    p[:, wanted, np.arange(data.shape[1])] -= 1
    p *= (weight / max(weight.sum(), 1))[:, None, :]
    grads = {"c": p.sum(axis=(0, 2))}
    for d in "fb":
        states, tape = runs[d]
        u = w["u" + d]
        grads["v" + d] = np.tensordot(p, states, axes=([0, 2], [0, 2]))
        gx, gu, gb = np.zeros_like(w["x" + d]), np.zeros_like(u), np.zeros_like(w["b" + d])
        dh = np.zeros((HIDDEN, data.shape[1]), np.float32)
        from_out = w["v" + d].T @ p
        for t, h, gates, inner, new, scale in reversed(tape):
            dh = dh + from_out[t]
            z, r = gates[:HIDDEN], gates[HIDDEN:]
            pre = dh * (1 - z) / (scale * scale)
            open_ = (gates > 0) & (gates < 1)
            to_gates = np.concatenate([dh * (h - new), pre * inner]) * open_
            to_g = np.concatenate([to_gates, pre * r])
            gu += to_g @ h.T
            gb += to_g[2 * HIDDEN:].sum(axis=1, keepdims=True)
            np.add.at(gx, data[t], np.concatenate([to_gates, pre]).T)
            dh = dh * z + u.T @ to_g
        grads |= {"x" + d: gx, "u" + d: gu, "b" + d: gb}
    return grads


def train(texts: list[bytes], labels: list[str], seed: int = 5) -> Network | None:
    """A network fitted to windows drawn from labelled texts; None without any label."""
    rng = np.random.default_rng(seed)
    windows = [(text[at: at + WINDOW], label) for text, label in zip(texts, labels) if text
               for at in rng.integers(0, max(1, len(text) - WINDOW + 1), min(WINDOWS_PER_DOC, 1 + len(text) // WINDOW))]
    return train_windows(windows, sorted(set(labels)), seed)


def train_windows(windows: list[tuple[bytes, str]], languages: list[str], seed: int = 5) -> Network | None:
    """A network fitted to labelled windows of at most ``WINDOW`` bytes; None without any language."""
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    rows = [np.frombuffer(text.ljust(WINDOW, b"\0"), np.uint8) for text, _ in windows]
    wanted = [languages.index(label) for _, label in windows]
    w = _start(len(languages), rng)
    if rows:
        data, out = np.stack(rows), np.array(wanted)
        first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
        step, rounds = 0, -(-len(data) // BATCH)
        epochs = max(EPOCHS, LEAST_STEPS // rounds)
        total = epochs * rounds
        for _ in range(epochs):
            order = rng.permutation(len(data))
            for at in range(0, len(order), BATCH):
                part = order[at: at + BATCH]
                bytes_ = data[part].T.astype(np.intp)
                grads = _gradients(w, bytes_, out[part], _LETTER[bytes_].astype(np.float32))
                step += 1
                rate = RATE * (1 - (step - 1) / total)
                for k, g in grads.items():
                    g = np.clip(g, -1, 1)
                    first[k] += np.float32(0.1) * (g - first[k])
                    second[k] += np.float32(0.01) * (g * g - second[k])
                    w[k] = (w[k] - rate * (first[k] / (1 - 0.9**step))
                            / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return Network(languages, w)


def pooled(net: Network, buf: np.ndarray, offsets: np.ndarray, batch: int = 2048) -> np.ndarray:
    """(text, language): mean probabilities over the letter bytes of each text of a buffer."""
    n_texts, n_out = len(offsets) - 1, len(net.languages)
    sizes = np.diff(offsets)
    counts = -(-sizes // WINDOW)
    owner = np.repeat(np.arange(n_texts), counts)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    begin, end = offsets[owner] + nth * WINDOW, offsets[owner + 1]
    sums, letters = np.zeros((n_texts, n_out)), np.zeros(n_texts)
    lane = np.arange(WINDOW)[:, None]
    for at in range(0, len(owner), batch):
        place = begin[None, at: at + batch] + lane
        inside = place < end[None, at: at + batch]
        data = np.where(inside, buf[np.minimum(place, len(buf) - 1)], 0).astype(np.intp)
        weight = (_LETTER[data] & inside).astype(np.float32)
        p = _probabilities(net.weights, _direction(net.weights, "f", data, False)[0],
                           _direction(net.weights, "b", data, False)[0])
        who = owner[at: at + batch]
        np.add.at(sums, who, np.einsum("tlw,tw->wl", p, weight))
        np.add.at(letters, who, weight.sum(axis=0))
    return sums / np.maximum(letters, 1)[:, None]


def fit(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang", docs_per_language: int = DOCS_PER_LANGUAGE) -> Network | None:
    """Fit on at most ``docs_per_language`` (with a fifth of slack) documents of each language where ``learn`` holds.

    The tasks cut ``WINDOWS_PER_DOC`` windows of each document in the sample,
    fewer of short ones, at places drawn over its whole text; only those come
    to the driver.
    """
    text = F.col(text_col).cast("binary")
    many = F.least(F.lit(WINDOWS_PER_DOC), 1 + F.floor(F.octet_length(text) / WINDOW).cast("int"))
    room = F.greatest(F.lit(1), F.octet_length(text) - WINDOW + 1)
    windows = F.transform(F.sequence(F.lit(1), many), lambda k: F.substring(
        text, (1 + F.pmod(F.xxhash64(F.col(id_col), k, F.lit(5)), room)).cast("int"), F.lit(WINDOW)))
    rows = docs.where(learn & F.col(lang_col).isNotNull() & (F.octet_length(text) > 0)).select(
        F.col(lang_col).alias("lang"), windows.alias("windows"), F.col(id_col).alias("id"))
    sample = sorted((r.lang, str(r.id), [bytes(w) for w in r.windows]) for r in bounded_sample(rows, "lang", F.col("id"), docs_per_language))
    net = train_windows([(w, lang) for lang, _, ws in sample for w in ws], sorted({lang for lang, *_ in sample}))
    if net is not None:
        learn_spelling(net, [ws for *_, ws in sample])
    return net


def identify(docs: DataFrame, net: Network | None, text_col: str = "text",
             pred_col: str = "lang_pred", score_col: str = "score", reject: bool = False,
             text_back: bool = True) -> DataFrame:
    """All columns of ``docs`` and the predicted language and its score, 0 to 1; without ``text_back`` all but the text.

    With ``reject`` a text whose spelling training has hardly seen, in
    whatever language or none, is ``und`` with score 0 too: the best of the
    learned languages is then no answer.

    ``und`` with score 0 for null, empty and letterless texts, and for every
    text where nothing could be learned.  Only the text is read for the prediction.
    Columns of ``docs`` with the names of the two new ones are replaced; repeated
    rows repeat; an empty table gives an empty result.
    """
    docs = docs.drop(pred_col, score_col)
    names = docs.columns
    back = [n for n in names if text_back or n != text_col]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in back)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(names.index(text_col))
            preds: list[str] = []
            scores: list[float] = []
            for at, buf, offsets in slices(column):
                p = pooled(net, buf, offsets) if net else None
                strange = known_shares(net, buf, offsets) < net.least_known if net and reject else np.zeros(len(offsets) - 1, bool)
                raw, ends = buf.tobytes(), offsets.tolist()
                for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
                    if p is not None and b > a and not strange[i] and _HAS_LETTER(raw[a:b].decode("utf-8", "replace")):
                        best = int(p[i].argmax())
                        preds.append(net.languages[best])
                        scores.append(float(min(1.0, p[i, best])))
                    else:
                        preds.append(UNDETERMINED)
                        scores.append(0.0)
            yield pa.RecordBatch.from_arrays([*(batch.column(names.index(n)) for n in back), pa.array(preds, pa.string()),
                                              pa.array(scores, pa.float64())], [*back, pred_col, score_col])

    return docs.mapInArrow(run, f"{fields}{', ' if fields else ''}`{pred_col}` string, `{score_col}` double")
