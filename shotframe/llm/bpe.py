"""Token counts by byte-pair merging with a heap over a linked list.

The counts are those of a public tokenizer file whose model is BPE over
byte-level symbols with an end-of-word suffix.  A piece of n bytes starts as
n symbols; the adjacent pair of lowest rank (leftmost first) is merged again
and again, and the count is n minus the number of merges.  No identifiers are
made.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pieces whose counts a worker keeps; when full, the memory starts anew.
KEPT_PIECES = 400_000

#: Unicode White_Space, as the tokenizer file's ``\s``.
WHITE_SPACE = "\\x09-\\x0D\\x20\\x85\\xA0  -     　"


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbols = {b: chr(b) for b in plain}
    for b in range(256):
        symbols.setdefault(b, chr(256 + len(symbols) - len(plain)))
    return [symbols[b] for b in range(256)]


def merges_needed(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """How many merges bring a list of symbols to its end."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    text: list[str | None] = list(symbols)
    heap = [(r, i, pair) for i, pair in enumerate(zip(symbols, symbols[1:])) if (r := ranks.get(pair)) is not None]
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, (left, right) = heapq.heappop(heap)
        j = after[i]
        if text[i] != left or j >= n or text[j] != right:
            continue
        text[i], text[j] = left + right, None
        after[i] = k = after[j]
        merges += 1
        if k < n:
            before[k] = i
            if (r := ranks.get(pair := (text[i], text[k]))) is not None:
                heapq.heappush(heap, (r, i, pair))
        if (h := before[i]) >= 0 and (r := ranks.get(pair := (text[h], text[i]))) is not None:
            heapq.heappush(heap, (r, h, pair))
    return merges


class Counter49k:
    """Counts tokens of texts by the rules and merges of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix"):
            raise ValueError(f"{path}: not a byte-pair model with an end-of-word suffix")
        self.suffix = model["end_of_word_suffix"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        self.symbols = _byte_symbols()
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"].replace("\\s", WHITE_SPACE)).findall
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.known: dict[str, int] = {}

    def piece(self, piece: str) -> int:
        symbols = [self.symbols[b] for b in piece.encode()]
        symbols[-1] += self.suffix
        return len(symbols) - merges_needed(symbols, self.ranks)

    def _plain(self, text: str) -> int:
        text = unicodedata.normalize("NFC", text)
        # one character at a time where lower-casing a word would look at its neighbours
        text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        known, total = self.known, 0
        for piece, times in Counter(self.pieces(text)).items():
            n = known.get(piece)
            if n is None:
                n = self.piece(piece)
                if len(known) >= KEPT_PIECES:
                    known.clear()
                if len(piece) <= 64:
                    known[piece] = n
            total += n * times
        return total

    def count(self, text: str) -> int:
        """Tokens of a whole text; special strings inside it are one token each."""
        if self.special is None or "<" not in text:
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))


@functools.lru_cache(maxsize=4)
def _counter(path: str) -> Counter49k:
    return Counter49k(path)


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text.

    A null or empty text has no bytes and no tokens.  Rows are taken one by
    one: repeated rows repeat, a null id stays null, other columns are
    ignored.  ``tokenizer_path`` must be readable on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(tokenizer_path).count
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pc.cast(pc.binary_length(texts), pa.int64()),
                 pa.array([count(t.as_py()) for t in texts], pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    return (docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
            .withColumn("over_limit", F.col("n_tokens") > limit))
