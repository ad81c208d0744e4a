"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts and items are sequences of words (runs of letters and digits, A-Z
lower-cased).  A CGK walk reads a sequence from a start: at each step it
emits the word under its pointer and moves on by a random bit that depends on
the step and the word, so that edit distance becomes Hamming distance between
the emitted strings.  Each repetition has its own random bits, its own starts
inside the items and its own sampled steps; an item and a window that emit
the same words at the sampled steps are a candidate.  Walks are short and start
at several places of an item, so that long items are found as well as short
ones.  A window starts at every word of every text.  After the first two sampled steps only windows that
still agree with some item walk on, which finds the same collisions for less.

Candidates are verified exactly: the smallest word edit distance between the
whole item and any stretch of the text around the window.  With ``REPETITIONS``
walks an item of 8 to 500 words with a share of ``MAX_EDIT_SHARE`` of its words
edited at random is found with a probability over 0.99 (tests measure it).

Items of fewer than ``MIN_WORDS`` words are found wherever their whole word
sequence occurs, by the hash of each window of their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import slices
from .words import NOT_ALNUM, mix, word_hashes

#: Walks over items of 8 to 15 words; longer items have places enough for five in eight of them.
REPETITIONS = 8
#: Places of an item where each walk starts, by length class (8 to 15 words, 16 to 31, 32 to 63), and of longer items.
PLACES, MOST_PLACES = {3: 4, 4: 4, 5: 6}, 8
#: Items with fewer words are searched for as they are, without edits.
MIN_WORDS = 8
#: Largest edit distance of a match, as a share of the item's words.
MAX_EDIT_SHARE = 0.2
#: Items searched for in one pass over the texts.
BLOCK_ITEMS = 20_000
#: Longest walk, in steps.
LONGEST = 20

_RNG = np.random.default_rng(771)
_STEP = _RNG.integers(1, 2**63, (64, 96), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = np.uint64(0x9E3779B97F4A7C15)
_END = np.uint64(0)


@dataclass
class Walk:
    """One repetition: where it starts in an item and the steps it samples."""

    number: int
    part: int
    early: tuple[int, int]
    #: Later sampled steps by length class of the items.
    late: dict[int, tuple[int, ...]]


def _classes(n_words: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(n_words, 1)).astype(np.int64)


def reach_of(c: int) -> int:
    """Steps that walks over items of a length class may take; long items are met at more places, not by longer walks."""
    return min(LONGEST, max(10, int(0.6 * 2**c)))


def places(m: np.ndarray, c: int, part: int) -> np.ndarray:
    """Where the walks of one part start in items of m words of one class, a row for each place, spread over the item."""
    n = PLACES.get(c, MOST_PLACES)
    room = np.maximum(m - reach_of(c) // 2 - 1, 1)
    return np.array([room * (4 * j + part) // (4 * n) for j in range(n)])


def walks(classes: list[int], repetitions: int = REPETITIONS, seed: int = 42) -> list[Walk]:
    rng = np.random.default_rng(seed)
    out = []
    for r in range(repetitions):
        early = (int(rng.integers(0, 3)), int(rng.integers(3, 8)))
        late = {}
        for c in classes:
            reach = reach_of(c)
            late[c] = tuple(sorted(int(x) for x in rng.integers(8, reach, 2)))
        late = {c: steps for c, steps in late.items() if c <= 3 or 8 * r < 5 * repetitions}
        if late:
            out.append(Walk(r, r % 4, early, late))
    return out


def _walk(words: np.ndarray, at: np.ndarray, number: int, begin: int, end: int, stop: np.ndarray) -> np.ndarray:
    """Pointers after the steps begin to end - 1; words past a sequence's stop read as the end mark."""
    many = 2 * len(at) > len(words)
    for step in range(begin, end):
        if many:  # one bit for each word, then a small gather
            moves = ((words * _STEP[number, step]) >> np.uint64(63)).astype(np.int8)[at]
        else:
            moves = ((words[at] * _STEP[number, step]) >> np.uint64(63)).astype(np.int8)
        at = np.minimum(at + moves, stop)
    return at


def _fold(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(key * _FOLD + word)


def _sequence(words: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Keys of the n words from each place on."""
    key = words[at]
    for k in range(1, n):
        key = _fold(key, words[at + k])
    return key


class Index:
    """Items and, for each walk, the keys of their sampled words."""

    def __init__(self, items: list[tuple[int, str]], repetitions: int = REPETITIONS):
        raw = [t.encode() for _, t in items]
        buf = np.frombuffer(b"".join(raw), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
        hashes, first, _, _ = word_hashes(buf, offsets, NOT_ALNUM)
        wanted = [i for i in range(len(items)) if first[i + 1] - first[i] >= MIN_WORDS]
        short = [i for i in range(len(items)) if 0 < first[i + 1] - first[i] < MIN_WORDS]
        #: Ids of the items with walks, then of the short ones.
        self.ids = [items[i][0] for i in wanted + short]
        #: Sorted keys and item places of the short items, by number of words.
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        lengths = np.array([first[i + 1] - first[i] for i in short], dtype=np.int64)
        for n in sorted(set(lengths.tolist())):
            own = np.flatnonzero(lengths == n)
            starts = np.array([first[short[k]] for k in own], dtype=np.int64)
            keys = _sequence(hashes, starts, n)
            order = np.argsort(keys, kind="stable")
            self.short[n] = (keys[order], len(wanted) + own[order])
        self.words = [hashes[first[i]: first[i + 1]] for i in wanted]
        self.masks: list[dict[int, int]] = []
        for w in self.words:
            masks: dict[int, int] = {}
            for k, x in enumerate(w.tolist()):
                masks[x] = masks.get(x, 0) | 1 << k
            self.masks.append(masks)
        sizes = np.array([len(w) for w in self.words], dtype=np.int64)
        classes = _classes(sizes)
        self.walks = walks(sorted(set(classes.tolist())), repetitions)
        self.tables = []
        flat = np.concatenate([np.append(w, _END) for w in self.words]) if self.words else np.zeros(0, np.uint64)
        ends = np.cumsum(sizes + 1) - 1
        begins = ends - sizes
        for walk in self.walks if len(sizes) else []:
            firsts, keys, late = [], [], {}
            for c, steps in walk.late.items():
                own = np.flatnonzero(classes == c)
                offset = places(sizes[own], c, walk.part)
                own, offset = np.tile(own, len(offset)), offset.ravel()
                stop = ends[own]
                one = _walk(flat, begins[own] + offset, walk.number, 0, walk.early[0], stop)
                two = _walk(flat, one, walk.number, walk.early[0], walk.early[1], stop)
                key = _fold(flat[one], flat[two])
                firsts.append(flat[one])
                keys.append(key)
                spot, done, full = two, walk.early[1], key
                for s in steps:
                    spot = _walk(flat, spot, walk.number, done, s, stop)
                    done = max(done, s)
                    full = _fold(full, flat[spot])
                order = np.argsort(full, kind="stable")
                late[c] = (full[order], own[order], offset[order])
            self.tables.append((np.unique(np.concatenate(firsts)), np.unique(np.concatenate(keys)), late))
        self.screen = [self._bits(t[0]) for t in self.tables]

    def verbatim(self, words: np.ndarray, stops: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, first word, last word) of the first place of each short item in each text."""
        starts = np.flatnonzero(words != _END)
        for n, (keys, items) in self.short.items():
            at = starts[starts + n <= stops[starts]]
            full = _sequence(words, at, n)
            hit = _among(full, keys)
            at, full = at[hit], full[hit]
            left, right = np.searchsorted(keys, full, "left"), np.searchsorted(keys, full, "right")
            _, early = np.unique(stops[at].astype(np.int64) * len(keys) + left, return_index=True)
            at, left, right = at[early], left[early], right[early]
            for a, low, high in zip(at.tolist(), left.tolist(), right.tolist()):
                for k in range(low, high):
                    yield int(items[k]), a, a + n - 1

    @staticmethod
    def _bits(values: np.ndarray) -> np.ndarray:
        bits = np.zeros(1 << 16, dtype=bool)
        bits[(values & np.uint64(0xFFFF)).astype(np.int64)] = True
        return bits

    def candidates(self, words: np.ndarray, stops: np.ndarray) -> set[tuple[int, int, int]]:
        """(item, end mark of the text, word where the item would start) of all collisions.

        ``stops`` are the end marks of the words' texts.  The text is that of
        the walk's own words: an item whose first words are missing would start
        before it, maybe inside another text.
        """
        found: set[tuple[int, int, int]] = set()
        starts = np.flatnonzero(words != _END).astype(np.int32)
        low = (words & np.uint64(0xFFFF)).astype(np.uint16)
        for walk, (firsts, keys, late), screen in zip(self.walks, self.tables, self.screen):
            at = starts
            one = _walk(words, at, walk.number, 0, walk.early[0], stops[at])
            hit = np.flatnonzero(screen[low[one]])
            at, one = at[hit], one[hit]
            hit = _among(words[one], firsts)
            at, one = at[hit], one[hit]
            two = _walk(words, one, walk.number, walk.early[0], walk.early[1], stops[at])
            key = _fold(words[one], words[two])
            hit = _among(key, keys)
            at, two, key = at[hit], two[hit], key[hit]
            for c, (full_keys, items, offsets) in late.items():
                spot, done, full = two, walk.early[1], key
                for s in walk.late[c]:
                    spot = _walk(words, spot, walk.number, done, s, stops[at])
                    done = max(done, s)
                    full = _fold(full, words[spot])
                left = np.searchsorted(full_keys, full, "left")
                right = np.searchsorted(full_keys, full, "right")
                for i in np.flatnonzero(right > left):
                    for k in range(left[i], right[i]):
                        found.add((int(items[k]), int(stops[at[i]]), int(at[i] - offsets[k])))
        return found


def _among(x: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of the x that occur in sorted values."""
    if not len(values):
        return np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(values, x), len(values) - 1)
    return np.flatnonzero(values[at] == x)


def edit_distance_in(masks: dict[int, int], m: int, text: list[int]) -> tuple[int, int]:
    """Smallest word edit distance between a pattern of m words and any stretch of ``text``, and its end.

    Bit-parallel dynamic programming: one machine step per word of the text.
    """
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, m, 0
    for i, word in enumerate(text):
        eq = masks.get(word, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        plus = down | (full & ~(diagonal | up))
        minus = up & diagonal
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus = (plus << 1) & full
        minus = (minus << 1) & full
        up = minus | (full & ~(diagonal | plus))
        down = plus & diagonal
        if score < best:
            best, end = score, i + 1
    return best, end


def search(index: Index, buf: np.ndarray, offsets: np.ndarray, max_share: float = MAX_EDIT_SHARE):
    """(text, item place, distance, last byte) of every verified item of each text of a buffer, best place first."""
    hashes, first, _, ends = word_hashes(buf, offsets, NOT_ALNUM)
    if not len(hashes) or not index.ids:
        return []
    n = len(offsets) - 1
    sizes = np.diff(first)
    text = np.repeat(np.arange(n), sizes)
    words = np.zeros(len(hashes) + n, np.uint64)
    words[np.arange(len(hashes)) + text] = hashes
    lows = first[:-1] + np.arange(n)
    marks = lows + sizes
    stops = np.repeat(marks, sizes + 1).astype(np.int32)
    best: dict[tuple[int, int], tuple[int, int]] = {}
    tried: set[tuple[int, int, int]] = set()
    for item, mark, start in sorted(index.candidates(words, stops)):
        m = len(index.words[item])
        slack = int(max_share * m)
        owner = int(np.searchsorted(marks, mark))
        a, b = max(int(lows[owner]), start - slack), min(mark, start + m + slack)
        if (item, a, b) in tried or b <= a or best.get((owner, item), (1, 0))[0] == 0:
            continue
        tried.add((item, a, b))
        distance, end = edit_distance_in(index.masks[item], m, words[a:b].tolist())
        if distance <= slack and (distance, a) < best.get((owner, item), (m + 1, 0)):
            best[owner, item] = (distance, a + max(end, 1) - 1)
    for item, a, last in index.verbatim(words, stops):
        best[int(np.searchsorted(marks, a, "left")), item] = (0, last)
    return [(owner, item, d, int(ends[last - owner] - offsets[owner])) for (owner, item), (d, last) in best.items()]


def _indexes(benchmark: DataFrame, item_col: str, text_col: str, repetitions: int) -> Iterator[Index]:
    """Indexes of all items, of bounded size: about ``BLOCK_ITEMS`` items each; one without items if there are none."""
    items = (benchmark.where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull())
             .select(F.col(item_col).cast("bigint").alias("item"), F.col(text_col).alias("text")))
    blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k).collect()
        yield Index(sorted((r.item, r.text) for r in own), repetitions)


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text_col: str = "text", max_share: float = MAX_EDIT_SHARE,
            repetitions: int = REPETITIONS) -> DataFrame:
    """Each document with the benchmark items found in it.

    ``doc_id, item_ids array<bigint>, distances array<int>, ends array<bigint>``
    (byte after each match), one row per document row; the lists are empty
    where nothing was found, and for null and empty texts.  Items that are null or
    have no words are not searched for; those with fewer than ``MIN_WORDS`` words
    are found only verbatim, with distance 0.  Items are taken in blocks
    of ``BLOCK_ITEMS``: each block's pass over the whole texts, with an index
    of bounded size, adds to the lists of the one before; an empty benchmark
    finds nothing.  Lists are ordered by item, distance and end.
    """
    kinds = {"item_ids": "bigint", "distances": "int", "ends": "bigint"}
    found = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                        *[F.array().cast(f"array<{k}>").alias(c) for c, k in kinds.items()])
    schema = found.schema
    for index in _indexes(benchmark, item_col, item_text_col, repetitions):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, buf, offsets in slices(batch.column(1), 1 << 19):
                    n = len(offsets) - 1
                    own = batch.slice(at, n)
                    lists = [list(zip(*row)) for row in zip(*(own.column(k).to_pylist() for k in (2, 3, 4)))]
                    for owner, item, distance, end in search(index, buf, offsets, max_share):
                        lists[owner].append((index.ids[item], distance, end))
                    for row in lists:
                        row.sort()
                    yield pa.RecordBatch.from_arrays(
                        [own.column(0), own.column(1), *(pa.array([[x[k] for x in row] for row in lists], pa.list_(kind))
                                                         for k, kind in enumerate((pa.int64(), pa.int32(), pa.int64())))],
                        schema.names)

        found = found.mapInArrow(run, schema)
    return found.drop("text")


def contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``doc_id, contaminated, n_items, min_distance, item_ids``, one row per document row.

    Null and empty texts hold nothing; repeated rows repeat, a null id stays
    null, other columns are ignored, whatever their names.  What is found in a
    text does not depend on the texts beside it.
    """
    m = matches(docs, benchmark, **options)
    return m.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), F.size("item_ids").alias("n_items"),
                    F.array_min("distances").alias("min_distance"), F.array_sort("item_ids").alias("item_ids"))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", max_share: float = MAX_EDIT_SHARE, repetitions: int = REPETITIONS) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, all columns, whatever their names.

    Null and empty texts stay, of repeated rows all stay or go, texts of any
    length are searched whole; an empty benchmark leaves everything.
    """
    for index in _indexes(benchmark, item_col, item_text_col, repetitions):
        place = docs.columns.index(text_col)

        def run(batches: Iterator[pa.RecordBatch], index: Index = index, place: int = place) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for at, buf, offsets in slices(batch.column(place), 1 << 19):
                    for owner, *_ in search(index, buf, offsets, max_share):
                        keep[at + owner] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
