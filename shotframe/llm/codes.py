"""Vector compression by product codes whose entries are searched through a tree.

Components become integers, ``floor(SCALE * x)``.  A vector is cut into
``parts`` equal consecutive parts; each part position has its own codebook,
which starts as that part of the vectors with the smallest ids and is moved
``rounds`` times to the rounded-down means of the parts assigned to it.  All
arithmetic is in integers, so the result does not depend on how rows are
spread over tasks.

A round is one pass: each task finds the nearest entry of every part through
a tree over the entries (``gnat.py``), adds up its parts by entry and passes
on one row per part position and entry; Spark adds those rows up, and the
codebooks (``parts`` times ``entries`` vectors, whatever the table) come back
to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .gnat import Search
from .shared import cut

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Integers beyond this could overflow the sum of squares over a part of a few thousand components.
MOST = 1 << 24


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))),
                      F.lit(False))


def _matrix(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``dim`` components, and the integers (row, component) of those."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(np.diff(offsets) == dim)
    whole = np.floor(SCALE * values[offsets[rows][:, None] + np.arange(dim)].astype(np.float64))
    if whole.size and np.abs(whole).max() > MOST:
        raise OverflowError(f"a component is beyond {MOST // SCALE}: squared distances would not fit 64 bits")
    return rows, whole.astype(np.int64)


def _start(kept: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """Codebooks (part, entry, component) from the vectors of the smallest ids; None without any.

    The length of a vector is that of the smallest id's; of several vectors
    with one id the smallest in array order counts.
    """
    known = kept.where(F.col("id").isNotNull())
    first = known.groupBy("id").agg(F.min("vector").alias("vector")).orderBy("id").limit(1).collect()
    if not first:
        return None
    dim = len(first[0].vector)
    if dim % parts:
        raise ValueError(f"vectors of {dim} components cannot be cut into {parts} equal parts")
    rows = (known.where(F.size("vector") == dim).groupBy("id").agg(F.min("vector").alias("vector"))
            .orderBy("id").limit(entries).collect())
    _, whole = _matrix(pa.array([r.vector for r in rows], pa.list_(pa.float64())), dim)
    return whole.reshape(len(rows), parts, dim // parts).transpose(1, 0, 2)


def _sums(kept: DataFrame, books: np.ndarray) -> list:
    """(part, entry, position, sum, count) over the parts assigned to each entry."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Search(b) for b in books]
        total, count = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            _, whole = _matrix(batch.column(0), parts * width)
            for p, search in enumerate(searches):
                own = whole[:, p * width: (p + 1) * width]
                code, _ = search.nearest(own)
                np.add.at(total[p], code, own)
                count[p] += np.bincount(code, minlength=entries)
        for p, e in np.argwhere(count):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(width, p), pa.int32()), pa.array(np.full(width, e), pa.int32()),
                 pa.array(np.arange(width), pa.int32()), pa.array(total[p, e]), pa.array(np.full(width, count[p, e]))],
                ["part", "entry", "position", "total", "n"])

    return (kept.select("vector").mapInArrow(run, "part int, entry int, position int, total bigint, n bigint")
            .groupBy("part", "entry", "position").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect())


def fit(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks after ``rounds`` passes over ``id, vector``; an entry that no part is nearest to stays."""
    books = _start(kept, parts, entries)
    if books is None or not books.size:
        return books
    for _ in range(rounds):
        books = books.copy()
        for r in _sums(kept, books):
            books[r.part, r.entry, r.position] = r.total // r.n
    return books


def digest(books: np.ndarray | None) -> str:
    """SHA-256 of all components as decimal numbers, by part, entry and position, joined by commas."""
    flat = [] if books is None else books.reshape(-1).tolist()
    return hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()


def encode(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """``id, label, code, error`` of every row; null code and error where the vector has another length."""
    parts, entries, width = books.shape
    label_type = kept.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = [Search(b) for b in books]
        names = np.array([f"{e:02x}" for e in range(entries)])
        for batch in batches:
            rows, whole = _matrix(batch.column(2), parts * width)
            error, text = np.zeros(len(rows), np.int64), np.full(len(rows), "", dtype=object)
            for p, search in enumerate(searches):
                code, squares = search.nearest(whole[:, p * width: (p + 1) * width])
                error += squares
                text = text + names[code].astype(object)
            codes, errors = np.full(batch.num_rows, None), np.full(batch.num_rows, None)
            codes[rows], errors[rows] = text, error
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.string()),
                                              pa.array(errors, pa.int64())], ["id", "label", "code", "error"])

    return kept.select("id", "label", "vector").mapInArrow(run, f"id bigint, label {label_type}, code string, error bigint")


def compressed(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
               parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every row with a usable vector.

    Rows whose vector is null or holds a null, infinite or undefined component
    are left out.  Repeated rows repeat and count each time in the means; a
    null id stays null and is never an entry to start from; vectors whose
    length differs from that of the smallest id get a null code and error.
    Fewer vectors than entries give fewer entries.  An empty table, or one
    without a usable vector that has an id, gives no rows with a code.  Other
    columns, whatever their names, are ignored.  A component beyond 4096 in
    size, whose squared distances could leave 64 bits, raises an error.

    The error of a label is added up once per label and joined back, so the
    rows of a frequent label never meet in one task.
    """
    kept = cut(rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).alias("label"),
                           F.col(vector_col).cast("array<double>").alias("vector")).where(usable(F.col("vector"))))
    books = fit(kept, parts, entries, rounds)
    if books is None or not books.size:
        coded = kept.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    else:
        coded = cut(encode(kept, books))
    sums = coded.groupBy(F.col("label").alias("_l")).agg(F.sum("error").alias("label_error"))
    return (coded.join(sums, F.col("label").eqNullSafe(F.col("_l")), "left")
            .select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")))
