"""Rows of numbers packed into blocks, and sums over them.

Iterative fits go over the same rows many times.  Packed once into blocks of
doubles and persisted, a pass costs a copy of the bytes and the arithmetic of
the task; what a task passes on is one vector of sums.  A block is kept column
by column and compressed without loss: handing dense one-hot slots to Python
took most of a pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a block, and the codec of its bytes.
BLOCK_ROWS, CODEC = 4096, "lz4_raw"
#: Places added up by one task, of each task's vector of sums.
PLACES = 512


def _pressed(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(order="F"), codec=CODEC, asbytes=True)


def _plain(pressed: pa.Buffer, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(pressed, decompressed_size=8 * n, codec=CODEC), np.float64)


def packed(rows: DataFrame, x: Column, y: Column, width: int) -> DataFrame:
    """Blocks (n int, x binary, y binary) of an array of ``width`` doubles and a number per row, persisted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many = np.asarray(batch.column(0).flatten(), dtype=np.float64).reshape(-1, width)
            one = np.asarray(batch.column(1), dtype=np.float64)
            for a in range(0, len(one), BLOCK_ROWS):
                x, y = many[a: a + BLOCK_ROWS], one[a: a + BLOCK_ROWS]
                yield pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int32()), *(pa.array([_pressed(v)], pa.binary()) for v in (x, y))],
                                                 ["n", "x", "y"])

    return (rows.select(x.alias("x"), y.cast("double").alias("y")).mapInArrow(run, "n int, x binary, y binary")
            .persist(StorageLevel.MEMORY_AND_DISK))


def added_up(blocks: DataFrame, width: int, of_block: Callable[[np.ndarray, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all blocks of ``of_block(x, y)``, ``size`` numbers.

    A task passes on one vector of sums; those are added up by place, by as
    many tasks as there are places for: writing a few hundred sums for every
    shuffle partition of the session took longer than the sums.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for n, x, y in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                total += of_block(_plain(x.as_buffer(), n * width).reshape(width, n).T, _plain(y.as_buffer(), n))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], ["place", "total"])

    out = np.zeros(size)
    sums = blocks.mapInArrow(run, "place int, total double").repartition(-(-size // PLACES), "place")
    for r in sums.groupBy("place").agg(F.sum("total").alias("total")).collect():
        out[r.place] = r.total
    return out
