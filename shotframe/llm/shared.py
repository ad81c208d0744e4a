"""Written tables and lineage cuts in the shared folder, and Arrow batch helpers."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, scratch_path


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to a reliable checkpoint in the shared folder and go on from the files.

    Cuts the lineage of iterative steps and survives lost executors; the files
    go once the result is no longer referenced
    (``spark.cleaner.referenceTracking.cleanCheckpoints``).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        conf = spark._jsc.hadoopConfiguration()
        for root in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(conf).delete(path, True)


def whole_row(names: list[str]) -> Column:
    """All columns of a row as one struct.

    Steps that add columns of their own carry a table's rows in one struct of a
    name they choose, and so cannot meet a column of the table: ``name.*`` gives
    the columns back, whatever they are called.
    """
    return F.struct(*[F.col("`" + n.replace("`", "``") + "`") for n in names])


def slices(column: pa.Array, max_bytes: int = 1 << 20):
    """Slices of a string column of about ``max_bytes`` (a longer text stands alone).

    Yields ``(first row, buffer, offsets)``: the UTF-8 bytes of the slice and
    where each text starts and ends in them; a null text is empty.
    """
    import numpy as np

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets_buf, data_buf = column.buffers()
    offsets = np.frombuffer(offsets_buf, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None and data_buf.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        end = int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1
        end = min(max(end, at + 1), len(column))
        yield at, data[offsets[at]: offsets[end]], offsets[at: end + 1] - offsets[at]
        at = end
