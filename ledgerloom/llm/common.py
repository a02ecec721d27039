"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and return the stored copy.

    The copy cuts lineage and survives lost executors; it goes with the folder
    named by ``spark.checkpoint.dir``.
    """
    path = scratch_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores added until no frame has such a column (names ignore case)."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def must_be_free(df: DataFrame, *names: str) -> None:
    """Raise if the frame has a column of one of the names already (names ignore case)."""
    taken = {c.lower() for c in df.columns}
    for name in names:
        if name.lower() in taken:
            raise ValueError(f"column {name} is there already")


def texts(column: pa.Array) -> Iterator[str | None]:
    """The Python strings of an Arrow column, one at a time (no second copy of the whole batch)."""
    for value in column:
        yield value.as_py()


def by_bytes(batch: pa.RecordBatch, name: str, limit: int) -> Iterable[pa.RecordBatch]:
    """Split a batch so that column ``name`` has about ``limit`` bytes a piece; one row at least."""
    import numpy as np
    import pyarrow.compute as pc

    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(name)), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(sizes) // limit
    cuts = [0, *(np.nonzero(np.diff(piece))[0] + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        yield batch.slice(start, end - start)
