"""Results written between jobs, and numpy sums that tasks add up together."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseworks.session import checkpoint_folder


#: Writer's options for rows of hundreds of kilobytes. By default pages and row groups hold a hundred rows at least, and readers and writers keep
#: buffers of a page outside the heap and of a row group inside it.
LARGE_ROWS = {
    "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1",
    "parquet.block.size": str(8 << 20), "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1",
}


def write_stage(df: DataFrame, label: str, **options: str) -> tuple[DataFrame, str]:
    """``df`` written to the folder driver and executors share and read again, and its path; lineage ends there."""
    path = f"{checkpoint_folder(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_stage(spark: SparkSession, path: str) -> None:
    """Remove a folder of ``write_stage`` that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def flat_vector(vector: Column | str) -> Column:
    """A vector as one array for ``VectorBatch``: 1 and its values if it is dense, else 0, its indices and its values.

    A vector as such goes to Arrow as seven nested columns, whose sizes are looked up for every row.
    """
    parts = F.unwrap_udt(vector)
    sparse = F.concat(F.array(F.lit(0.0)), parts["indices"].cast("array<double>"), parts["values"])
    return F.when(parts["type"] == 1, F.concat(F.array(F.lit(1.0)), parts["values"])).otherwise(sparse)


class VectorBatch:
    """The entries of a batch of vectors, as such or as ``flat_vector`` gives them: row, index and value of each that is not zero."""

    def __init__(self, vectors: pa.Array):
        if isinstance(vectors, pa.ChunkedArray):
            vectors = vectors.combine_chunks()
        self.rows = len(vectors)
        if not self.rows:
            self.row, self.index, self.value = np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0)
            return
        if pa.types.is_list(vectors.type):
            self._unpack(vectors)
            return
        kind, _, indices, values = (f for f in vectors.flatten())
        lengths = values.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype("int64")
        row = np.repeat(np.arange(self.rows), lengths)
        value = values.flatten().to_numpy(zero_copy_only=False)
        sparse = np.repeat(kind.fill_null(1).to_numpy(zero_copy_only=False) == 0, lengths)
        index = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        if sparse.any():
            index[sparse] = indices.flatten().to_numpy(zero_copy_only=False)
        held = value != 0
        self.row, self.index, self.value = row[held], index[held].astype("int64"), value[held]

    def _unpack(self, vectors: pa.Array) -> None:
        sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype("int64")
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        starts = np.cumsum(sizes) - sizes
        sparse = np.zeros(self.rows, bool)
        sparse[sizes > 0] = flat[starts[sizes > 0]] == 0
        lengths = np.where(sparse, (sizes - 1) // 2, np.maximum(sizes - 1, 0))
        row = np.repeat(np.arange(self.rows), lengths)
        index = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        place = index + np.repeat(starts + 1, lengths)
        value = flat[place + np.repeat(np.where(sparse, lengths, 0), lengths)]
        if sparse.any():
            inside = np.repeat(sparse, lengths)
            index[inside] = flat[place[inside]].astype("int64")
        held = value != 0
        self.row, self.index, self.value = row[held], index[held], value[held]

    def columns(self, wanted: np.ndarray) -> np.ndarray:
        """Matrix (rows x ``wanted``) of the values at the sorted indices ``wanted``."""
        found = np.zeros((self.rows, len(wanted)))
        if len(wanted):
            place = np.minimum(np.searchsorted(wanted, self.index), len(wanted) - 1)
            held = wanted[place] == self.index
            found[self.row[held], place[held]] = self.value[held]
        return found


#: Numbers of one row of partial sums.
BLOCK = 1 << 16


def summed(partials: DataFrame) -> DataFrame:
    """(part, place, total): the elementwise sums of ``partials`` (part int, block int, total binary of doubles) by part and block.

    Tasks add their rows up one after the other, holding one block of at most ``BLOCK`` numbers for each key they own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for part, block, total in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                numbers = np.frombuffer(total)
                key = (part, block)
                held[key] = held[key] + numbers if key in held else numbers
        for (part, block), numbers in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([numbers.tobytes()])], names=["part", "block", "total"])

    return partials.repartition("part", "block").mapInArrow(run, "part int, block int, total binary")


def blocks_of(part: int, numbers: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``numbers`` as rows of partial sums."""
    for block, start in enumerate(range(0, len(numbers), BLOCK)):
        own = np.ascontiguousarray(numbers[start : start + BLOCK], "float64")
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([own.tobytes()])], names=["part", "block", "total"])


def collected(sums: DataFrame) -> dict[int, np.ndarray]:
    """The whole vector of each part of ``summed``."""
    found: dict[int, dict[int, bytes]] = {}
    for r in sums.collect():
        found.setdefault(r["part"], {})[r["block"]] = bytes(r["total"])
    return {part: np.frombuffer(b"".join(blocks[b] for b in sorted(blocks))) for part, blocks in found.items()}
