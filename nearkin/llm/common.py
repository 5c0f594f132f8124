"""Helpers shared by the operators: reading tables, held-out rows, bounded chunks of record batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearkin.session import scratch_path, small_batches

CHUNK_BYTES = 1 << 22


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def id_remainder(doc_id: str, modulus: int) -> Column:
    """``crc32`` of the id as text modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores appended until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


class Steps:
    """Intermediate tables in the shared folder that go when their result is stored."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: list[str] = []

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written once and read back."""
        path = scratch_path(self.spark, name)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Delete what was written; nothing may read it any more."""
        configuration = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in self.paths:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(configuration).delete(path, True)
        self.paths.clear()


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices whose texts hold about ``limit`` bytes each; a longer single text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def texts_of(batch: pa.RecordBatch, text: str) -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]


def with_columns(batch: pa.RecordBatch, keep: list[str], new: dict[str, pa.Array]) -> pa.RecordBatch:
    """``keep`` of the batch followed by ``new``."""
    arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep]
    return pa.RecordBatch.from_arrays([*arrays, *new.values()], names=[*keep, *new])
