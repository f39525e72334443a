"""Helpers shared by the operators: staging tables and column checks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricas.session import ensure_checkpoint_dir

# bytes of text that a Python worker handles at once
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str, rows_at_once: int | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage: later stages, and stages run again after an executor is
    lost, read the table instead of recomputing it. Parquet's writer and Spark's
    reader hold a hundred rows at least, however large; ``rows_at_once`` rows at
    most where it is given, for tables of large rows.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    out = df.write.option("compression", "zstd")
    if rows_at_once:
        out = out.option("parquet.block.row.count.limit", rows_at_once)  # of a row group
    out.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, column: str = "text") -> int:
    """UTF-8 bytes of all texts: one number, used to size buckets."""
    return docs.agg(F.sum(F.octet_length(column)).alias("n")).first()["n"] or 0


def bucket_count(n_bytes: int, per_bucket: int = 16 << 20, least: int = 64) -> int:
    """Buckets so that each holds what ``per_bucket`` bytes of text give on average; ``least`` spread small inputs."""
    return max(least, -(-n_bytes // per_bucket))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(offs):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offs[0]:offs[-1]], offs - offs[0]


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows of about ``limit`` bytes of text; a longer row stands alone."""
    for batch in batches:
        _, offs = text_buffers(batch.column(column))
        at, rows = 0, batch.num_rows
        while at < rows:
            to = int(np.searchsorted(offs, offs[at] + limit, "right")) - 1
            to = min(max(to, at + 1), rows, at + 60_000)
            yield batch.slice(at, to - at)
            at = to


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices that lay the ranges [start, start+length) one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total, dtype=np.int64)
