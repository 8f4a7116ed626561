"""Helpers of the llm operators: tables, total orders, and texts as byte arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from procwarden.session import cut_lineage

#: Texts are worked on in groups of about so many bytes inside a task.
SLICE_BYTES = 1_000_000
#: A table of at most so many rows (narrow ones, counted first) is broadcast.
BROADCAST_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_or_shuffled(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` marked for broadcast if it is counted small; else left to a shuffle join."""
    counted = df.limit(BROADCAST_ROWS + 1).count() if rows is None else rows
    return F.broadcast(df) if counted <= BROADCAST_ROWS else df


def with_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add the position (from 0) in the total order: sorted ranges, then offsets per range."""
    ranged = cut_lineage(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))  # one row per partition
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(W.partitionBy("_range").orderBy(*order))
    return (ranged.join(F.broadcast(offsets), "_range")
            .withColumn(name, F.col("_offset") + inside - 1).drop("_range", "_offset"))


def byte_slices(batches: Iterable[pa.RecordBatch], column: str,
                size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that ``column`` holds about ``size`` bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        _, ends = text_bytes(batch.column(at))
        groups = ends[1:] // size
        starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
        for a, b in zip(starts, np.r_[starts[1:], batch.num_rows], strict=True):
            yield batch.slice(int(a), int(b - a))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row and the offsets of each text; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[ends[0]:ends[-1]], ends - ends[0]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64


class _Powers:
    """Powers of the base and of its inverse, kept in a process; they are never sent along."""

    def __init__(self) -> None:
        self.up = self.down = np.zeros(0, np.uint64)

    def __reduce__(self):
        return _Powers, ()

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 1)
            self.up, self.down = (np.cumprod(np.r_[np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)])
                                  for base in (_BASE, pow(_BASE, -1, 1 << 64)))
        return self.up, self.down


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SpanHasher:
    """64-bit hashes of stretches of an array: polynomials, taken from running sums."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = _POWERS.of(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the values of each span."""
    return SpanHasher(data).of(starts, ends)


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _SPACE,
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the first word of every text (with one entry more).

    A word is a longest run of bytes that are no ``separators``; texts end words.
    """
    inside = ~separators[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    begins[firsts] = inside[firsts]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    stops[lasts] = inside[lasts]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, byte by byte."""
    return _LOWER[data]
