"""Feature statistics of the baseline and standardised vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from procwarden.fixed_values import MODEL_COLUMNS
from procwarden.functions.text import col, number
from procwarden.operators.features import clean_number
from procwarden.schema import EVENT_KEY
from procwarden.session import cut_lineage

EXPLAIN_STD_FLOOR = 0.001
MOMENTS = ["position", "rows", "mean", "squares", "low", "high"]
SAME = 1e-6  # statistics that differ by no more than this share of a column's size are those of one baseline


@dataclass
class FeatureStats:
    """Mean, population deviation, minimum and maximum per model column."""

    columns: list[str]
    mean: list[float]
    std: list[float]
    low: list[float]
    high: list[float]
    rows: int

    @property
    def scale(self) -> list[float]:
        """Divisors: a constant column is divided by 1."""
        return [s if s > 0 else 1.0 for s in self.std]

    @property
    def explain_std(self) -> list[float]:
        return [max(s, EXPLAIN_STD_FLOOR) for s in self.std]


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, mean, squared deviations, minimum and maximum of every column of a task's rows."""
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        n, gap = len(x), x - x[0]  # a constant column deviates by 0 exactly
        mean = gap.mean(axis=0)
        part = x[0] + mean, ((gap - mean) ** 2).sum(axis=0), x.min(axis=0), x.max(axis=0)
        if not rows:
            rows, (middle, squares, low, high) = n, part
            continue
        step = part[0] - middle
        squares = squares + part[1] + step * step * (rows * n / (rows + n))
        middle = middle + step * (n / (rows + n))
        low, high, rows = np.minimum(low, part[2]), np.maximum(high, part[3]), rows + n
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(middle), dtype=np.int32)), pa.array(np.full(len(middle), rows)),
             *map(pa.array, (middle, squares, low, high))], MOMENTS)


def fit_stats(features: DataFrame) -> FeatureStats:
    """One pass over the baseline, in which a task gives one row per column; those are merged without loss of precision."""
    present = [c for c in MODEL_COLUMNS if c in features.columns]
    if not present:
        raise ValueError(f"no model column found, expected some of {MODEL_COLUMNS[:5]}")
    numbers = features.selectExpr(*[f"{clean_number(c)} AS {c}" for c in present])
    parts = numbers.mapInArrow(_moments, "position int, rows long, mean double, squares double, low double, high double")
    column = W.partitionBy("position")  # a row per task
    overall = F.sum(F.col("rows") * F.col("mean")).over(column) / F.sum("rows").over(column)
    gap = F.col("mean") - F.col("overall")
    merged = parts.withColumn("overall", overall).groupBy("position").agg(
        F.sum("rows").alias("rows"), F.max("overall").alias("mean"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.sum(F.col("squares") + F.col("rows") * gap * gap).alias("squares"))
    found = sorted(merged.collect(), key=lambda r: r["position"])  # a row per column
    if not found:
        raise ValueError("the baseline has no rows")
    low, high = [r["low"] for r in found], [r["high"] for r in found]
    same = [a == b for a, b in zip(low, high)]
    return FeatureStats(present, [r["low"] if s else r["mean"] for r, s in zip(found, same)],
                        [0.0 if s else (r["squares"] / r["rows"]) ** 0.5 for r, s in zip(found, same)],
                        low, high, rows=found[0]["rows"])


def same_stats(a: FeatureStats, b: FeatureStats) -> bool:
    """Whether both were fitted on one baseline.

    Sums of doubles depend on the order in which tasks end, and the mean of a
    standardised column is nothing but that noise, so numbers are compared by the size of
    their column.
    """
    if a.columns != b.columns or a.rows != b.rows:
        return False
    size = [max(map(abs, ends)) for ends in zip(a.low, a.high, b.low, b.high)]
    return all(abs(x - y) <= SAME * s for one, other in [(a.mean, b.mean), (a.std, b.std), (a.low, b.low), (a.high, b.high)]
               for x, y, s in zip(one, other, size))


def stats_table(spark, stats: FeatureStats) -> DataFrame:
    """One row per feature, for explanations and for storage."""
    rows = ", ".join(
        f"({i}, '{c}', {', '.join(map(number, values))})" for i, (c, *values) in enumerate(zip(
            stats.columns, stats.mean, stats.explain_std, stats.low, stats.high, stats.std)))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(position, feature, mean, std, min, max, raw_std)")


def scaled_vector(stats: FeatureStats) -> Column:
    return col("array(" + ", ".join(
        f"({clean_number(c)} - {number(m)}) / {number(s)}"
        for c, m, s in zip(stats.columns, stats.mean, stats.scale)) + ")")


def matrix(x: pa.Array) -> np.ndarray:
    """A batch of vectors, one per row of the array, as they lie in it."""
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def vector_key(columns: list[str]) -> Column:
    """A 128-bit key of the model input of a row."""
    parts = ", ".join(f"cast({clean_number(c)} AS string)" for c in columns)
    return col(f"md5(cast(concat_ws(',', {parts}) AS binary))")


def row_vectors(features: DataFrame, stats: FeatureStats, order: str = EVENT_KEY, written: bool = True) -> DataFrame:
    """Every model input as it lies, one copy each: vid, copies and scaled x; no shuffle.

    For passes that only sum or compare rows: hours, lengths and names make nearly all inputs
    of a large table distinct, so that merging equal ones moves the table for nothing.  For two
    passes over written features they need not be ``written`` once more: that takes as long as three.
    """
    vectors = features.select(
        F.col(order).alias("vid"), F.lit(1).cast("long").alias("copies"), scaled_vector(stats).alias("x"))
    return cut_lineage(vectors) if written else vectors


def distinct_vectors(features: DataFrame, stats: FeatureStats, order: str = EVENT_KEY) -> DataFrame:
    """Distinct model inputs: vid (first event), copies, vkey and scaled x.

    Equal inputs are merged on the map side before the shuffle, so one input
    that makes up a third of all rows costs one row per task.
    """
    numbers = features.selectExpr(
        order, *[f"{clean_number(c)} AS {c}" for c in stats.columns])
    merged = numbers.groupBy(*stats.columns).agg(
        F.min(order).alias("vid"), F.count("*").alias("copies"))
    return cut_lineage(merged.select(
        "vid", "copies", vector_key(stats.columns).alias("vkey"), scaled_vector(stats).alias("x")))
