"""Running totals, ranks and quantiles over a total order, without one big sort task.

Rows are dealt out by ranges of the order column, ``RANGE_ROWS`` to a range.  The totals of
the ranges give every range its offset, and are themselves summed up in the same way
when they are many; inside a range an ordinary window does the rest.  No task orders
more rows than a range has, however many rows there are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from procwarden.session import cut_lineage

RANGE_ROWS = 200_000
FAN = 64  # parts that a range is cut into on the way to a position


def running_totals(df: DataFrame, order: str, totals: dict[str, str], n_rows: int,
                   groups: list[str] | None = None, descending: bool = False) -> DataFrame:
    """Add inclusive running sums: ``totals`` maps value column -> new column.

    ``order`` must be unique within ``groups``.
    """
    groups = groups or []
    direction = F.desc(order) if descending else F.asc(order)
    if n_rows <= RANGE_ROWS:
        inside = W.partitionBy(*groups, F.lit(0)).orderBy(direction).rowsBetween(W.unboundedPreceding, W.currentRow)
        return df.withColumns({name: F.sum(v).over(inside) for v, name in totals.items()})
    at = f"_range_{order}"  # another name at every level
    ranged = cut_lineage(df.repartitionByRange(-(-n_rows // RANGE_ROWS), direction).withColumn(
        at, F.spark_partition_id()))
    sums = cut_lineage(ranged.groupBy(*groups, at).agg(*[F.sum(v).alias(f"_sum_{v}") for v in totals]))
    n_sums = sums.count()
    # as few rows as one range has, and then one range: the totals get fewer at every level
    upto = running_totals(sums, at, {f"_sum_{v}": f"_upto_{v}" for v in totals},
                          n_sums if n_sums < n_rows else RANGE_ROWS, groups)
    offsets = upto.select(*groups, at, *[
        (F.col(f"_upto_{v}") - F.col(f"_sum_{v}")).alias(f"_off_{v}") for v in totals])
    inside = W.partitionBy(*groups, at).orderBy(direction).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = ranged.join(offsets, groups + [at])
    return out.withColumns({name: F.sum(v).over(inside) + F.col(f"_off_{v}") for v, name in totals.items()}).drop(
        at, *[f"_off_{v}" for v in totals])


def at_position(df: DataFrame, order: str, position: int) -> DataFrame:
    """The row at a position (from 0) of the order; no row if there are fewer.

    Counts tell which part of a range holds the position, until it has ``RANGE_ROWS`` rows
    or less; only that one is sorted, wherever in the order the position is.
    """
    part, skip, n = df, position, df.count()
    while n > RANGE_ROWS and skip < n:
        probs = [i / FAN for i in range(1, FAN)]
        found = part.agg(F.percentile_approx(order, probs, 10_000).alias("c")).first()["c"]
        cuts = sorted(set(found or []))
        below = part.agg(*[F.count_if(F.col(order) < F.lit(c)).alias(f"n{i}") for i, c in enumerate(cuts)]).first()
        edges = [(None, 0), *[(c, below[f"n{i}"]) for i, c in enumerate(cuts)], (None, n)]
        k = max(i for i, (_, before) in enumerate(edges[:-1]) if before <= skip)
        (low, before), (high, after) = edges[k], edges[k + 1]
        if after - before == n:
            break  # equal keys cannot be told apart
        if low is not None:
            part = part.where(F.col(order) >= F.lit(low))
        if high is not None:
            part = part.where(F.col(order) < F.lit(high))
        skip, n = skip - before, after - before
    return part.orderBy(order).offset(skip).limit(1)


def exact_quantiles(counts: DataFrame, group: str, value: str, probs: dict[str, float],
                    n_rows: int) -> DataFrame:
    """Interpolated quantiles per group.

    ``counts`` holds (group, value, _n), one row per distinct value, ``n_rows``
    rows in all; pass it with its lineage cut, since it is read three times.
    """
    run = running_totals(counts, value, {"_n": "_upto"}, n_rows, groups=[group])
    run = run.join(counts.groupBy(group).agg(F.sum("_n").alias("_total")), group)
    out = []
    for name, p in probs.items():
        pos = F.lit(p) * (F.col("_total") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)
        first = F.col("_upto") - F.col("_n")
        v_lo = F.max(F.when((first <= lo) & (lo < F.col("_upto")), F.col(value)))
        v_hi = F.max(F.when((first <= hi) & (hi < F.col("_upto")), F.col(value)))
        out.append((v_lo + (v_hi - v_lo) * F.max(pos - lo)).alias(name))
    return run.groupBy(group).agg(*out)
