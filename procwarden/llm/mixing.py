"""Mixing sources to target weights along a curriculum, with DataFrame functions only.

Every source has a total target (a water-filling of the weights under a limit
on repeats) and a schedule: a line of knots that says how its demand is spread
over training, from 0 to 1.  The integral of the schedule is the cumulative
demand; a document that starts at a given word of its source is placed where
that demand is reached.  Sources, their order and the offsets of documents are
exact whatever the partitioning is, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from procwarden.llm.common import small_or_shuffled, with_rank
from procwarden.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5  # words of the mix, as a share of all words
REPEATS = 2  # a source, and a document, is taken so often at most
#: Relative demand over training, as knots (time, weight): the first sources lead
#: early, the last ones late.  One line per weight, repeating as the weights do.
SCHEDULES = (((0.0, 3.0), (0.5, 2.0), (1.0, 1.0)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.0), (0.5, 1.0), (1.0, 4.0)))


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash_order(doc_id: Column) -> Column:
    """Pseudo-random 60-bit number of a document, the same in every engine."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def _cycle(values: list[Column], at: Column) -> Column:
    return F.element_at(F.array(*values), (at % len(values)).cast("int") + 1)


def water_level(sources: DataFrame, total: float) -> float:
    """The level L at which sum(min(limit, weight * L)) is ``total``; limits sum to more."""
    level, capped = 0.0, -1
    while True:
        full = F.col("_limit") <= F.col("_weight") * F.lit(level)
        row = sources.agg(F.sum(F.when(full, F.col("_limit")).otherwise(0)).alias("limits"),
                          F.sum(F.when(full, 0.0).otherwise(F.col("_weight"))).alias("weights"),
                          F.sum(full.cast("int")).alias("n")).first()
        if not row["weights"] or row["n"] == capped:
            return level if row["weights"] else math.inf
        level, capped = (total - row["limits"]) / row["weights"], row["n"]


def placed(share: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time at which a schedule's integral reaches ``share`` (0 to 1) of its whole."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False)]
    need, out, done = share * sum(areas), F.lit(1.0), sum(areas)
    for a, b, area in reversed(list(zip(knots, knots[1:], areas, strict=False))):
        done -= area
        rest, slope = need - done, (b[1] - a[1]) / (b[0] - a[0])
        if slope:
            into = (F.sqrt(F.greatest(F.lit(0.0), F.lit(a[1] ** 2) + 2 * slope * rest)) - a[1]) / slope
        else:
            into = rest / a[1]
        out = F.when(need < done + area, a[0] + into).otherwise(out)
    return out


def mix_sources(sized: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Add source_size, target, taken and training positions to (doc_id, source, size) and ``keep``.

    Sources by code point, null last, have the repeating ``WEIGHTS``.  Documents of
    a source come in hash order and are taken whole until the target, rounded to a
    word, is reached; the last one is taken in part, so that a source's taken words
    are its target.  ``first_position`` and ``second_position`` are the times of
    training (0 to 1) at which the first and the second copy start, null if not taken.

    Rows of equal id and size come in the order of ``keep``.  Ranges of the whole order are
    summed up, so that rows of one id (or none), however many, are shared among tasks.

    Repeated rows are documents of their own; those without words are never taken
    (taken 0).  An empty table gives no rows, and so do no words at all targets of 0.
    """
    sized = cut_lineage(sized.select(
        "doc_id", "source", "size", *(keep or []), hash_order(F.col("doc_id")).alias("_h"),
        F.monotonically_increasing_id().alias("_own")))
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_rank(sums, [F.col("source").asc_nulls_last()], "_rank")
    sources = cut_lineage(ranked.withColumns({
        "_weight": _cycle([F.lit(w) for w in WEIGHTS], F.col("_rank")),
        "_limit": REPEATS * F.col("source_size")}))
    total = sources.agg(F.sum("source_size").alias("s"), F.count("*").alias("n")).first()
    level = water_level(sources, SHARE * (total["s"] or 0))
    limits = sources.withColumn("target", F.least(F.col("_limit").cast("double"), F.col("_weight") * F.lit(level)))
    docs = (sized.withColumns({"_none": F.col("source").isNull(), "_name": F.coalesce("source", F.lit(""))})
            .join(small_or_shuffled(limits.select(
                F.col("source").isNull().alias("_none"), F.coalesce("source", F.lit("")).alias("_name"),
                "_rank", "source_size", "target"), total["n"]), ["_none", "_name"]).drop("_none", "_name"))
    order = ["_h", "doc_id", "size", *(keep or []), "_own"]
    docs = cut_lineage(docs.repartitionByRange("_rank", *order).withColumn("_group", F.spark_partition_id()))
    group_sums = docs.groupBy("_rank", "_group").agg(F.sum("size").alias("_sum"))
    before = W.partitionBy("_rank").orderBy("_group").rowsBetween(W.unboundedPreceding, -1)
    offsets = group_sums.select("_rank", "_group", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = W.partitionBy("_rank", "_group").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    run = (docs.withColumn("_upto", F.sum("size").over(inside)).join(offsets, ["_rank", "_group"])
           .withColumns({"_start": F.col("_offset") + F.col("_upto") - F.col("size"),
                         "_goal": F.round("target").cast("long")}))
    columns = {}
    for name, start in (("first", F.col("_start")), ("second", F.col("_start") + F.col("source_size"))):
        columns[f"{name}_taken"] = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_goal") - start))
        share = start / F.greatest(F.col("_goal"), F.lit(1))
        at = _cycle([placed(share, s) for s in SCHEDULES], F.col("_rank"))
        columns[f"{name}_position"] = F.when(columns[f"{name}_taken"] > 0, F.round(at, 9))
    return run.withColumns(columns).select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("first_taken") + F.col("second_taken")).alias("taken"),
        "first_taken", "second_taken", "first_position", "second_position", *(keep or []))


def mix_documents(docs: DataFrame) -> DataFrame:
    """``mix_sources`` over (doc_id, source, text); a size is the number of words, 0 for null."""
    return mix_sources(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")))


def in_training_order(mixed: DataFrame) -> DataFrame:
    """Range-sorted by the first position; documents that are not taken come last."""
    return mixed.orderBy(F.col("first_position").asc_nulls_last(), "doc_id")


ORACLE = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rnk
  FROM sized GROUP BY source
), sources AS (
  SELECT *, CASE rnk % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         2 * source_size AS lim FROM sums
), level AS (
  SELECT 0 AS i, 0.0::DOUBLE AS l
  UNION ALL
  SELECT level.i + 1, x.l FROM level, LATERAL (
    SELECT (1.5::DOUBLE * sum(source_size)::BIGINT
            - coalesce(sum(CASE WHEN lim <= weight * level.l THEN lim END), 0)::BIGINT)
           / nullif(sum(CASE WHEN lim <= weight * level.l THEN 0.0::DOUBLE ELSE weight END), 0) AS l
    FROM sources) x
  WHERE level.i < 40 AND x.l IS NOT NULL
), targets AS (
  SELECT source, source_size, rnk, least(lim::DOUBLE, weight * (SELECT l FROM level ORDER BY i DESC LIMIT 1)) AS target
  FROM sources
), run AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target, t.rnk, round(t.target)::BIGINT AS goal,
         (sum(s.size) OVER (PARTITION BY t.rnk ORDER BY s.h, s.doc_id, s.size
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT - s.size AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, source, size, source_size, target,
       greatest(0, least(size, goal - start)) + greatest(0, least(size, goal - start - source_size)) AS taken,
       greatest(0, least(size, goal - start)) AS first_taken,
       greatest(0, least(size, goal - start - source_size)) AS second_taken,
       CASE WHEN least(size, goal - start) > 0 THEN {first} END AS first_position,
       CASE WHEN least(size, goal - start - source_size) > 0 THEN {second} END AS second_position
FROM run
"""


def oracle_sql() -> str:
    """The same rows in DuckDB's SQL; the schedules are rendered as they are placed here."""
    def at(share: str, knots: tuple[tuple[float, float], ...]) -> str:
        areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False)]
        d = "{}::DOUBLE".format
        need, out, done = f"({share} * {d(sum(areas))})", "1.0::DOUBLE", sum(areas)
        for a, b, area in reversed(list(zip(knots, knots[1:], areas, strict=False))):
            done -= area
            slope = (b[1] - a[1]) / (b[0] - a[0])
            rest = f"({need} - {d(done)})"
            into = (f"(sqrt(greatest(0.0::DOUBLE, {d(a[1] ** 2)} + {d(2 * slope)} * {rest})) - {d(a[1])}) / {d(slope)}"
                    if slope else f"{rest} / {d(a[1])}")
            out = f"CASE WHEN {need} < {d(done + area)} THEN {d(a[0])} + {into} ELSE {out} END"
        return out

    def position(start: str) -> str:
        share = f"({start} / greatest(goal, 1)::DOUBLE)"
        cases = " ".join(f"WHEN {i} THEN {at(share, s)}" for i, s in enumerate(SCHEDULES))
        return f"round(CASE rnk % {len(SCHEDULES)} {cases} END, 9)"

    return ORACLE.format(first=position("start::DOUBLE"), second=position("(start + source_size)::DOUBLE"))
