"""Benign baseline: length and entropy statistics, pair frequencies."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procwarden.functions.text import half_even, shannon_entropy
from procwarden.operators.clean import prepare
from procwarden.session import cut_lineage

LENGTH_STD_FLOOR = 1.0
ENTROPY_STD_FLOOR = 0.1
FREQ_FLOOR = 1e-10


@dataclass
class Baseline:
    """Scalars, and the pair table (parent, child, n, freq, rarity)."""

    events: int = 0
    length_mean: float = 0.0
    length_std: float = 1.0
    entropy_mean: float = 0.0
    entropy_std: float = 1.0
    unseen_rarity: float | None = None
    pairs: DataFrame | None = None
    n_pairs: int = 0


def pair_profile(rows: DataFrame) -> DataFrame:
    """One row per pair: count, mean and variance of length and entropy."""
    length = F.col("command_line_length").cast("double")
    entropy = F.col("command_line_entropy")
    return rows.groupBy(F.col("_parent").alias("parent"), F.col("_child").alias("child")).agg(
        F.count("*").alias("n"),
        F.avg(length).alias("len_mean"), F.var_pop(length).alias("len_var"),
        F.avg(entropy).alias("ent_mean"), F.var_pop(entropy).alias("ent_var"),
    )


def with_rarity(pairs: DataFrame, total: int) -> DataFrame:
    """Frequency of a pair and its rarity, -log10 of the frequency."""
    freq = F.col("n") / F.lit(float(total))
    return pairs.select(
        "parent", "child", "n", freq.alias("freq"),
        half_even(-F.log10(F.greatest(freq, F.lit(FREQ_FLOOR))), 4).alias("rarity"))


def fit_baseline(benign: DataFrame) -> Baseline:
    """Baseline of plain events."""
    return fit_baseline_rows(prepare(benign).select(
        "_parent", "_child", F.length("CommandLine").alias("command_line_length"),
        shannon_entropy("CommandLine").alias("command_line_entropy")))


def fit_baseline_rows(rows: DataFrame) -> Baseline:
    """Baseline of rows with names, length and entropy.

    One pass over the rows; all else works on the pair table.  It is
    pre-aggregated on the map side, so a pair that holds a third of the rows
    sends one row per task.  Means and variances per pair are merged to the
    overall ones without loss of precision.
    """
    profile = cut_lineage(pair_profile(rows))
    total = F.sum("n")
    head = profile.agg(
        total.alias("n"), F.count("*").alias("pairs"),
        (F.sum(F.col("n") * F.col("len_mean")) / total).alias("lm"),
        (F.sum(F.col("n") * F.col("ent_mean")) / total).alias("em"),
        F.min("n").alias("rarest"),
    ).first()
    if not head["n"]:
        return Baseline()
    lm, em, n = head["lm"], head["em"], head["n"]

    def spread(var: str, mean: str, overall: float):
        gap = F.col(mean) - F.lit(overall)
        return F.sum(F.col("n") * (F.col(var) + gap * gap))

    ss = profile.agg(spread("len_var", "len_mean", lm).alias("l"),
                     spread("ent_var", "ent_mean", em).alias("e")).first()
    divisor = max(n - 1, 1)
    rarest = round((1.0 - math.log10(max(head["rarest"] / n, FREQ_FLOOR))) * 1e4) / 1e4
    return Baseline(
        events=n,
        length_mean=lm, length_std=max((ss["l"] / divisor) ** 0.5, LENGTH_STD_FLOOR),
        entropy_mean=em, entropy_std=max((ss["e"] / divisor) ** 0.5, ENTROPY_STD_FLOOR),
        unseen_rarity=rarest,
        pairs=with_rarity(profile, n), n_pairs=head["pairs"],
    )


def baseline_stats(spark, baseline: Baseline) -> DataFrame:
    """The scalar statistics as a one-row table."""
    b = baseline
    return spark.range(1).select(
        F.lit(b.events).cast("long").alias("events"),
        F.lit(float(b.length_mean)).alias("length_mean"),
        F.lit(float(b.length_std)).alias("length_std"),
        F.lit(float(b.entropy_mean)).alias("entropy_mean"),
        F.lit(float(b.entropy_std)).alias("entropy_std"),
        F.lit(b.unseen_rarity).cast("double").alias("unseen_rarity"),
        F.lit(b.n_pairs).cast("long").alias("n_pairs"))
