"""The anomaly ensemble: fit on benign rows, score 0-100, explain."""

from __future__ import annotations

import inspect
import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procwarden import fixed_values as V
from procwarden.functions.text import half_even, let, number, quoted
from procwarden.operators.boundary import FEATURES, STEPS, Boundary, boundary_score, fit_boundary
from procwarden.operators.forest import Forest, fit_forest, forest_score
from procwarden.operators.lookup import lookup_join
from procwarden.operators.neighbours import (
    OutlierModel, draw_reference, fit_outliers, outlier_factor, outlier_factors,
)
from procwarden.operators.ordered import exact_quantiles
from procwarden.operators.scaling import (
    FeatureStats, distinct_vectors, fit_stats, row_vectors, scaled_vector, vector_key,
)
from procwarden.schema import EVENT_KEY
from procwarden.session import cut_lineage

RANGE_FLOOR = 0.001
PARTS = ("forest", "lof", "boundary")


@dataclass
class Model:
    """All that scoring needs.  ``ranges`` holds (min, max) raw training scores."""

    stats: FeatureStats
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)
    forest: Forest | None = None
    lof: OutlierModel | None = None
    boundary: Boundary | None = None
    fingerprint: str = ""
    digits: int | None = None  # optional rounding of the final score
    options: str = ""  # what ``fit_model`` was asked for

    @property
    def parts(self) -> list[str]:
        return [p for p in PARTS if getattr(self, p) is not None]

    @property
    def weights(self) -> dict[str, float]:
        """Weights of the fitted parts, scaled to sum to 1."""
        total = sum(V.WEIGHTS[p] for p in self.parts)
        return {p: V.WEIGHTS[p] / total for p in self.parts}


def fingerprint(stats: FeatureStats) -> str:
    """Names the baseline that a model was fitted on; ``same_stats`` tells whether another one is the same."""
    means = ",".join(f"{m:.6g}/{s:.6g}" for m, s in zip(stats.mean, stats.std))
    return f"{stats.rows}:{means}"


def raw_columns(model: Model, x: Column) -> dict[str, Column]:
    """Raw scores that need the vector only; higher is odder."""
    out = {}
    if model.forest is not None:
        out["forest"] = forest_score(model.forest, x)
    if model.lof is not None and model.lof.blocks == 1:
        out["lof"] = outlier_factor(model.lof, x)
    if model.boundary is not None:
        out["boundary"] = boundary_score(model.boundary, x)
    return out


def options_text(**options) -> str:
    """The options of ``fit_model``, with its defaults, as one text."""
    bound = inspect.signature(fit_model).bind(None, **options)
    bound.apply_defaults()
    named = {k: v for k, v in bound.arguments.items() if k != "benign"}
    return json.dumps(named | {"parts": sorted(named["parts"])}, sort_keys=True)


def fit_model(benign: DataFrame, parts: tuple[str, ...] = PARTS, trees: int = V.FOREST_TREES,
              steps: int = STEPS, rff: int = FEATURES, neighbours: int = V.LOF_NEIGHBOURS,
              digits: int | None = None, order: str = EVENT_KEY, reference: int | None = None,
              pool_samples: int | None = None) -> Model:
    """Fit on features of benign rows, all of them unless asked otherwise.

    Forest and boundary read the rows' vectors where they lie; the density works on
    distinct vectors with their counts.  ``steps=0`` keeps the boundary at the kernel mean.
    ``reference`` bounds the rows that the density is fitted on, ``pool_samples`` those that the trees'
    samples are drawn from; None takes all.
    """
    stats = fit_stats(benign)
    asked = options_text(parts=parts, trees=trees, steps=steps, rff=rff, neighbours=neighbours, digits=digits, order=order,
                         reference=reference, pool_samples=pool_samples)
    model = Model(stats, fingerprint=fingerprint(stats), digits=digits, options=asked)
    many = "forest" in parts or steps > 0  # passes; the kernel mean takes one and the range of scores another
    vectors = row_vectors(benign, stats, order, written=many) if {"forest", "boundary"} & {*parts} else None
    if "forest" in parts:
        rows = vectors.select(F.col("vid").alias(order), "x")
        model.forest = fit_forest(rows, stats.rows, trees=trees, order=order, pool_samples=pool_samples)
    if "boundary" in parts:
        model.boundary = fit_boundary(vectors, len(stats.columns), features=rff, steps=steps)
    if vectors is not None:
        own = vectors.select(*[c.alias(n) for n, c in raw_columns(model, F.col("x")).items()])
        ends = own.agg(*[f(n).alias(f"{t}_{n}") for n in own.columns for t, f in (("lo", F.min), ("hi", F.max))]).first()
        model.ranges = {n: (ends[f"lo_{n}"], ends[f"hi_{n}"]) for n in own.columns}
    if "lof" in parts:
        drawn = draw_reference(benign, stats.rows, reference, order)
        known = distinct_vectors(drawn, stats, order)
        rows = known.agg(F.sum("copies")).first()[0]
        model.lof, factors = fit_outliers(known, rows, len(stats.columns), neighbours)
        ends = factors.agg(F.min("lof").alias("lo"), F.max("lof").alias("hi")).first()
        model.ranges["lof"] = (ends["lo"], ends["hi"])
    return model


def normalised(raw: Column, ends: tuple[float, float]) -> Column:
    """Place in the training range, as 0-100."""
    low, high = ends
    width = max(high - low, RANGE_FLOOR)
    place = (raw - F.lit(float(low))) / F.lit(float(width)) * F.lit(100.0)
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), place))


def combined(model: Model) -> Column:
    score = sum((F.lit(w) * normalised(F.col(p), model.ranges[p])
                 for p, w in model.weights.items()), F.lit(0.0))
    score = F.greatest(F.lit(0.0), F.least(F.lit(100.0), score))
    return score if model.digits is None else half_even(score, model.digits)


def score_vectors(vectors: DataFrame, model: Model) -> DataFrame:
    """Raw scores and ml_anomaly_score of distinct vectors (vid, vkey, x)."""
    scored = vectors.withColumns(raw_columns(model, F.col("x")))
    if "lof" in model.parts and "lof" not in scored.columns:
        scored = scored.join(outlier_factors(vectors.select("vid", "vkey", "x"), model.lof), "vid", "left")
    return scored.withColumn("ml_anomaly_score", combined(model))


def score(features: DataFrame, model: Model, order: str = EVENT_KEY) -> DataFrame:
    """Add ml_anomaly_score.

    Every row is scored where it lies, no shuffle.  Only with a density reference of
    several blocks distinct vectors are scored, pass by pass, and the events look
    their score up.
    """
    if model.lof is None or model.lof.blocks == 1:
        x = scaled_vector(model.stats)
        names = features.columns
        raw = features.withColumn("_x", x).withColumns(
            raw_columns(model, F.col("_x")))
        return raw.withColumn("ml_anomaly_score", combined(model)).select(
            *[F.col(f"`{c}`") for c in names], "ml_anomaly_score")
    vectors = distinct_vectors(features, model.stats, order)
    table = cut_lineage(score_vectors(vectors, model).select(
        F.col("vkey").alias("_vkey"), "ml_anomaly_score"))
    keyed = features.withColumn("_vkey", vector_key(model.stats.columns))
    return lookup_join(keyed, table, ["_vkey"], table.count()).drop("_vkey")


def explanation(stats: FeatureStats, columns: list[str], score_column: str | None = None) -> str:
    """Which features lie more than two deviations from the baseline, top five (SQL text).

    Deviations equal to 9 decimals count as ties and keep the column order.
    """
    head = "'ANOMALY ANALYSIS'" if score_column is None else (
        f"format_string('ANOMALY SCORE: %.0f/100', {half_even(score_column, 0)})")
    nothing = f"concat({head}, ' | No significantly unusual features detected.')"
    found = []
    for i, (name, mean, std) in enumerate(zip(stats.columns, stats.mean, stats.explain_std)):
        if name not in columns:
            continue
        m, s = number(mean), number(std)
        z = f"abs((cast({name} AS double) - {m}) / {s})"
        found.append(
            f"CASE WHEN {z} > {V.EXPLAIN_Z}D THEN named_struct('nz', -{half_even(z, 9)}, 'i', {i}, "
            f"'v', cast({name} AS double), 'm', {m}, 's', {s}, "
            f"'d', {quoted(V.FEATURE_DESCRIPTIONS.get(name, name))}) END")
    if not found:
        return nothing
    line = ("format_string('%s: %.2f (baseline: %.2f±%.2f, z=%.1f)', d.d, "
            f"{half_even('d.v', 2)}, {half_even('d.m', 2)} + 0D, {half_even('d.s', 2)}, {half_even('-d.nz', 1)})")
    top = f"slice(array_sort(filter(array({', '.join(found)}), d -> d IS NOT NULL)), 1, {V.EXPLAIN_TOP})"
    told = f"array_join(transform({top}, d -> {line}), '; ')"
    return let("w", told, f"CASE WHEN w = '' THEN {nothing} "
                          f"ELSE concat({head}, ' | Unusual factors: ', w) END")


def score_summary(df: DataFrame) -> DataFrame:
    """Per label: mean, median, deviation, range, rows above the threshold."""
    s = F.col("ml_anomaly_score")
    rows = df.select("label", s)
    plain = rows.groupBy("label").agg(
        F.count("*").alias("events"), F.avg(s).alias("mean_score"),
        F.stddev_samp(s).alias("std_score"), F.min(s).alias("min_score"),
        F.max(s).alias("max_score"), F.count_if(s > V.ML_THRESHOLD).alias("above"),
    ).withColumn("above_pct", F.col("above") / F.col("events") * 100)
    counts = cut_lineage(rows.groupBy("label", "ml_anomaly_score").agg(F.count("*").alias("_n")))
    medians = exact_quantiles(counts, "label", "ml_anomaly_score",
                              {"median_score": 0.5}, counts.count())
    return plain.join(medians, "label")


def top_anomalies(df: DataFrame, model: Model, n: int = 10) -> DataFrame:
    """Highest scores with names and explanation, worked out for the top rows only."""
    top = df.orderBy(F.desc("ml_anomaly_score"), EVENT_KEY).limit(n)
    return top.withColumn("explanation", F.expr(explanation(
        model.stats, df.columns, "ml_anomaly_score")))


def alert_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("ml_anomaly_score") > V.ML_THRESHOLD).alias("ml_alerts"))
