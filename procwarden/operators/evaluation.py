"""Grading of the layers against labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from procwarden.fixed_values import CHAIN_THRESHOLD, ML_THRESHOLD
from procwarden.functions.text import basename, col, half_even
from procwarden.operators.ordered import running_totals
from procwarden.session import cut_lineage

LAYERS = {
    "sigma": lambda: F.col("sigma_match"),
    "ml": lambda: F.col("ml_anomaly_score") > ML_THRESHOLD,
    "chain": lambda: F.col("chain_risk_score") > CHAIN_THRESHOLD,
    "combined": lambda: flagged(),
}
METRICS = ["precision", "recall", "f1", "fpr", "tp", "fp", "fn", "tn"]


def flagged() -> Column:
    return F.col("final_verdict").isin("ALERT", "REVIEW")


def bad() -> Column:
    return F.col("is_malicious") == 1


def good() -> Column:
    return F.col("is_malicious") == 0


def confusion_cells() -> list[Column]:
    """Counts ``layer_tp`` ... for every layer, to be taken in one scan."""
    return [
        F.count_if(truth() & hit).alias(f"{layer}_{cell}")
        for layer, condition in LAYERS.items()
        for cell, truth, hit in [("tp", bad, condition()), ("fp", good, condition()),
                                 ("fn", bad, ~condition()), ("tn", good, ~condition())]]


def confusion(df: DataFrame) -> DataFrame:
    """tp, fp, fn, tn per layer, from one scan of the events."""
    return df.agg(*confusion_cells()).select(F.inline(F.array(*[
        F.struct(F.lit(layer).alias("layer"),
                 *[F.col(f"{layer}_{c}").alias(c) for c in ("tp", "fp", "fn", "tn")])
        for layer in LAYERS])))


def metric_columns(prefix: str = "") -> list[Column]:
    """Precision, recall, f1 and false positive rate, 4 decimals, then the counts."""
    tp, fp, fn, tn = (F.col(prefix + c) for c in ("tp", "fp", "fn", "tn"))
    p = tp / F.greatest(tp + fp, F.lit(1))
    r = tp / F.greatest(tp + fn, F.lit(1))
    f1 = F.lit(2.0) * p * r / F.greatest(p + r, F.lit(0.001))
    values = [half_even(p, 4), half_even(r, 4), half_even(f1, 4),
              half_even(fp / F.greatest(fp + tn, F.lit(1)), 4), tp, fp, fn, tn]
    return [v.alias(prefix + m) for m, v in zip(METRICS, values)]


def evaluate_layers(df: DataFrame) -> DataFrame:
    return confusion(df).select("layer", *metric_columns())


def wide_metrics(df: DataFrame, *extra: Column) -> DataFrame:
    """All layers' metrics in one row, columns ``layer_metric``, after ``extra``."""
    row = df.agg(*extra, *confusion_cells())
    kept = row.columns[:len(extra)]
    return row.select(*kept, *[c for layer in LAYERS for c in metric_columns(f"{layer}_")])


def compare_layers(df: DataFrame) -> DataFrame:
    """Does the combination hold up against its parts?"""
    return wide_metrics(df).select(
        (F.col("combined_recall") >= F.col("sigma_recall")).alias("recall_ge_sigma"),
        (F.col("combined_recall") >= F.col("ml_recall")).alias("recall_ge_ml"),
        (F.col("combined_precision") > 0).alias("has_precision"),
        "combined_recall", "combined_precision")


def missed_by_rules(df: DataFrame) -> DataFrame:
    """Malicious events without a rule hit, per technique."""
    return (df.filter(bad() & ~F.col("sigma_match"))
            .filter(F.coalesce(F.col("mitre_technique_id"), F.lit("")) != "")
            .groupBy("mitre_technique_id").agg(
                F.min_by("technique_name", "event_id").alias("technique_name"),
                F.count("*").alias("missed")))


def technique_breakdown(df: DataFrame) -> DataFrame:
    """Hits of every layer per technique; the rate in percent."""
    return (df.filter(bad())
            .filter(F.coalesce(F.col("mitre_technique_id"), F.lit("")) != "")
            .groupBy("mitre_technique_id").agg(
                F.min_by("technique_name", "event_id").alias("technique_name"),
                F.count("*").alias("total"),
                *[F.count_if(hit()).alias(layer) for layer, hit in LAYERS.items()])
            .withColumn("detection_pct", F.col("combined") / F.greatest(F.col("total"), F.lit(1)) * 100))


def technique_coverage(df: DataFrame) -> DataFrame:
    return technique_breakdown(df).select(
        F.concat("mitre_technique_id", F.lit(": "), "technique_name").alias("technique"),
        "total", F.col("combined").alias("detected"), F.col("detection_pct").alias("detection_rate"))


def roc_points(df: DataFrame) -> DataFrame:
    """One point per distinct score: cumulative hits from the highest score down.

    Events are reduced to distinct scores before any ordering; the running sums
    are taken range by range.
    """
    per_score = cut_lineage(df.groupBy(F.col("ml_anomaly_score").alias("score")).agg(
        F.count_if(bad()).alias("pos"), F.count_if(good()).alias("neg")))
    sums = per_score.agg(F.count("*").alias("n"), F.sum("pos").alias("p"), F.sum("neg").alias("q")).first()
    p, q = float(sums["p"] or 0) or 1.0, float(sums["q"] or 0) or 1.0
    run = running_totals(per_score, "score", {"pos": "tp", "neg": "fp"}, sums["n"], descending=True)
    return run.select("score", "pos", "neg", "tp", "fp",
                      (F.col("tp") / p).alias("tpr"), (F.col("fp") / q).alias("fpr"))


def area_under_curve(points: DataFrame) -> DataFrame:
    """Trapezoids; the point before is the running sum less the own counts."""
    before = F.col("tp") - F.col("pos")
    doubled = F.sum(F.col("neg") * (F.col("tp") + before))
    scale = F.greatest(F.max("tp") * F.max("fp") * 2, F.lit(1))
    return points.agg((doubled / scale).alias("auc"))


def operating_point(points: DataFrame, threshold: float = ML_THRESHOLD) -> DataFrame:
    """The point whose score is nearest the threshold; of two, the higher."""
    best = F.min_by(F.struct("score", "tpr", "fpr"),
                    F.struct(F.abs(F.col("score") - threshold), -F.col("score")))
    return points.agg(best.alias("b")).select("b.score", "b.tpr", "b.fpr")


def false_positives(df: DataFrame) -> DataFrame:
    return df.filter(good() & flagged())


def false_positives_by_label(df: DataFrame) -> DataFrame:
    """Count per label, and the total of all labels beside each."""
    counts = false_positives(df).groupBy("label").agg(F.count("*").alias("fps"))
    return counts.withColumn("total_fps", F.sum("fps").over(W.partitionBy(F.lit(0))))  # a row per label


def false_positives_by_process(df: DataFrame, n: int = 5) -> DataFrame:
    return (false_positives(df).groupBy(col(basename("Image")).alias("process"))
            .agg(F.count("*").alias("fps")).orderBy(F.desc("fps"), "process").limit(n))


def false_positive_triggers(df: DataFrame) -> DataFrame:
    """How many were triggered by each layer; an event can count in several."""
    return false_positives(df).agg(
        F.count("*").alias("total"),
        *[F.count_if(LAYERS[k]()).alias(f"by_{k}") for k in ("sigma", "ml", "chain")])


def tuning_hints(df: DataFrame, limit: int = 5) -> DataFrame:
    """(hint, subject, fps): noisy rules, and thresholds worth raising."""
    fps = false_positives(df)
    per_rule = (fps.filter("sigma_match").groupBy(F.col("sigma_rule_name").alias("subject"))
                .agg(F.count("*").alias("fps")).select(F.lit("exclude").alias("hint"), "subject", "fps"))
    triggers = fps.agg(F.count_if(LAYERS["ml"]()).alias("ml"), F.count_if(LAYERS["chain"]()).alias("chain"))
    raises = triggers.select(F.inline(F.array(
        F.struct(F.lit("raise").alias("hint"), F.lit("ml 70 to 75").alias("subject"), F.col("ml").alias("fps")),
        F.struct(F.lit("raise").alias("hint"), F.lit("chain 60 to 70").alias("subject"), F.col("chain").alias("fps")),
    ))).filter(F.col("fps") > limit)
    return per_rule.unionByName(raises)
