"""Counts and tables of the summary and the analyst view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from procwarden.functions.timeparts import hour_or_null
from procwarden.operators.clean import with_display_names
from procwarden.operators.evaluation import bad, flagged, good, wide_metrics
from procwarden.operators.ordered import exact_quantiles
from procwarden.session import cut_lineage


def share_of_all():
    """Percentage of the counted events, over a table of a few groups."""
    return F.col("events") / F.sum("events").over(W.partitionBy(F.lit(0))) * 100


def verdict_shares(df: DataFrame) -> DataFrame:
    """Count and percentage per verdict; an empty table gives no rows."""
    counts = df.groupBy("final_verdict").agg(F.count("*").alias("events"))
    return counts.withColumn("pct", share_of_all())


def priority_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("priority").agg(F.count("*").alias("events"))


def detection_vs_truth(df: DataFrame) -> DataFrame:
    """True and false positives over ALERT only; caught over ALERT and REVIEW."""
    alert = F.col("final_verdict") == "ALERT"
    return df.agg(
        F.count_if(alert & bad()).alias("true_positives"),
        F.count_if(alert & good()).alias("false_positives"),
        F.count_if(bad() & flagged()).alias("caught"),
        F.count_if(bad()).alias("malicious"),
    ).withColumn("caught_pct", F.col("caught") / F.greatest(F.col("malicious"), F.lit(1)) * 100)


def first_alerts(df: DataFrame, n: int = 20) -> DataFrame:
    return alert_table(df.filter(F.col("final_verdict") == "ALERT").orderBy("event_id").limit(n))


def alert_table(df: DataFrame) -> DataFrame:
    return df.select("event_id", F.substring("UtcTime", 1, 19).alias("timestamp"), "priority",
                     "sigma_rule_name", "ml_anomaly_score", "confidence")


def headline_cells():
    return [
        F.count("*").alias("total_events"),
        F.count_if(F.col("final_verdict") == "ALERT").alias("alerts"),
        *[F.count_if(F.col("priority") == p.upper()).alias(p) for p in ("critical", "high", "medium")]]


def headline_counts(df: DataFrame) -> DataFrame:
    return df.agg(*headline_cells())


def score_histogram(df: DataFrame, bins: int = 40) -> DataFrame:
    """Events per score bin and label; a score of 100 is in the last bin."""
    width = 100.0 / bins
    b = F.floor(F.least("ml_anomaly_score", F.lit(99.999)) / F.lit(width))
    return df.groupBy(b.cast("long").alias("bin"), "label").agg(F.count("*").alias("events")) \
        .withColumn("bin_start", F.col("bin") * F.lit(width))


def hour_histogram(df: DataFrame) -> DataFrame:
    return df.groupBy("hour_of_day", "label").agg(F.count("*").alias("events"))


def entropy_summary(df: DataFrame) -> DataFrame:
    """Five numbers per label."""
    counts = cut_lineage(df.groupBy("label", "command_line_entropy").agg(F.count("*").alias("_n")))
    return exact_quantiles(counts, "label", "command_line_entropy", {
        "low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}, counts.count())


def alert_listing(df: DataFrame) -> DataFrame:
    """Alerts and reviews, most confident first."""
    return (with_display_names(df.filter(flagged())).select(
        "event_id", "UtcTime", "priority", "parent_process", "child_process", "sigma_rule_name",
        "ml_anomaly_score", "chain_risk_score", "confidence", "label")
        .orderBy(F.desc("confidence"), "event_id"))


def incident_row(df: DataFrame) -> DataFrame:
    """One row with the counts and every layer's metrics, from one scan."""
    return wide_metrics(df, *headline_cells())


def facets(df: DataFrame) -> DataFrame:
    """Choices of the three filters, sorted; a handful of fixed values each."""
    return df.agg(*[F.array_join(F.array_sort(F.collect_set(c)), ",").alias(n)
                    for n, c in [("priorities", "priority"), ("verdicts", "final_verdict"),
                                 ("labels", "label")]])


def label_profile(events: DataFrame) -> DataFrame:
    """Per label: count, share, and events in business hours, at night, else."""
    hour = F.expr(hour_or_null("UtcTime"))
    business, night = hour.between(8, 17), hour.between(0, 5)
    counts = events.groupBy("label").agg(
        F.count("*").alias("events"), F.count_if(business).alias("business"),
        F.count_if(night).alias("off_hours"))
    return counts.select(
        "label", "events", share_of_all().alias("pct"),
        "business", "off_hours",
        (F.col("events") - F.col("business") - F.col("off_hours")).alias("other"))


def technique_profile(events: DataFrame) -> DataFrame:
    return events.filter(bad()).groupBy("mitre_technique_id", "technique_name").agg(
        F.count("*").alias("events"))


def union_labelled(benign: DataFrame, malicious: DataFrame, gray_area: DataFrame) -> DataFrame:
    """The three labelled sets as one table."""
    return benign.unionByName(malicious).unionByName(gray_area)
