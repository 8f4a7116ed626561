"""Fusion of the three layers into verdict, priority, confidence and reason."""

from __future__ import annotations

from pyspark.sql import DataFrame

from procwarden.fixed_values import CHAIN_THRESHOLD, ML_THRESHOLD
from procwarden.functions.text import col, half_even

ML, CHAIN = "ml_anomaly_score", "chain_risk_score"
ML_0, CHAIN_0 = half_even(ML, 0), half_even(f"cast({CHAIN} AS double)", 0)
OVER_ML = f"({ML} - {ML_THRESHOLD})"
OVER_CHAIN = f"cast({CHAIN} - {CHAIN_THRESHOLD} AS double)"


def ladder(critical: str, high: str, medium: str, low: str, clear: str) -> str:
    """The first rung that holds; both thresholds are exclusive."""
    odd, risky = f"{ML} > {ML_THRESHOLD}", f"{CHAIN} > {CHAIN_THRESHOLD}"
    return (f"CASE WHEN sigma_match THEN {critical} WHEN {odd} AND {risky} THEN {high} "
            f"WHEN {odd} THEN {medium} WHEN {risky} THEN {low} ELSE {clear} END")


VERDICT = ladder("'ALERT'", "'ALERT'", "'ALERT'", "'REVIEW'", "'CLEAR'")
PRIORITY = ladder("'CRITICAL'", "'HIGH'", "'MEDIUM'", "'LOW'", "'NONE'")
CONFIDENCE = half_even(ladder(
    f"least(90D + {ML} / 10, 100D)",
    f"75D + least({OVER_ML} / 3 + {OVER_CHAIN} / 4, 14D)",
    f"50D + least({OVER_ML} / 1.5D, 24D)",
    f"30D + least({OVER_CHAIN} / 2, 19D)",
    f"greatest(0D, {ML} / 3)"), 1)


def reason(ml_reason: str) -> str:
    return ladder(
        "format_string('Sigma rule matched: %s | ML Score: %.0f | Chain Risk: %.0f', "
        f"sigma_rule_name, {ML_0}, {CHAIN_0})",
        f"format_string('Chain + ML anomaly detected | ML Score: %.0f | Chain: %s', {ML_0}, chain_description)",
        ml_reason,
        "concat('Suspicious chain detected | Chain: ', chain_description)",
        "''")


def fuse(df: DataFrame, ml_reason: str | None = None) -> DataFrame:
    """Add final_verdict, priority, confidence and explanation."""
    ml_reason = ml_reason or f"format_string('ML anomaly score: %.0f', {ML_0})"
    return df.withColumns({
        "final_verdict": col(VERDICT), "priority": col(PRIORITY),
        "confidence": col(CONFIDENCE), "explanation": col(reason(ml_reason))})
