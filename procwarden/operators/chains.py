"""Risk of the parent -> child pair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procwarden import fixed_values as V
from procwarden.functions import text as X
from procwarden.functions.timeparts import hour_or_null
from procwarden.operators.clean import drop_helpers, prepare


ENCODED = ["-enc ", "-encodedcommand"]
# (points, text, condition) in the order in which they are listed.
MODIFIERS = [
    (20, "+20 Office→Script chain",
     f"_parent IN {X.name_list(V.OFFICE_APPS)} AND _child IN {X.name_list(V.SCRIPT_ENGINES)}"),
    (15, "+15 URL in command", X.contains_any("_cmd", ["http://", "https://"])),
    (10, "+10 LOLBin child", f"_child IN {X.name_list(V.CHAIN_BINARIES)} AND pair_desc IS NULL"),
    (10, "+10 off-hours", f"{hour_or_null('UtcTime')} BETWEEN 0 AND 5"),
    (10, "+10 encoded command", X.contains_any("_cmd", ENCODED)),
    (5, "+5 suspicious flags", X.contains_any("_cmd", V.CHAIN_FLAGS)),
]
SETS = 1 << len(MODIFIERS)  # of modifiers that hold
# Modifiers by place that columns tell: row features, and tests that ``row_features`` makes beside them.
TESTS = {
    "_encoded": lambda: X.matched("_cmd", X.any_of(ENCODED)),
    "_flagged": lambda: X.matched("_cmd", X.any_of(V.CHAIN_FLAGS)),
}
TOLD_BY = {1: "contains_url", 3: "is_off_hours", 4: "_encoded", 5: "_flagged"}


def pair_table(spark) -> DataFrame:
    """The fixed table of suspicious pairs, numbered from 1."""
    rows = ", ".join(f"({X.quoted(p)}, {X.quoted(c)}, {s}, {X.quoted(d)}, {i})"
                     for i, (p, c, s, d) in enumerate(V.SUSPICIOUS_PAIRS, 1))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(_parent, _child, pair_score, pair_desc, pair_number)")


def with_pair(prepared: DataFrame) -> DataFrame:
    """Base score, description and number of a listed pair (a fixed table, broadcast)."""
    return prepared.join(F.broadcast(pair_table(prepared.sparkSession)),
                         ["_parent", "_child"], "left")


def modifier(i: int):
    """Points of one modifier; an unreadable time adds nothing."""
    points, _, condition = MODIFIERS[i]
    return X.col(f"CASE WHEN {condition} THEN {points} ELSE 0 END")


def chain_codes(df: DataFrame) -> DataFrame:
    """Add ``_chain``: the number of the listed pair (0: none) and, in the lowest bits, the modifiers that hold.

    ``df`` has the helper columns of ``prepare``.  The code is all that a chain tells of the texts.  Tests
    that stand in ``df`` as columns (``TOLD_BY``) are not made again.
    """
    conditions = [f"{TOLD_BY[i]} = 1" if TOLD_BY.get(i) in df.columns else cond for i, (_, _, cond) in enumerate(MODIFIERS)]
    mask = " + ".join(f"CASE WHEN {cond} THEN {1 << i} ELSE 0 END" for i, cond in enumerate(conditions))
    return with_pair(df).withColumn("_chain", X.col(f"coalesce(pair_number, 0) * {SETS} + {mask}")).drop(
        "pair_score", "pair_desc", "pair_number", *TESTS)


def told_chains(df: DataFrame) -> DataFrame:
    """Add chain_risk_score, chain_description and chain_matched_pattern, from ``_chain`` and the names."""
    pairs = [(0, "No known suspicious pattern"), *[(s, d) for _, _, s, d in V.SUSPICIOUS_PAIRS]]
    sets = [[(p, t) for i, (p, t, _) in enumerate(MODIFIERS) if m >> i & 1] for m in range(SETS)]
    marks = [f" [Modifiers: {', '.join(t for _, t in on)}]" if on else "" for on in sets]
    pair, on = f"_chain div {SETS}", f"_chain % {SETS}"
    points = f"{nth([s for s, _ in pairs], pair)} + {nth([sum(p for p, _ in s) for s in sets], on)}"
    return df.withColumns({
        "chain_risk_score": X.col(f"least({points}, 100)"),
        "chain_description": X.col(
            f"concat(_parent, ' → ', _child, ': ', {nth([d for _, d in pairs], pair)}, {nth(marks, on)})"),
        "chain_matched_pattern": X.col(f"_chain >= {SETS}"),
    }).drop("_chain")


def nth(values: list, index: str) -> str:
    """One of some constants, by its place from 0."""
    told = ", ".join(X.quoted(v) if isinstance(v, str) else str(v) for v in values)
    return f"element_at(array({told}), cast({index} AS int) + 1)"


def score_chains(df: DataFrame) -> DataFrame:
    """Add chain_risk_score, chain_description and chain_matched_pattern.

    ``df`` has the helper columns of ``prepare``.
    """
    return told_chains(chain_codes(df))


def analyse_chains(events: DataFrame) -> DataFrame:
    """Chains on their own, from plain events."""
    return drop_helpers(score_chains(prepare(events)))


def chain_summary(df: DataFrame) -> DataFrame:
    score = F.col("chain_risk_score")
    return df.groupBy("label").agg(
        F.count("*").alias("events"), F.avg(score).alias("mean_risk"),
        F.max(score).alias("max_risk"),
        F.count_if("chain_matched_pattern").alias("matched"),
        F.count_if(score > V.CHAIN_HIGH_RISK).alias("high_risk"),
    ).withColumns({
        "matched_pct": F.col("matched") / F.col("events") * 100,
        "high_risk_pct": F.col("high_risk") / F.col("events") * 100,
    })


def top_chains(df: DataFrame, n: int = 15) -> DataFrame:
    return (df.orderBy(F.desc("chain_risk_score"), "event_id").limit(n)
            .select("event_id", "label", "chain_risk_score",
                    F.substring("chain_description", 1, 80).alias("description")))
