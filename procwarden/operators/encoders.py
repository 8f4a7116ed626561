"""Label codes in order of first appearance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procwarden.operators.lookup import lookup_join
from procwarden.operators.ordered import running_totals
from procwarden.schema import EVENT_KEY
from procwarden.session import cut_lineage


@dataclass
class Encoder:
    """Table (value, code) with its row count, which is also the next code."""

    codes: DataFrame
    size: int


def fit_encoders(df: DataFrame, values: dict[str, str], known: dict[str, Encoder] | None = None,
                 order: str = EVENT_KEY) -> dict[str, Encoder]:
    """Codes 0, 1, 2 ... by the first event of a value, for several columns in one pass.

    ``values``: encoder name -> column.  Only distinct values are ranked, never events.
    With known encoders their codes stay and new values are appended after the last.
    """
    known = known or {}
    told = F.inline(F.array(*[
        F.struct(F.lit(name).alias("name"), F.col(c).alias("value")) for name, c in values.items()]))
    firsts = df.select(told, F.col(order)).groupBy("name", "value").agg(F.min(order).alias("first"))
    for name, encoder in known.items():
        old = encoder.codes.select(F.lit(name).alias("name"), "value")
        firsts = firsts.join(old, ["name", "value"], "left_anti")
    firsts = cut_lineage(firsts)
    fresh = {r["name"]: r["count"] for r in firsts.groupBy("name").count().collect()}  # one row per encoder
    ranked = cut_lineage(running_totals(firsts.withColumn("_one", F.lit(1)), "first", {"_one": "_rank"},
                                        sum(fresh.values()), groups=["name"]))
    out = {}
    for name in values:
        start = known[name].size if name in known else 0
        codes = ranked.where(F.col("name") == name).select("value", (F.col("_rank") - 1 + start).cast("long").alias("code"))
        if name in known:
            codes = cut_lineage(known[name].codes.select("value", "code").unionByName(codes))
        out[name] = Encoder(codes, start + fresh.get(name, 0))
    return out


def fit_encoder(df: DataFrame, value: str, known: Encoder | None = None,
                order: str = EVENT_KEY) -> Encoder:
    """Codes of one column."""
    return fit_encoders(df, {"value": value}, {"value": known} if known else None, order)["value"]


def encode(df: DataFrame, value: str, encoder: Encoder, name: str) -> DataFrame:
    table = encoder.codes.select(F.col("value").alias(value), F.col("code").alias(name))
    return lookup_join(df, table, [value], encoder.size)
