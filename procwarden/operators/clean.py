"""Cleaning, projections and filters of the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procwarden.fixed_values import DETAIL_COLUMNS
from procwarden.functions.text import basename, col, filled
from procwarden.operators.ordered import at_position
from procwarden.schema import EVENT_KEY, TEXT_COLUMNS

HELPERS = ["_child", "_parent", "_cmd"]


def fill_text(events: DataFrame) -> DataFrame:
    """Text columns that are present: null becomes the empty string."""
    present = [c for c in TEXT_COLUMNS if c in events.columns]
    return events.withColumns({c: col(filled(c)) for c in present})


def with_names(events: DataFrame) -> DataFrame:
    """Helper columns: child and parent base name, lower-cased command line."""
    return events.withColumns({
        "_child": col(basename("Image")),
        "_parent": col(basename("ParentImage")),
        "_cmd": F.lower(F.col("CommandLine")),
    })


def prepare(events: DataFrame) -> DataFrame:
    return events.transform(fill_text).transform(with_names)


def drop_helpers(df: DataFrame) -> DataFrame:
    return df.drop(*HELPERS)


def with_display_names(df: DataFrame) -> DataFrame:
    """Base names as written, for reports."""
    return df.withColumns({
        "child_process": col(basename("Image", lower=False)),
        "parent_process": col(basename("ParentImage", lower=False)),
    })


def benign_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("label") == "benign")


def analyst_filter(df: DataFrame, priority: str = "All", verdict: str = "All",
                   label: str = "All", ml_range: tuple[float, float] = (0.0, 100.0)) -> DataFrame:
    """Optional equality filters and a closed score range."""
    for column, wanted in [("priority", priority), ("final_verdict", verdict), ("label", label)]:
        if wanted != "All":
            df = df.filter(F.col(column) == wanted)
    return df.filter(F.col("ml_anomaly_score").between(*map(float, ml_range)))


def command_preview(df: DataFrame, width: int = 200) -> DataFrame:
    return df.withColumn("command_preview", F.substring(col(filled("CommandLine")), 1, width))


def event_detail(df: DataFrame, position: int, order: str = EVENT_KEY) -> DataFrame:
    """The event at a position of an ordered set, one row per shown feature."""
    one = at_position(df, order, position)
    shown = [c for c in DETAIL_COLUMNS if c in df.columns]
    ids = [c for c in (order, "final_verdict", "priority") if c in df.columns]
    wide = one.select(*ids, *[F.col(c).cast("double").alias(c) for c in shown])
    return wide.unpivot(ids, shown, "feature", "value")
