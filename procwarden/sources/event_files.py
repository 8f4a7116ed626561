"""Event tables as files: CSV, JSON and parquet."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from procwarden.schema import EVENT_SCHEMA

# Quotes are doubled, blanks are kept.
CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"',
               "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def read_events_csv(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA,
                    multi_line: bool = True) -> DataFrame:
    """Events with a header line in every file; empty fields are null.

    Command lines may hold line breaks, so quoted fields may span lines; a large file is
    still read by many tasks.  ``multi_line=False`` saves the pass over the quotes when
    no field holds a line break.
    """
    if multi_line:
        return read_split_csv(spark, path, schema)
    return spark.read.schema(schema).options(**CSV_OPTIONS).option("lineSep", "\n").csv(path)


def read_split_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV files whose fields may hold line breaks, parsed split by split.

    A first pass counts the quotes of every split: a split begins inside a quoted field
    when the splits before it hold an odd number.  With that each task puts the lines of
    its split together to records by itself.  Only pieces of records that lie across
    the borders of splits move, two a split at most.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value",
        F.pmod(F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit(""))), F.lit(2)).alias("odd"))
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    splits = lines.groupBy("file", "start").agg(F.sum("odd").alias("odd"))
    inside = splits.withColumn("before", F.sum("odd").over(before)).where("before % 2 = 1")
    quoted = {(r["file"], r["start"]) for r in inside.select("file", "start").collect()}  # few splits begin inside a field

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, held, open_quotes, kind = None, [], 0, "whole"

        def done(at) -> list[tuple]:
            return [(*at, kind, "\n".join(held))] if held else []

        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("file", "start", "value", "odd"))
            for file, start, value, odd in zip(*columns, strict=True):
                if split != (file, start):
                    # the last record of a split may go on in the next one
                    out += [(*r[:2], "begin" if r[2] == "whole" else r[2], r[3]) for r in done(split)]
                    split, held = (file, start), []
                    open_quotes = int(split in quoted)
                    kind = "rest" if open_quotes else "head" if start == 0 else "whole"
                elif not open_quotes:
                    out += done(split)
                    held, kind = [], "whole"
                held.append(value)
                open_quotes ^= odd
            yield _records(out)
        if held:
            yield _records([(*r[:2], "begin" if r[2] == "whole" else r[2], r[3]) for r in done(split)])

    found = lines.mapInArrow(records, "file string, start long, kind string, record string")
    pieces = found.where("kind != 'whole'")
    place = F.array_position(F.array(*map(F.lit, ["rest", "head", "begin"])), F.col("kind"))  # in a split
    ordered = W.partitionBy("file").orderBy("start", place).rowsBetween(W.unboundedPreceding, 0)
    numbered = pieces.withColumn("number", F.count_if(F.col("kind") != "rest").over(ordered))
    joined = (numbered.groupBy("file", "number").agg(
        F.array_sort(F.collect_list(F.struct("start", "record"))).alias("parts"),
        F.max(F.col("kind") == "head").alias("head"))
        .where("NOT head").select(F.array_join("parts.record", "\n").alias("record")))
    every = found.where("kind = 'whole'").select("record").unionByName(joined).where("trim(record) != ''")
    options = {k: str(v) for k, v in CSV_OPTIONS.items() if k != "header"}
    row = F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), options)
    return every.select(row.alias("row")).select("row.*")


def _records(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("file", pa.string()), ("start", pa.int64()), ("kind", pa.string()), ("record", pa.string())]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], [n for n, _ in kinds])


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**CSV_OPTIONS).option("lineSep", "\n").option(
        "emptyValue", "").csv(path)


def read_events_json(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA,
                     array: bool = False) -> DataFrame:
    """JSON lines, or files that hold one array of events each."""
    return spark.read.schema(schema).option("multiLine", array).json(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_by_label(df: DataFrame, path: str) -> None:
    """One write; the full table is the folder, each label a sub-folder."""
    df.write.mode("overwrite").partitionBy("label").parquet(path)


def read_label(spark: SparkSession, path: str, label: str) -> DataFrame:
    """One label; only its sub-folder is read."""
    return spark.read.parquet(path).filter(F.col("label") == label)


def save_table(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """Write a stage or result table as parquet or CSV; ``options`` are those of the format."""
    if fmt == "csv":
        write_csv(df, path)
    else:
        df.write.mode("overwrite").format(fmt).options(**options).save(path)


def save_results(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """The full results, and the alerts read back from them."""
    save_table(df, f"{path}/results", fmt)
    written = df.sparkSession.read.schema(df.schema)
    written = (written.options(**CSV_OPTIONS).option("multiLine", True)
               .option("lineSep", "\n") if fmt == "csv" else written)
    full = written.format(fmt).load(f"{path}/results")
    save_table(full.filter(F.col("final_verdict").isin("ALERT", "REVIEW")), f"{path}/alerts", fmt)
