"""The binding of the given tables to process events."""

import base64

import pytest
from pyspark.sql import functions as F

from check import compare, connect
from conftest import SMALL
from procwarden.plans import catalog
from procwarden.plans.catalog import CHECKS
from procwarden.schema import COMMAND_LINES, KEYED_EVENT_SCHEMA
from procwarden.sources.tables import plain_base64, process_events, read_table


@pytest.mark.parametrize("folder", [SMALL, SMALL.replace("0.001", "0.01")])
def test_every_document_and_page_is_bound(spark, folder):
    """Every text, whole, plain or in base64, and every address stands in a command line."""
    commands = process_events(spark, folder).select("event_id", F.col("CommandLine").alias("command"))
    docs = read_table(spark, folder, "documents").select(F.col("doc_id").alias("event_id"), "text", plain_base64("text").alias("coded"))
    pages = read_table(spark, folder, "pages").select((F.col("page_id") + docs.count()).alias("event_id"), "url")
    for table, found in ((docs.where("text IS NOT NULL"), F.col("command").contains(F.col("text")) | F.col("command").contains(F.col("coded"))),
                         (pages, F.col("command").contains(F.col("url")))):
        n = table.count()
        assert n and table.join(commands, "event_id").where(found).count() == n


def test_later_events_take_documents_in_turn(spark):
    """io9_save_stages: a template that asks for a document gets one in every event, as its SQL says."""
    n_docs = read_table(spark, SMALL, "documents").count()
    n_pages = read_table(spark, SMALL, "pages").count()
    later = F.col("event_id") >= n_docs + n_pages
    texts = read_table(spark, SMALL, "documents").select("doc_id", "text").where("text IS NOT NULL")
    events = read_table(spark, SMALL, "events").select("event_id", "user_id").where(later)
    asked = events.where(((F.col("event_id") * 3 + F.col("user_id")) % 23).isin(8, 9) & (F.col("event_id") % 97 != 0))
    made = process_events(spark, SMALL, every_document=True).select("event_id", "CommandLine")
    held = asked.join(made, "event_id").join(texts, F.col("doc_id") == F.col("event_id") % n_docs)
    found = F.col("CommandLine").contains(F.col("text")) | F.col("CommandLine").contains(plain_base64("text"))
    assert held.where(found).count() == held.count() > 0
    assert "ELSE 'props'" in CHECKS["u1_verdict"] and "ELSE 'props'" not in CHECKS["io9_save_stages"]


def test_base64_has_no_breaks(spark):
    texts = ["", "a", "é😀" * 100, "\r\n" * 90, "x" * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", plain_base64("text").alias("coded"))
    assert [r["coded"] for r in df.collect()] == [base64.b64encode(t.encode()).decode() for t in texts]
    assert "translate(" not in df._jdf.queryExecution().optimizedPlan().toString()  # slow: it looks every character up


def test_stages_hold_command_lines_once(spark, monkeypatch):
    """io9_save_stages: every stage has all events and their columns, and one of them the command lines."""
    written, kept = {}, catalog.IO.save_table

    def save(df, path, *args, **options):
        kept(df, path, *args, **options)
        written[path.rsplit("/", 1)[1]] = spark.read.parquet(path)

    monkeypatch.setattr(catalog.IO, "save_table", save)
    assert compare(spark, connect(SMALL), "io9_save_stages", SMALL) == "ok"
    assert list(written) == ["features", "rules", "scored", "chains"]
    rest = {*KEYED_EVENT_SCHEMA.names} - {*COMMAND_LINES}
    before = rest
    for name, table in written.items():
        assert table.count() == 1000 and before <= {*table.columns} and "_cmd" not in table.columns
        assert not {*COMMAND_LINES} & {*table.columns} or name == "features"
        before = before | {*table.columns} - {*COMMAND_LINES, *catalog.C.TESTS}
    events = process_events(spark, SMALL, every_document=True).select("event_id", F.coalesce("CommandLine", F.lit("")))
    assert written["features"].select("event_id", "CommandLine").exceptAll(events).isEmpty()
