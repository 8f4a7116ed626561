import os

from conftest import SMALL
from procwarden.operators.clean import benign_only
from procwarden.plans.detection import detect, fit
from procwarden.schema import KEYED_EVENT_SCHEMA
from procwarden.session import working_folder
from procwarden.sources.tables import process_events
from procwarden.streaming.detect_stream import write_detections


def test_stream_gives_the_batch_result(spark, tmp_path):
    events = process_events(spark, SMALL)
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    fitted = fit(benign_only(events), ("boundary", "lof"), steps=0, digits=6)
    stream = spark.readStream.schema(KEYED_EVENT_SCHEMA).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    folder = working_folder(spark)
    before = set(os.listdir(folder))
    query = write_detections(stream, fitted, str(tmp_path / "out"), str(tmp_path / "cp"), once=True)
    query.awaitTermination()
    assert set(os.listdir(folder)) == before  # no step table stays behind a batch
    columns = ["event_id", "final_verdict", "priority", "confidence", "explanation"]
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.select("batch").distinct().count() == 2
    want = detect(events, fitted)
    assert sorted(got.select(columns).collect()) == sorted(want.select(columns).collect())
