import json
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from procwarden.operators.baseline import Baseline
from procwarden.operators.clean import benign_only
from procwarden.operators.encoders import Encoder
from procwarden.plans.detection import detect, fit
from procwarden.schema import EVENT_SCHEMA, KEYED_EVENT_SCHEMA
from procwarden.sources import event_files as IO
from procwarden.operators.baseline import fit_baseline
from procwarden.sources import model_store as MS

HARD = 'cmd.exe /c "echo ""a"", b"\n second line, \\ end '


def test_csv_keeps_quotes_and_line_breaks(spark, make_events, tmp_path):
    df = make_events([{"CommandLine": HARD}, {"CommandLine": None, "User": ""}])
    IO.write_csv(df, str(tmp_path / "c"))
    got = IO.read_events_csv(spark, str(tmp_path / "c"), KEYED_EVENT_SCHEMA).orderBy("event_id").collect()
    assert got[0]["CommandLine"] == HARD and got[1]["CommandLine"] is None and got[1]["User"] is None


def test_plain_csv_file(spark, tmp_path):
    head = ",".join(EVENT_SCHEMA.names)
    (tmp_path / "e.csv").write_text(
        head + '\n2024-07-02T12:45:28.780Z,{A},34154,C:\\x\\rundll32.exe,"rundll32.exe shell32.dll,Run ""x""",'
        "C:\\p.exe,p,33662,CORP\\a,Medium,0,,,gray_area\n")
    row = IO.read_events_csv(spark, str(tmp_path / "e.csv")).first()
    assert row["CommandLine"] == 'rundll32.exe shell32.dll,Run "x"' and row["ProcessId"] == 34154
    assert row["mitre_technique_id"] is None and row["label"] == "gray_area"


def test_json_array_and_lines(spark, make_events, tmp_path):
    event = {"UtcTime": "t", "CommandLine": HARD, "is_malicious": 1, "label": "malicious"}
    (tmp_path / "a.json").write_text(json.dumps([event, event], indent=2))
    got = IO.read_events_json(spark, str(tmp_path / "a.json"), array=True)
    assert got.count() == 2 and got.first()["CommandLine"] == HARD
    IO.write_json(make_events([event]), str(tmp_path / "l"))
    assert IO.read_events_json(spark, str(tmp_path / "l")).first()["CommandLine"] == HARD


def test_label_folders(spark, make_events, tmp_path):
    df = make_events([{"label": x} for x in ("benign", "benign", "malicious")])
    IO.write_by_label(df, str(tmp_path / "p"))
    assert IO.read_label(spark, str(tmp_path / "p"), "benign").count() == 2
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3


def test_baseline_survives_saving(spark, make_events, tmp_path):
    b = fit_baseline(make_events([{}, {"CommandLine": "x y z"}]))
    MS.save_baseline(spark, b, str(tmp_path / "b"))
    again = MS.load_baseline(spark, str(tmp_path / "b"))
    assert (again.length_mean, again.length_std, again.entropy_mean, again.unseen_rarity, again.n_pairs) == (
        b.length_mean, b.length_std, b.entropy_mean, b.unseen_rarity, b.n_pairs)
    assert again.pairs.collect() == b.pairs.collect()


def whole(spark, n):
    """A baseline and an encoder that both tell their number."""
    pairs = spark.range(n).select(F.col("id").cast("string").alias("parent"), F.lit("c").alias("child"), F.lit(n).alias("n"),
                                  F.lit(0.5).alias("freq"), F.lit(1.0).alias("rarity"))
    codes = spark.range(n).select(F.col("id").cast("string").alias("value"), F.col("id").alias("code"))
    return Baseline(events=n, unseen_rarity=float(n), pairs=pairs, n_pairs=n), {"user": Encoder(codes, n)}


def test_reader_beside_a_writer(spark, tmp_path):
    """While versions are written, a reader sees the parts of one version."""
    path = str(tmp_path / "b")
    b, e = whole(spark, 1)
    MS.save_baseline(spark, b, path, e)
    done = threading.Event()

    def write():
        for n in range(2, 8):
            b, e = whole(spark, n)
            MS.save_baseline(spark, b, path, e)
        done.set()

    writer, seen = threading.Thread(target=write), set()
    writer.start()
    while True:
        last = done.is_set()
        folder = MS.current(spark, path)
        b, e = MS._read_baseline(spark, folder), MS._read_encoder(spark, folder, "user")
        assert b.events == b.n_pairs == b.pairs.count() == e.size == int(b.unseen_rarity)
        seen.add(b.events)
        if last:
            break
    writer.join()
    assert len(seen) > 1 and max(seen) == 7
    assert len(MS.versions(spark, path)) == 7
    MS.remove_old(spark, path)
    assert len(MS.versions(spark, path)) == 2 and MS.load_baseline(spark, path).events == 7


def test_unfinished_version_is_not_read(spark, tmp_path):
    path = str(tmp_path / "b")
    with pytest.raises(FileNotFoundError):
        MS.load_baseline(spark, path)
    b, e = whole(spark, 3)
    MS.save_baseline(spark, b, path, e)

    def fails(folder):
        MS._write(e["user"].codes, f"{folder}/encoder_user")
        raise OSError("the writer ended")

    with pytest.raises(OSError):
        MS.publish(spark, path, fails)
    assert MS.load_baseline(spark, path).events == 3


def test_stored_artefacts_are_used(spark, make_events, tmp_path):
    """The second run detects with what the first one fitted, also on other events."""
    rows = [{"CommandLine": f"notepad.exe file{i}.txt", "User": f"CORP\\u{i % 4}"} for i in range(40)]
    events, other = make_events(rows), make_events([{"CommandLine": "cmd.exe /c " + "x" * 300, "User": "CORP\\new"}] * 3)
    path, options = str(tmp_path / "a"), {"parts": ("boundary",), "steps": 0}
    MS.run_with_store(events, path, **options)
    assert len(MS.versions(spark, path)) == 1
    got = MS.run_with_store(other, path, **options)
    want = detect(other, fit(benign_only(events), **options))
    columns = ["event_id", "ml_anomaly_score", "final_verdict", "command_length_zscore"]
    assert sorted(got.select(columns).collect()) == sorted(want.select(columns).collect())
    assert [r["user_encoded"] for r in got.collect()] == [None] * 3
    assert len(MS.versions(spark, path)) == 1
    with pytest.raises(ValueError, match="were fitted with"):
        MS.run_with_store(events, path, parts=("boundary",), steps=1)


@pytest.mark.parametrize("split", ["128m", "700", "60"])
def test_large_csv_file_is_read_by_many_tasks(spark, tmp_path, split):
    """Line breaks and quotes in fields, records over several splits; the rows are those of a whole-file read."""
    texts = [HARD, "plain", 'a ""b"" , c', "one\ntwo\n\nthree", '"', 'say "x\ny" z', "", "tail\n" + "word " * 40 + "\nend",
             ", ,", "é\n日本"]
    quoted = ['"' + texts[i % 10].replace('"', '""') + '"' for i in range(120)]
    for k in range(2):
        (tmp_path / f"f{k}.csv").write_text("event_id,CommandLine,User\n" + "".join(
            f"{k * 1000 + i},{q},{'u' if i % 3 else ''}\n" for i, q in enumerate(quoted)), newline="\n")
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("CommandLine", T.StringType()),
                           T.StructField("User", T.StringType())])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = IO.read_events_csv(spark, str(tmp_path), schema)
        parts = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
        rows = sorted(got.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert (parts > 10) == (split != "128m")
    want = spark.read.schema(schema).options(**IO.CSV_OPTIONS).option("multiLine", True).option("lineSep", "\n").csv(str(tmp_path))
    assert rows == sorted(want.collect()) and len(rows) == 240
    assert [r["CommandLine"] for r in rows[:10]] == [t or None for t in texts]
