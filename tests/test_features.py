import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from procwarden import fixed_values as V
from procwarden.fixed_values import MODEL_COLUMNS, SUSPICIOUS_FLAGS, WHITESPACE_PATTERN
from procwarden.functions import text as TX
from procwarden.functions.text import (
    argument_count, argument_counts, basename, col, contains_any, entropies, flagged_share, half_even, quoted, shannon_entropy,
)
from procwarden.operators import baseline as BL
from procwarden.operators import encoders as EN
from procwarden.operators import features as FE
from procwarden.operators.clean import fill_text, prepare
from procwarden.plans.detection import event_facts

CERTUTIL = {
    "Image": "C:\\Windows\\System32\\certutil.exe",
    "CommandLine": "certutil.exe -urlcache -split https://files.example/tool.bin tool.bin",
    "ParentImage": "C:\\Windows\\System32\\cmd.exe",
}


@pytest.mark.parametrize("text, bits", [
    ("", 0.0), ("aaaa", 0.0), ("ab", 1.0), ("abcdefghijklmnop", 4.0), ("aab", 0.9183), ("é😀é😀", 1.0),
    ("a.*+$[", 2.585), ("a\\'\n", 2.0)])
def test_entropy(spark, text, bits):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(shannon_entropy("t")).first()[0] == bits


@pytest.mark.parametrize("path, name", [
    (None, "unknown"), ("", "unknown"), ("C:\\A\\B.EXE", "b.exe"), ("C:/a/b.exe", "b.exe"),
    ("C:\\Tools\\", ""), ("plain.exe", "plain.exe")])
def test_basename(spark, path, name):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(col(basename("p"))).first()[0] == name


def test_half_even(spark):
    row = spark.range(1).select(half_even(F.lit(0.25), 1), half_even(F.lit(2.5), 0), half_even(F.lit(0.35), 1)).first()
    assert list(row)[:2] == [0.2, 2.0]


def test_flags(make_events):
    row = FE.extract_features(make_events([CERTUTIL])).first()
    assert (row["is_known_lolbin"], row["contains_url"], row["has_suspicious_flag"]) == (1, 1, 1)
    assert (row["has_download_indicator"], row["is_scripting_engine"], row["parent_is_script_engine"]) == (1, 0, 1)
    assert row["argument_count"] == 5 and row["suspicious_argument_ratio"] == 0.2
    assert row["parent_child_pair_rarity"] == 0.0 and row["command_length_zscore"] == row["command_line_length"]


def test_model_columns(make_events):
    df = FE.extract_features(make_events([CERTUTIL]))
    assert len(MODEL_COLUMNS) == 24
    assert all(df.schema[c].dataType.simpleString() in ("int", "double") for c in MODEL_COLUMNS)
    assert not [c for c in df.columns if c.startswith("_")]


def test_null_and_bad_values(make_events):
    df = FE.extract_features(make_events([{
        "CommandLine": None, "ParentImage": None, "UtcTime": "bad-time", "IntegrityLevel": "medium", "User": None}]))
    row = df.first()
    assert row["command_line_entropy"] == 0.0 and row["argument_count"] == 0
    assert (row["hour_of_day"], row["minute_of_hour"], row["is_weekend"], row["is_off_hours"]) == (12, 0, 0, 0)
    assert row["integrity_encoded"] == 1 and row["process_ancestry_depth"] == 3


def test_unicode_space_ends_a_token(make_events):
    df = FE.row_features(prepare(make_events([{"CommandLine": "a\u00a0b\u2003c\td  e "}])), ["argument_count"])
    assert df.first()["argument_count"] == 5


def test_baseline(make_events):
    lines = ["a" * 10] * 3 + ["ab" * 10]
    b = BL.fit_baseline(make_events([{"CommandLine": x} for x in lines]))
    assert b.events == 4 and b.length_mean == 12.5 and b.length_std == 5.0
    assert b.entropy_mean == 0.25 and b.entropy_std == 0.5 and b.n_pairs == 1
    assert b.pairs.first()["rarity"] == 0.0 and b.unseen_rarity == 1.0


def test_baseline_of_one_row_uses_floors(make_events):
    b = BL.fit_baseline(make_events([{}]))
    assert (b.length_std, b.entropy_std) == (1.0, 0.1)


def test_empty_baseline(make_events):
    b = BL.fit_baseline(make_events([{}]).limit(0))
    assert b.pairs is None and b.length_std == 1.0


def test_unseen_pair(make_events):
    b = BL.fit_baseline(make_events([{}] * 9 + [CERTUTIL]))
    other = {"Image": "C:\\x\\new.exe"}
    got = [r[0] for r in FE.pair_rarity(prepare(make_events([{}, CERTUTIL, other])), b)
           .orderBy("event_id").select("parent_child_pair_rarity").collect()]
    assert got == [0.0458, 1.0, 2.0]


def test_codes_follow_first_appearance(spark, monkeypatch):
    from procwarden.operators import ordered
    monkeypatch.setattr(ordered, "RANGE_ROWS", 3)
    rows = [(i, f"u{(i * 7) % 10}") for i in range(40)]
    df = spark.createDataFrame(rows, "event_id long, user string").repartition(5)
    got = {r["user"]: r["code"] for r in EN.encode(df, "user", EN.fit_encoder(df, "user"), "code").collect()}
    assert got == {f"u{(i * 7) % 10}": i for i in range(10)}


def test_known_codes_stay(spark):
    old = spark.createDataFrame([(0, "b"), (1, "a")], "event_id long, v string")
    new = spark.createDataFrame([(0, "z"), (1, "a"), (2, "c")], "event_id long, v string")
    grown = EN.fit_encoder(new, "v", known=EN.fit_encoder(old, "v"))
    assert {r["value"]: r["code"] for r in grown.codes.collect()} == {"b": 0, "a": 1, "z": 2, "c": 3}


def test_fill_text_only_present_columns(spark):
    df = fill_text(spark.createDataFrame([(None, 1)], "Image string, n int"))
    assert df.columns == ["Image", "n"] and df.first()["Image"] == ""


ODD_LINES = ["", " ", "a", " -enc  -nop\t", "-enc-nop x", "a　-w hidden\x85b ", "é -decode 😀", "x\x1cy\x1fz", None, "\n-noprofile"]


def test_arguments_are_counted_as_split(spark):
    """In runs of one Arrow batch, against the pattern that splits one line after another."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(ODD_LINES * 3)], "i int, t string").coalesce(1)
    split = f"filter(split(coalesce(t, ''), {quoted(WHITESPACE_PATTERN)}), a -> a != '')"
    flagged = " OR ".join(f"contains(a, {quoted(f)})" for f in SUSPICIOUS_FLAGS)
    rows = df.select("t", argument_count("t").alias("n"), flagged_share("t").alias("share"), col(f"size({split})").alias("want"),
                     col(f"size(filter({split}, a -> {flagged}))").alias("hits")).collect()
    assert len(rows) == 3 * len(ODD_LINES)
    for r in rows:
        assert r["n"] == r["want"], r
        assert r["share"] == (round(r["hits"] / r["want"], 4) if r["want"] else 0.0), r


def test_no_line_is_split_value_by_value(make_events):
    """Functions of single arguments are interpreted by Spark, row by row; facts hold none."""
    facts = event_facts(make_events([CERTUTIL]), keep=["label"])
    assert "lambdafunction" not in facts._jdf.queryExecution().optimizedPlan().toString().lower()


TEXTS = [
    "", "x -enc", "x -ENC\tQQ", "x -encq", "-enc\n", "curl http://10.0.0.1/a", "HtTpS://é", "httpſ://x", "http:/x", "1.2.3.4", "a1.2.3.4",
    "1.2.3.4é", "日1.2.3.4", "١.٢.٣.٤", "1..2.3.4", "1.2.3.4444 5.6.7.8", "a.b.c.d", "A" * 39, "é" + "A/+9" * 10 + "==", "A" * 39 + " A",
    "IEX(new)", "WGET DownloadFile", "-split -f", "　-nop　", "a b c d​e", "İ -Nop K", "日本 -hidden\u0085x",
]


def test_text_flags_are_those_of_plain_search(make_events):
    asked = ["contains_url", "contains_ip_address", "has_base64_pattern", "has_suspicious_flag", "has_encoded_command",
             "has_download_indicator"]
    df = prepare(make_events([{"CommandLine": t} for t in TEXTS]))
    flags = [V.SUSPICIOUS_FLAGS, ["-enc ", "-enc\t", "-encodedcommand"], V.DOWNLOAD_INDICATORS]
    plain = [f"rlike(CommandLine, {quoted(p)})" for p in (V.URL_PATTERN, V.IP_PATTERN, V.BASE64_PATTERN)]
    plain += [contains_any("_cmd", f) for f in flags]
    plain[4] += " OR endswith(_cmd, '-enc')"
    rows = FE.row_features(df, asked).select("CommandLine", F.array(*asked).alias("got"), F.array(*[
        F.expr(f"cast({p} AS int)") for p in plain]).alias("wanted")).collect()
    assert [(r["CommandLine"], r["got"]) for r in rows] == [(r["CommandLine"], r["wanted"]) for r in rows]
    assert all(sum(r["got"][i] for r in rows) for i in range(len(asked)))


def test_arguments_and_entropy_of_wide_texts():
    texts = [*TEXTS, None, "a" * 3 + "\U0010ffff", ""]
    wanted = [len((t or "").split()) for t in texts]
    assert argument_counts(pa.array(texts)).tolist() == wanted
    assert argument_counts(pa.array(["cut", *texts])[1:]).tolist() == wanted
    bits = [-sum(n / len(t) * math.log2(n / len(t)) for n in Counter(t).values()) if t else 0.0 for t in texts]
    assert entropies(pa.array(texts)).tolist() == pytest.approx(bits, abs=6e-5)


def test_facts_read_a_command_line_few_times(make_events):
    """A text is lowered once, and no pattern that goes back over it at every place is searched by the JVM."""
    plan = event_facts(make_events([CERTUTIL]), keep=["label"])._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"lower\(CommandLine", plan)) == 1
    assert "{40,}" not in plan


def test_entropy_decodes_wide_characters_only(monkeypatch):
    """Bytes are counted as they are; only those beyond ASCII are decoded, in long texts and short ones."""
    texts = ["", None, "a", "é", "aé日😀" * 300, "x" * 5000, "ab é\u3000-" * 90 + "😀", "plain", "日本" * 2, "é" + "b" * 900]
    want = []
    for t in texts:
        counts = Counter(t or "")
        want.append(round(-sum(n / len(t) * math.log2(n / len(t)) for n in counts.values()), 4) + 0.0 if t else 0.0)
    for size in (0, TX.LONG_BYTES, 10**9):
        monkeypatch.setattr(TX, "LONG_BYTES", size)
        assert TX.entropies(pa.array(texts)).tolist() == want
    raw, ends = np.frombuffer("aéb日".encode(), np.uint8), np.array([0, 3, 7])
    text, number = TX.wide_counts(raw, ends)
    assert text.tolist() == [0, 1] and number.tolist() == [1, 1]
