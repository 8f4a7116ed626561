import pytest
from pyspark.sql import functions as F

from procwarden.operators import chains as C
from procwarden.operators import evaluation as E
from procwarden.operators import reporting as RP
from procwarden.operators.clean import prepare
from procwarden.operators.fusion import fuse
from procwarden.plans.detection import event_facts


def chain(make_events, **event):
    return C.analyse_chains(make_events([event])).first()


def test_listed_pair(make_events):
    row = chain(make_events, Image="C:\\Windows\\System32\\cmd.exe", CommandLine="cmd.exe /q powershell -enc UwB0AG8AcAA=",
                ParentImage="D:\\Office\\WINWORD.EXE",
                UtcTime="2024-03-05T04:10:00.000Z")
    assert row["chain_risk_score"] == 100 and row["chain_matched_pattern"] is True
    assert row["chain_description"] == (
        "winword.exe → cmd.exe: Office Word spawning command shell (macro indicator) "
        "[Modifiers: +20 Office→Script chain, +10 off-hours, +10 encoded command]")


def test_unlisted_pair(make_events):
    row = chain(make_events, Image="C:\\G\\chrome.exe", CommandLine="chrome.exe --no-first-run")
    assert row["chain_risk_score"] == 0 and not row["chain_matched_pattern"]
    assert row["chain_description"] == "explorer.exe → chrome.exe: No known suspicious pattern"


def test_unreadable_time_adds_nothing(make_events):
    assert chain(make_events, UtcTime="bad-time")["chain_risk_score"] == 0


def test_null_paths(make_events):
    assert chain(make_events, Image=None, ParentImage=None)["chain_description"].startswith("unknown → unknown")


@pytest.mark.parametrize("sigma, ml, risk, want", [
    (True, 0.0, 0, ("ALERT", "CRITICAL", 90.0)), (True, 100.0, 100, ("ALERT", "CRITICAL", 100.0)),
    (False, 70.0, 60, ("CLEAR", "NONE", 23.3)), (False, 70.0, 61, ("REVIEW", "LOW", 30.5)),
    (False, 70.1, 60, ("ALERT", "MEDIUM", 50.1)), (False, 100.0, 100, ("ALERT", "HIGH", 89.0)),
    (False, 100.0, 0, ("ALERT", "MEDIUM", 70.0)), (False, 0.0, 100, ("REVIEW", "LOW", 49.0)),
    (False, 0.0, 0, ("CLEAR", "NONE", 0.0))])
def test_ladder(spark, sigma, ml, risk, want):
    df = spark.createDataFrame([(sigma, ml, risk, "rule", "chain text")],
                               "sigma_match boolean, ml_anomaly_score double, chain_risk_score int, "
                               "sigma_rule_name string, chain_description string")
    row = fuse(df).first()
    assert (row["final_verdict"], row["priority"], row["confidence"]) == want
    text = {"CRITICAL": f"Sigma rule matched: rule | ML Score: {ml:.0f} | Chain Risk: {risk}",
            "HIGH": "Chain + ML anomaly detected | ML Score: 100 | Chain: chain text",
            "MEDIUM": f"ML anomaly score: {ml:.0f}", "LOW": "Suspicious chain detected | Chain: chain text",
            "NONE": ""}[row["priority"]]
    assert row["explanation"] == text


@pytest.fixture(scope="module")
def graded(spark):
    rows = [(i, int(i % 3 == 0), i % 2 == 0, float((i * 37) % 101), (i * 13) % 100,
             ["ALERT", "REVIEW", "CLEAR"][i % 3 if i % 5 else 2]) for i in range(60)]
    return spark.createDataFrame(rows, "event_id long, is_malicious int, sigma_match boolean, "
                                       "ml_anomaly_score double, chain_risk_score int, final_verdict string"), rows


def test_confusion_and_rates(graded):
    df, rows = graded
    hits = {"sigma": lambda r: r[2], "ml": lambda r: r[3] > 70, "chain": lambda r: r[4] > 60,
            "combined": lambda r: r[5] != "CLEAR"}
    for m in E.evaluate_layers(df).collect():
        hit = hits[m["layer"]]
        tp = sum(r[1] == 1 and hit(r) for r in rows)
        fp = sum(r[1] == 0 and hit(r) for r in rows)
        fn = sum(r[1] == 1 and not hit(r) for r in rows)
        tn = sum(r[1] == 0 and not hit(r) for r in rows)
        assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (tp, fp, fn, tn)
        p, r = tp / max(tp + fp, 1), tp / max(tp + fn, 1)
        assert m["precision"] == pytest.approx(p, abs=1e-4) and m["recall"] == pytest.approx(r, abs=1e-4)
        assert m["f1"] == pytest.approx(2 * p * r / max(p + r, 0.001), abs=1e-4)


def test_roc(graded, monkeypatch):
    from procwarden.operators import ordered
    monkeypatch.setattr(ordered, "RANGE_ROWS", 7)
    df, rows = graded
    points = E.roc_points(df)
    pos = [r[3] for r in rows if r[1] == 1]
    neg = [r[3] for r in rows if r[1] == 0]
    area = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
    assert E.area_under_curve(points).first()["auc"] == pytest.approx(area)
    for r in points.collect():
        assert r["tp"] == sum(p >= r["score"] for p in pos) and r["fp"] == sum(n >= r["score"] for n in neg)
    nearest = min({r[3] for r in rows}, key=lambda s: (abs(s - 70), -s))
    assert E.operating_point(points).first()["score"] == nearest


def test_empty_table_is_safe(graded):
    empty = graded[0].limit(0)
    assert RP.verdict_shares(empty).count() == 0
    assert RP.detection_vs_truth(empty).first()["caught_pct"] == 0.0
    assert [r["f1"] for r in E.evaluate_layers(empty).collect()] == [0.0] * 4


def test_histogram_ends(graded):
    got = RP.score_histogram(graded[0].withColumn("label", F.lit("x"))).agg(F.max("bin"), F.sum("events")).first()
    assert got[0] == 39 and got[1] == 60


def test_facts_tell_chains_without_reading_texts_again(make_events):
    """p07_analyst_filter and all queries of ``detected``: a chain's tests come from the pass that makes the features."""
    lines = ["x", "a HTTP://b", "x https:/", "-ENC abc", "x -enc", "-enc\tx", "-EncodedCommand", "-Nop", "-w hidden http://a -enc b", None]
    times = ["2024-07-01T03:00:00.000Z", "2024-07-01T12:00:00.000Z", "bad-time", None]
    paths = ["C:\\a\\WINWORD.EXE", "C:/b/certutil.exe", "C:\\c/powershell.exe", None]
    events = make_events([{"CommandLine": c, "UtcTime": t, "Image": i, "ParentImage": paths[0]} for c in lines for t in times for i in paths])
    facts = event_facts(events, keep=["label"])
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    assert "https?://" not in plan and "_encoded" not in facts.columns and plan.count("ArrowEvalPython") == 1
    apart = {r["event_id"]: r["_chain"] for r in C.chain_codes(prepare(events)).collect()}
    assert {r["event_id"]: r["_chain"] for r in facts.collect()} == apart and len(set(apart.values())) > 10
