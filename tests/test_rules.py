import textwrap

import pytest
from pyspark.sql import functions as F

from procwarden.operators import rules as R
from procwarden.sources.rule_files import load_rules

CERTUTIL = {
    "Image": "C:\\Windows\\System32\\certutil.exe",
    "CommandLine": "certutil /urlcache https://files.example/tool.bin tool.bin",
    "ParentImage": "C:\\Windows\\System32\\svchost.exe"}
CHROME = {"Image": "D:\\Apps\\Browser\\chrome.exe",
          "CommandLine": "chrome.exe about:blank", "ParentImage": "C:\\Windows\\System32\\userinit.exe"}


def outcome(df, blocks, condition="selection", **kw):
    rule = R.parse_rule({"title": "t", "detection": [*blocks, ("condition", condition)]})
    return [r[0] for r in df.orderBy("event_id").select(R.match_rule(df, rule, **kw)).collect()]


def test_hit_and_miss(make_events):
    got = R.apply_rules(make_events([CERTUTIL, CHROME])).orderBy("event_id").collect()
    assert got[0]["sigma_match"] and got[0]["sigma_rule_name"] == "Certutil URL Cache Download"
    assert got[0]["sigma_mitre_tags"] == "attack.t1105" and got[0]["sigma_level"] == "high"
    assert (got[1]["sigma_match"], got[1]["sigma_rule_name"], got[1]["sigma_level"],
            got[1]["sigma_mitre_tags"]) == (False, "None", "none", "")


def test_most_severe_match_wins(make_events):
    both = {"Image": "C:\\Windows\\System32\\mshta.exe", "CommandLine": "mshta.exe http://x",
            "ParentImage": "C:\\Office\\WINWORD.EXE"}
    df = make_events([both])
    assert R.apply_rules(df).first()["sigma_level"] == "critical"
    found = R.all_matches(df, R.default_rules()).select(F.inline("rule_matches")).collect()
    assert [r["level"] for r in found] == ["high", "critical"]


def test_equal_severity_keeps_file_order(make_events):
    docs = [{"title": t, "level": "low", "detection": [("selection", [("Image|contains", "exe")])]} for t in "ba"]
    assert R.apply_rules(make_events([{}]), [R.parse_rule(d) for d in docs]).first()["sigma_rule_name"] == "b"


def test_filter_excludes(make_events):
    df = make_events([{**CERTUTIL, "CommandLine": "certutil -urlcache -verify x"}])
    assert not R.apply_rules(df).first()["sigma_match"]


def test_any_filter_block_excludes(make_events):
    blocks = [("selection", [("Image|contains", "exe")]), ("filter_b", [("User|contains", "user1")])]
    df = make_events([{}, {"User": "other"}])
    assert outcome(df, blocks, "selection and not filter_a") == [False, True]


@pytest.mark.parametrize("key, value, want", [
    ("CommandLine|contains", "PAD.e", True), ("CommandLine|startswith", "Note", True),
    ("CommandLine|endswith", ".EXE", True), ("CommandLine|re", "^NOTE.*\\.exe$", True),
    ("CommandLine|re", "(", False), ("CommandLine", "notepad.EXE", True), ("CommandLine", "notepad", False),
    ("CommandLine|odd", "tepad", True), ("Missing|contains", "x", False), ("is_malicious", "0", False),
    ("ProcessId", 1000, True), ("ProcessId", 100, False), ("Image|contains|all", ["zzz", "note"], True)])
def test_modifiers(make_events, key, value, want):
    assert outcome(make_events([{}]), [("selection", [(key, value)])]) == [want]


def test_null_never_matches(make_events):
    df = make_events([{"CommandLine": None}, {"CommandLine": ""}])
    assert outcome(df, [("selection", [("CommandLine|contains", "")])]) == [False, False]


def test_condition_fallbacks(make_events):
    df = make_events([{}])
    yes, no = [("Image|contains", "notepad")], [("Image|contains", "zzz")]
    assert outcome(df, [("selection", yes), ("b", no)], "missing") == [True]
    assert outcome(df, [("a", yes), ("b", no)], "missing") == [True]
    assert outcome(df, [("a", no), ("b", yes)], "a or b") == [True]
    assert outcome(df, [("a", yes)], "b or c") == [False]
    assert outcome(df, [], "selection") == [False]


def test_block_must_be_a_mapping():
    with pytest.raises(ValueError):
        R.parse_rule({"title": "t", "detection": {"selection": "text", "condition": "selection"}})


def test_rows_like_the_gray_area(make_events):
    """Ten update downloads and eight profile-less shells: 18 hits, 10 when all keys count."""
    bits = {"Image": "C:\\Windows\\System32\\bitsadmin.exe",
            "CommandLine": "bitsadmin.exe /transfer u /download http://wsus.local/a.cab C:\\a.cab"}
    shell = {"Image": "C:\\Windows\\System32\\WindowsPowerShell\\v1.0\\powershell.exe",
             "CommandLine": "powershell.exe -NoProfile -File C:\\Scripts\\Backup.ps1"}
    df = make_events([bits] * 10 + [shell] * 8 + [CHROME] * 82)

    def counts(**kw):
        return {r["sigma_rule_name"]: r["n_events"] for r in R.events_per_rule(R.apply_rules(df, **kw)).collect()}

    assert counts() == {"BITSAdmin File Download": 10, "PowerShell Encoded Command Execution": 8}
    assert counts(duplicate_keys="and") == {"BITSAdmin File Download": 10}


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_rule_folder(spark, tmp_path, make_events, scheme):
    pytest.importorskip("yaml")
    (tmp_path / "b.yml").write_text(textwrap.dedent("""
        title: Two keys
        level: low
        date: 2024-05-01
        tags: [attack.t1, attack.other]
        detection:
          selection:
            CommandLine|contains: ['zzz']
            CommandLine|contains: ['note']
          condition: selection
        """))
    (tmp_path / "a.yaml").write_text("title: none\n")
    (tmp_path / "c.yml").write_text("detection: [unclosed")
    (tmp_path / "e.yml").write_bytes(b"title: \xff\n")
    (tmp_path / "f.yml").write_text("- just\n- a list\n")
    (tmp_path / "g.yml").write_text("detection: {selection: text, condition: selection}\n")
    (tmp_path / "h.yml").write_text("")
    (tmp_path / "d.txt").write_text("title: x")
    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "z.yml").write_text("title: below\ndetection: {selection: {Image: x}}\n")
    found = load_rules(spark, f"{scheme}{tmp_path}")
    assert [r.title for r in found.rules] == ["Two keys"] and found.rules[0].techniques == ["attack.t1"]
    reasons = {r["file"]: r["reason"] for r in found.rejects.collect()}
    assert set(reasons) == {"a.yaml", "c.yml", "e.yml", "f.yml", "g.yml", "h.yml"}
    assert reasons["a.yaml"] == "has no detection" and reasons["f.yml"] == "is no mapping" and reasons["h.yml"] == "is empty"
    assert reasons["c.yml"].startswith("cannot be read") and "selection" in reasons["g.yml"]
    df = make_events([{}])
    assert df.select(R.match_rule(df, found.rules[0])).first()[0] is True
    assert df.select(R.match_rule(df, found.rules[0], "and")).first()[0] is False


def test_missing_and_empty_folders(spark, tmp_path):
    found = load_rules(spark, str(tmp_path / "missing"))
    assert found.rules == [] and [r["reason"] for r in found.rejects.collect()] == ["no such folder"]
    found = load_rules(spark, str(tmp_path))
    assert found.rules == [] and found.rejects.count() == 0


def test_ten_rules():
    assert len(R.default_rules()) == 10


def test_every_rule_is_tested_once(make_events):
    """One lower() per field in the plans, also where only matches are wanted."""
    df = make_events([CERTUTIL, CHROME])
    for found in (R.apply_rules(df), R.matched_events(df), R.events_per_rule(R.apply_rules(df))):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert 1 <= plan.count("lower(") <= 3
    assert [r["event_id"] for r in R.matched_events(df).collect()] == [0]
    assert R.matched_events(df).columns[:15] == df.columns and "_best" not in R.matched_events(df).columns
    assert R.matched_events(df, []).count() == 0


def test_a_thousand_rules(spark, make_events):
    """Large sets compile; the best match is the one that a loop over the rules finds."""
    levels = ["low", "high", "medium", "critical"]
    docs = [{"title": f"r{i}", "level": levels[i * 7 % 4], "detection": [
        ("selection", [("CommandLine|contains", [f"word{i} ", f"WORD{i}!"]), ("Image|endswith", ".exe")])]} for i in range(1000)]
    rules = [R.parse_rule(d) for d in docs]
    rows = [{"CommandLine": f"x word{i} Word{(i * 13) % 1000}! y"} for i in range(0, 1200, 7)]
    got = R.apply_rules(make_events(rows), rules).orderBy("event_id").collect()
    for i, r in zip(range(0, 1200, 7), got, strict=True):
        hits = [k for k in {i, (i * 13) % 1000} if k < 1000]
        best = min(hits, key=lambda k: (-rules[k].severity, k))
        assert r["sigma_rule_name"] == f"r{best}"
