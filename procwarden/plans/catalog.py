"""Registered queries: one per operator, each over whole tables.

``QUERIES`` maps a key to a callable (spark, sf_dir) -> DataFrame, ``CHECKS``
maps the keys that have one to the equivalent SQL.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from procwarden import fixed_values as V
from procwarden.functions import text as X
from procwarden.operators import baseline as BL
from procwarden.operators import chains as C
from procwarden.operators import clean as P
from procwarden.operators import encoders as EN
from procwarden.operators import ensemble as M
from procwarden.operators import evaluation as E
from procwarden.operators import features as FE
from procwarden.operators import reporting as RP
from procwarden.operators import rules as R
from procwarden.operators import scaling as S
from procwarden.operators.forest import POOL_SAMPLES, fit_forest
from procwarden.operators.neighbours import REFERENCE_ROWS
from procwarden.plans import detection as D
from procwarden.plans import oracle as O
from procwarden.schema import COMMAND_LINES, KEYED_EVENT_SCHEMA, TEXT_COLUMNS
from procwarden.session import apply_settings, cut_lineage, file_system, scratch_path
from procwarden.sources import event_files as IO
from procwarden.sources import model_store as MS
from procwarden.sources.rule_files import load_rules
from procwarden.sources.tables import process_events

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

SAMPLE_RULES = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "sample_rules")


def query(key: str, check: str | None = None, **views: bool):
    """``views``: which views of the SQL are others, as in ``oracle.sql``."""
    def register(fn):
        @wraps(fn)
        def call(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_settings(spark)
            return fn(spark, sf_dir)

        QUERIES[key] = call
        if check is not None:
            CHECKS[key] = O.sql(check, **views)
        return call
    return register


# ---- shared steps ---------------------------------------------------------
def prepared(spark, sf) -> DataFrame:
    return P.prepare(process_events(spark, sf))


def baseline(spark, sf) -> BL.Baseline:
    return BL.fit_baseline(P.benign_only(process_events(spark, sf)))


def features(spark, sf) -> DataFrame:
    return FE.model_features(process_events(spark, sf), baseline(spark, sf))


def checked_fit(spark, sf) -> D.Artefacts:
    """Kernel-mean model, whose scores SQL can reproduce (to 6 decimals)."""
    return D.fit(P.benign_only(process_events(spark, sf)), ("boundary",), steps=0, digits=6)


def detected(spark, sf, *keep: str) -> DataFrame:
    """The same model, fitted and applied in one reading of the events; ``keep``: the event columns a query shows."""
    return D.run(process_events(spark, sf), ("boundary",), codes=False, steps=0, digits=6, keep=keep)


def scored(spark, sf, parts: tuple[str, ...] = ("boundary",), keep: tuple[str, ...] = (),
           **options) -> tuple[DataFrame, D.Artefacts]:
    """Scores of a model that is fitted and applied in one reading of the events; by default SQL's plain one."""
    options = options or {"steps": 0, "digits": 6}
    facts = cut_lineage(D.event_facts(process_events(spark, sf), keep=["label", *keep], layers=False))
    fitted = D.fit_facts(facts, parts, **options)
    return M.score(FE.relative_features(facts, fitted.baseline), fitted.model), fitted


def matched(spark, sf) -> DataFrame:
    return R.apply_rules(process_events(spark, sf))


def chained(spark, sf) -> DataFrame:
    return C.analyse_chains(process_events(spark, sf))


def r6(name: str, digits: int = 6) -> Column:
    return X.half_even(F.col(name).cast("double"), digits).alias(name)


def rr(name: str, expr: str | None = None, digits: int = 6) -> str:
    return f"{O.rnd(expr or name, digits)} AS {name}"


EVENT_COLUMNS = [f.name for f in KEYED_EVENT_SCHEMA.fields]
BLANK_AS_NULL = ", ".join(
    f"nullif({c}, '') AS {c}" if f.dataType.simpleString() == "string" else c
    for c, f in zip(EVENT_COLUMNS, KEYED_EVENT_SCHEMA.fields)).replace("User", '"User"')
TECHNIQUE = ["is_malicious", "mitre_technique_id", "technique_name"]
PLAIN = ", ".join(EVENT_COLUMNS).replace("User", '"User"')


# ---- sources and sinks ----------------------------------------------------
@query("io1_read_csv", f"SELECT {BLANK_AS_NULL} FROM process_events")
def io1(spark, sf):
    path = scratch_path(spark, "csv")
    IO.write_csv(process_events(spark, sf), path)
    return IO.read_events_csv(spark, path, KEYED_EVENT_SCHEMA)


@query("io2_read_json", f"SELECT {PLAIN} FROM process_events")
def io2(spark, sf):
    path = scratch_path(spark, "json")
    IO.write_json(process_events(spark, sf), path)
    return IO.read_events_json(spark, path, KEYED_EVENT_SCHEMA)


@query("io3_split_by_label", """
SELECT 'full' AS part, count(*) AS events, sum(length(CommandLine))::BIGINT AS chars FROM process_events
UNION ALL SELECT label, count(*), sum(length(CommandLine))::BIGINT FROM process_events GROUP BY label""")
def io3(spark, sf):
    path = scratch_path(spark, "labels")
    IO.write_by_label(process_events(spark, sf), path)
    sizes = [F.count("*").alias("events"), F.sum(F.length("CommandLine")).alias("chars")]
    parts = [spark.read.parquet(path).agg(*sizes).select(F.lit("full").alias("part"), "*")]
    for label in ("benign", "malicious", "gray_area"):
        parts.append(IO.read_label(spark, path, label).agg(*sizes).select(F.lit(label).alias("part"), "*"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


RESULT = ["event_id", "final_verdict", "priority", "confidence", "chain_risk_score", "sigma_rule_name"]


@query("io4_save_results", f"SELECT {', '.join(RESULT)} FROM detected")
def io4(spark, sf):
    path = scratch_path(spark, "results")
    IO.save_results(detected(spark, sf).select(*RESULT), path)
    return spark.read.parquet(f"{path}/results")


@query("io5_save_alerts", f"SELECT {', '.join(RESULT)} FROM detected WHERE {O.FLAGGED}")
def io5(spark, sf):
    path = scratch_path(spark, "results")
    IO.save_results(detected(spark, sf).select(*RESULT), path, "csv")
    schema = ("event_id long, final_verdict string, priority string, confidence double, "
              "chain_risk_score int, sigma_rule_name string")
    return spark.read.schema(schema).options(**IO.CSV_OPTIONS).csv(f"{path}/alerts")


@query("io6_load_rules", f"""
SELECT * FROM (
  SELECT 0 AS rule_order, 'Script host given a URL' AS title, 'medium' AS level, 'attack.t1059' AS mitre_tags,
    '10_remote_script.yml' AS filename, count(*) AS n_events FROM process_events
  WHERE {O.ends(O.IMG, [chr(92) + 'wscript.exe', chr(92) + 'cscript.exe'])} AND {O.has(*O.URLS)}
  UNION ALL
  SELECT 1, 'Ping by an elevated user', 'low', 'attack.t1018', '40_high_integrity_ping.yml', count(*)
  FROM process_events WHERE regexp_matches(CommandLine, '(?i)ping\\s+[0-9]+')
    AND lower(IntegrityLevel) IN ('high', 'system') AND NOT starts_with(lower("User"), 'nt authority'))""")
def io6(spark, sf):
    """Rules of a folder on the shared storage."""
    return rule_counts(process_events(spark, sf), load_rules(spark, shared_rules(spark)).rules)


def shared_rules(spark) -> str:
    """The sample rules, copied to the shared storage where every task can read them."""
    folder = scratch_path(spark, "rules")
    fs, where = file_system(spark, folder)
    fs.copyFromLocalFile(spark._jvm.org.apache.hadoop.fs.Path("file://" + SAMPLE_RULES), where)
    return folder


def rule_counts(events: DataFrame, rules: list[R.Rule]) -> DataFrame:
    """Metadata and number of matching events of every rule, from one scan."""
    counts = events.agg(*[F.count_if(R.match_rule(events, r)).alias(f"n{i}") for i, r in enumerate(rules)])
    per_rule = counts.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("rule_order"), F.col(f"n{i}").alias("n_events")) for i in range(len(rules))])))
    table = R.rules_table(events.sparkSession, rules).drop("id")
    return table.join(per_rule, "rule_order")


@query("io7_baseline_roundtrip", f"""
SELECT parent, child, pairs.n AS n, {rr('freq')}, rarity, {rr('length_mean', 'lm')}, {rr('length_std', 'ls')},
  {rr('entropy_mean', 'em')}, {rr('entropy_std', 'es')} FROM pairs, baseline""")
def io7(spark, sf):
    path = scratch_path(spark, "baseline")
    MS.save_baseline(spark, baseline(spark, sf), path)
    b = MS.load_baseline(spark, path)
    return b.pairs.select("parent", "child", "n", r6("freq"), "rarity", *[
        X.half_even(F.lit(v), 6).alias(n) for n, v in [
            ("length_mean", b.length_mean), ("length_std", b.length_std),
            ("entropy_mean", b.entropy_mean), ("entropy_std", b.entropy_std)]])


@query("io8_save_metrics", "SELECT layer, precision, recall, f1, fpr, tp, fp, fn, tn FROM metrics")
def io8(spark, sf):
    path = scratch_path(spark, "metrics")
    IO.save_table(E.evaluate_layers(detected(spark, sf, "is_malicious")), path)
    return spark.read.parquet(path)


@query("io9_save_stages", """
SELECT f.event_id, command_line_entropy, sigma_rule_name, ml_anomaly_score, chain_risk_score
FROM features f JOIN matched USING (event_id) JOIN scores USING (event_id) JOIN chains USING (event_id)""", every_document=True)
def io9(spark, sf):
    """Every stage is written and the next one starts from what was written.

    The features' table holds the command lines; the later ones have all other columns and, under the same
    ``event_id``, no second copy of these.
    """
    root = scratch_path(spark, "stages")
    events = process_events(spark, sf, every_document=True)

    def stage(df: DataFrame, name: str) -> DataFrame:
        IO.save_table(df, f"{root}/{name}", compression="zstd")
        return spark.read.parquet(f"{root}/{name}")

    b = BL.fit_baseline(P.benign_only(events))
    feats = stage(FE.model_features(events, b, C.TESTS).drop("_cmd"), "features")
    hits = stage(R.apply_rules(feats).drop(*COMMAND_LINES), "rules")
    model = M.fit_model(P.benign_only(hits), ("boundary",), steps=0, digits=6)
    marks = stage(M.score(hits, model), "scored")
    chains = stage(C.score_chains(marks), "chains")
    return chains.select("event_id", "command_line_entropy", "sigma_rule_name",
                         "ml_anomaly_score", "chain_risk_score")


# ---- projections, cleaning, filters ---------------------------------------
@query("p01_fill_text", "SELECT event_id, " + ", ".join(
    f'coalesce("{c}", \'\') AS "{c}"' for c in TEXT_COLUMNS) + " FROM process_events")
def p01(spark, sf):
    return P.fill_text(process_events(spark, sf)).select("event_id", *TEXT_COLUMNS)


@query("p02_basename", "SELECT event_id, child, parent FROM prepared")
def p02(spark, sf):
    return prepared(spark, sf).select("event_id", F.col("_child").alias("child"), F.col("_parent").alias("parent"))


@query("p03_lower_command", "SELECT event_id, cmd FROM prepared")
def p03(spark, sf):
    return prepared(spark, sf).select("event_id", F.col("_cmd").alias("cmd"))


@query("p04_display_names", f"""
SELECT event_id, CASE WHEN coalesce(Image, '') = '' THEN 'unknown' ELSE {O.base('Image')} END AS child_process,
  CASE WHEN coalesce(ParentImage, '') = '' THEN 'unknown' ELSE {O.base('ParentImage')} END AS parent_process
FROM process_events""")
def p04(spark, sf):
    return P.with_display_names(process_events(spark, sf)).select("event_id", "child_process", "parent_process")


@query("p05_drop_helpers", "SELECT " + ", ".join(
    f'coalesce("{c}", \'\') AS "{c}"' if c in TEXT_COLUMNS else c for c in EVENT_COLUMNS) + " FROM process_events")
def p05(spark, sf):
    return P.drop_helpers(prepared(spark, sf))


@query("p06_benign_only", "SELECT event_id, label, is_malicious FROM process_events WHERE label = 'benign'")
def p06(spark, sf):
    return P.benign_only(process_events(spark, sf)).select("event_id", "label", "is_malicious")


@query("p07_analyst_filter", """
SELECT event_id, priority, final_verdict, label, ml_anomaly_score FROM detected
WHERE priority = 'CRITICAL' AND label = 'malicious' AND ml_anomaly_score BETWEEN 20 AND 80""")
def p07(spark, sf):
    return P.analyst_filter(detected(spark, sf), priority="CRITICAL", label="malicious", ml_range=(20, 80)).select(
        "event_id", "priority", "final_verdict", "label", "ml_anomaly_score")


@query("p08_event_detail", "SELECT event_id, final_verdict, priority, feature, " + rr("value") + """ FROM (
UNPIVOT (SELECT event_id, final_verdict, priority, """ + ", ".join(
    f"{c}::DOUBLE AS {c}" for c in V.DETAIL_COLUMNS) + """ FROM detected WHERE final_verdict = 'ALERT'
  ORDER BY event_id LIMIT 1 OFFSET 25) ON """ + ", ".join(V.DETAIL_COLUMNS) + " INTO NAME feature VALUE value)")
def p08(spark, sf):
    alerts = P.analyst_filter(detected(spark, sf), verdict="ALERT")
    return P.event_detail(alerts, 25).withColumn("value", X.half_even(F.col("value"), 6))


@query("p09_alert_columns", """
SELECT event_id, substr(UtcTime, 1, 19) AS timestamp, priority, sigma_rule_name, ml_anomaly_score, confidence
FROM detected""")
def p09(spark, sf):
    return RP.alert_table(detected(spark, sf, "UtcTime"))


@query("p10_command_preview", """
SELECT event_id, substr(coalesce(CommandLine, ''), 1, 200) AS command_preview FROM process_events""")
def p10(spark, sf):
    return P.command_preview(process_events(spark, sf)).select("event_id", "command_preview")


# ---- rule operators --------------------------------------------------------
def one_rule(key: str, blocks: list, condition: str, check: str) -> None:
    """A query that marks every event with the outcome of one rule."""
    rule = R.parse_rule({"title": key, "detection": [*blocks, ("condition", condition)]})

    @query(key, f"SELECT event_id, coalesce({check}, false) AS matched FROM process_events")
    def run(spark, sf):
        events = process_events(spark, sf)
        return events.select("event_id", R.match_rule(events, rule).alias("matched"))


L, I_ = O.LINE, O.IMG
one_rule("r01_contains", [("selection", [("CommandLine|contains", ["HTTP://", "\\Temp\\"])])],
         "selection", f"contains({L}, 'http://') OR contains({L}, '\\temp\\')")
one_rule("r02_startswith", [("selection", [("User|startswith", ["corp\\", "nt "])])], "selection",
         "starts_with(lower(\"User\"), 'corp\\') OR starts_with(lower(\"User\"), 'nt ')")
one_rule("r03_endswith", [("selection", [("ParentImage|endswith", ["\\EXPLORER.EXE", "msedge.exe"])])],
         "selection", f"ends_with({O.PAR}, '\\explorer.exe') OR ends_with({O.PAR}, 'msedge.exe')")
one_rule("r04_regex", [("selection", [("CommandLine|re", ["-E(nc|ncodedCommand) [a-z0-9+/]+", "([unclosed"])])],
         "selection", "regexp_matches(CommandLine, '(?i)-E(nc|ncodedCommand) [a-z0-9+/]+')")
one_rule("r05_exact", [("selection", [("IntegrityLevel", ["HIGH", "system"])])], "selection",
         "lower(IntegrityLevel) IN ('high', 'system')")
one_rule("r06_unknown_modifier", [("selection", [("CommandLine|base64offset", ["urlcache"])])], "selection",
         f"contains({L}, 'urlcache')")
one_rule("r07_empty_never_matches", [("selection", [
    ("CommandLine|contains", [""]), ("is_malicious|contains", ["0", "1"])])], "selection",
    "coalesce(CommandLine, '') <> '' AND is_malicious <> 0")
one_rule("r08_selection_and", [("selection", [
    ("Image|endswith", "\\powershell.exe"), ("CommandLine|contains", ["http"]), ("IntegrityLevel", "High")])],
    "selection", f"ends_with({I_}, '\\powershell.exe') AND contains({L}, 'http') AND lower(IntegrityLevel) = 'high'")
one_rule("r09_condition_single", [("selection", [("Image|endswith", "\\mshta.exe")]),
                                  ("selection_b", [("Image|endswith", "\\cmd.exe")])],
         "selection_missing", f"ends_with({I_}, '\\mshta.exe')")
one_rule("r10_condition_or", [("selection_a", [("Image|endswith", "\\mshta.exe")]),
                              ("selection_b", [("Image|endswith", "\\cmd.exe")])],
         "selection_a or selection_b or selection_missing",
         f"ends_with({I_}, '\\mshta.exe') OR ends_with({I_}, '\\cmd.exe')")
one_rule("r11_condition_not_filter", [
    ("selection", [("CommandLine|contains", "http")]), ("filter_a", [("User|startswith", "nt authority")]),
    ("filter_b", [("IntegrityLevel", "Low")])], "selection and not filter_a",
    f"contains({L}, 'http') AND NOT starts_with(lower(\"User\"), 'nt authority') AND lower(IntegrityLevel) <> 'low'")


@query("r12_all_matches", """
SELECT event_id, title AS rule_title, id AS rule_id, level, tags AS mitre_tags, description
FROM hits JOIN rules USING (ord)""")
def r12(spark, sf):
    df = R.all_matches(process_events(spark, sf), R.default_rules())
    return df.select("event_id", F.inline("rule_matches")).withColumn(
        "mitre_tags", F.array_join("mitre_tags", ", "))


@query("r13_technique_tags", """
SELECT tags AS technique_tag, count(*) AS matches, count(DISTINCT event_id) AS events
FROM hits JOIN rules USING (ord) GROUP BY tags""")
def r13(spark, sf):
    df = R.all_matches(process_events(spark, sf), R.default_rules())
    tags = df.select("event_id", F.inline("rule_matches")).select(
        "event_id", F.explode("mitre_tags").alias("technique_tag"))
    # One event carries a tag at most once per rule; merge per event first.
    per_event = tags.groupBy("technique_tag", "event_id").agg(F.count("*").alias("n"))
    return per_event.groupBy("technique_tag").agg(
        F.sum("n").alias("matches"), F.count("*").alias("events"))


@query("r14_best_match", "SELECT event_id, title AS sigma_rule_name, level AS sigma_level FROM best")
def r14(spark, sf):
    return R.matched_events(process_events(spark, sf)).select("event_id", "sigma_rule_name", "sigma_level")


MATCH = ["event_id", "sigma_match", "sigma_rule_name", "sigma_level", "sigma_mitre_tags"]


@query("r15_dataset_columns", f"SELECT {', '.join(MATCH)} FROM matched")
def r15(spark, sf):
    return matched(spark, sf).select(*MATCH)


@query("r16_rules_summary", """
SELECT ord AS rule_order, title, level, tags AS mitre_tags, filename, count(event_id) AS n_events
FROM rules LEFT JOIN hits USING (ord) GROUP BY ALL""")
def r16(spark, sf):
    return rule_counts(process_events(spark, sf), R.default_rules())


@query("r17_match_rate_by_label", f"""
SELECT label, count(*) AS events, count(*) FILTER (sigma_match) AS matched,
  {rr('match_rate', 'count(*) FILTER (sigma_match) / count(*)')} FROM matched GROUP BY label""")
def r17(spark, sf):
    return R.match_rate_by_label(matched(spark, sf)).withColumn("match_rate", r6("match_rate"))


@query("r18_events_per_rule", """
SELECT sigma_rule_name, count(*) AS n_events FROM matched WHERE sigma_match GROUP BY 1""")
def r18(spark, sf):
    return R.events_per_rule(matched(spark, sf))


for _i, _rule in enumerate(R.default_rules(), start=1):
    def _register(i: int, rule: R.Rule) -> None:
        stem = rule.filename[:-4]

        @query(f"ru{i:02d}_{stem}", f"SELECT event_id, coalesce({O.RULES[stem]}, false) AS matched FROM process_events")
        def run(spark, sf):
            events = process_events(spark, sf)
            return events.select("event_id", R.match_rule(events, rule).alias("matched"))
    _register(_i, _rule)


# ---- features ---------------------------------------------------------------
FEATURE_IDS = {
    3: "is_known_lolbin", 4: "is_scripting_engine", 5: "command_line_length", 6: "command_line_entropy",
    7: "has_suspicious_flag", 8: "contains_url", 9: "contains_ip_address", 10: "has_base64_pattern",
    11: "argument_count", 12: "suspicious_argument_ratio", 13: "has_encoded_command",
    14: "has_download_indicator", 15: "process_ancestry_depth", 16: "parent_is_office_app",
    17: "parent_is_browser", 18: "parent_is_script_engine", 19: "chain_hash", 20: "hour_of_day",
    21: "is_off_hours", 22: "is_weekend", 23: "minute_of_hour", 27: "is_system_user", 29: "integrity_encoded",
}
for _id, _name in FEATURE_IDS.items():
    def _register_feature(i: int, name: str) -> None:
        @query(f"f{i:02d}_{name}", f"SELECT event_id, {O.FEATURES[name]} AS {name} FROM prepared")
        def run(spark, sf):
            return FE.row_features(prepared(spark, sf), [name]).select("event_id", name)
    _register_feature(_id, _name)


def coded(key: str, name: str, value: str, sql_value: str) -> None:
    @query(key, f"SELECT event_id, code AS {name} FROM prepared JOIN ({O.codes(sql_value)}) ON v = {sql_value}")
    def run(spark, sf):
        df = prepared(spark, sf).withColumn("_user", F.lower("User"))
        return EN.encode(df, value, EN.fit_encoder(df, value), name).select("event_id", name)


coded("f01_parent_process_name", "parent_process_name", "_parent", "parent")
coded("f02_child_process_name", "child_process_name", "_child", "child")
coded("f28_user_encoded", "user_encoded", "_user", O.CODES["user_encoded"])


@query("f24_parent_child_pair_rarity", "SELECT event_id, parent_child_pair_rarity FROM features")
def f24(spark, sf):
    return FE.pair_rarity(prepared(spark, sf), baseline(spark, sf)).select("event_id", "parent_child_pair_rarity")


@query("f25_command_length_zscore", f"SELECT event_id, {rr('command_length_zscore')} FROM features")
def f25(spark, sf):
    return features(spark, sf).select("event_id", r6("command_length_zscore"))


@query("f26_entropy_zscore", f"SELECT event_id, {rr('entropy_zscore')} FROM features")
def f26(spark, sf):
    return features(spark, sf).select("event_id", r6("entropy_zscore"))


@query("f30_baseline_length", f"SELECT n AS events, {rr('length_mean', 'lm')}, {rr('length_std', 'ls')} FROM baseline")
def f30(spark, sf):
    return BL.baseline_stats(spark, baseline(spark, sf)).select("events", r6("length_mean"), r6("length_std"))


@query("f31_baseline_entropy", f"SELECT n AS events, {rr('entropy_mean', 'em')}, {rr('entropy_std', 'es')} FROM baseline")
def f31(spark, sf):
    return BL.baseline_stats(spark, baseline(spark, sf)).select("events", r6("entropy_mean"), r6("entropy_std"))


@query("f32_pair_frequencies", f"SELECT parent, child, n, {rr('freq', None, 9)} FROM pairs")
def f32(spark, sf):
    return baseline(spark, sf).pairs.select("parent", "child", "n", r6("freq", 9))


@query("f33_model_columns", "SELECT event_id, " + ", ".join(
    rr(c) for c in V.MODEL_COLUMNS) + " FROM features")
def f33(spark, sf):
    return features(spark, sf).select("event_id", *[r6(c) for c in V.MODEL_COLUMNS])


@query("f34_feature_profile", "\nUNION ALL ".join(f"""
SELECT '{c}' AS feature, {rr('mean', f'avg({c})')}, {rr('std', f'stddev_samp({c})')}, {rr('min', f'min({c})')},
  {rr('max', f'max({c})')}, {rr('benign_mean', f'avg({c}) FILTER (is_malicious = 0)')},
  {rr('malicious_mean', f'avg({c}) FILTER (is_malicious = 1)')},
  {rr('separation', f'abs(avg({c}) FILTER (is_malicious = 1) - avg({c}) FILTER (is_malicious = 0))')}
FROM features""" for c in V.MODEL_COLUMNS))
def f34(spark, sf):
    return feature_profile(features(spark, sf))


def feature_profile(df: DataFrame) -> DataFrame:
    """Profile of every model column, from one aggregation over the events."""
    cells = []
    for c in V.MODEL_COLUMNS:
        v = F.col(c).cast("double")
        cells += [F.avg(v).alias(f"mean_{c}"), F.stddev_samp(v).alias(f"std_{c}"),
                  F.min(v).alias(f"min_{c}"), F.max(v).alias(f"max_{c}"),
                  F.avg(F.when(E.good(), v)).alias(f"good_{c}"), F.avg(F.when(E.bad(), v)).alias(f"bad_{c}")]
    rows = [F.struct(F.lit(c).alias("feature"), *[
        X.half_even(e, 6).alias(n) for n, e in [
            ("mean", F.col(f"mean_{c}")), ("std", F.col(f"std_{c}")), ("min", F.col(f"min_{c}")),
            ("max", F.col(f"max_{c}")), ("benign_mean", F.col(f"good_{c}")),
            ("malicious_mean", F.col(f"bad_{c}")),
            ("separation", F.abs(F.col(f"bad_{c}") - F.col(f"good_{c}")))]]) for c in V.MODEL_COLUMNS]
    return df.agg(*cells).select(F.inline(F.array(*rows)))


@query("f35_apply_saved_encoder", """
SELECT event_id, code AS user_encoded FROM prepared JOIN (
  SELECT v, row_number() OVER (ORDER BY known DESC, first) - 1 AS code FROM (
    SELECT lower("User") AS v, bool_or(label = 'benign') AS known,
      coalesce(min(event_id) FILTER (label = 'benign'), min(event_id)) AS first
    FROM prepared GROUP BY 1)) ON v = lower("User")""")
def f35(spark, sf):
    path = scratch_path(spark, "encoder")
    df = prepared(spark, sf).withColumn("_user", F.lower("User"))
    MS.save_baseline(spark, BL.Baseline(), path, {"user": EN.fit_encoder(P.benign_only(df), "_user")})
    grown = EN.fit_encoder(df, "_user", known=MS.load_encoder(spark, path, "user"))
    return EN.encode(df, "_user", grown, "user_encoded").select("event_id", "user_encoded")


ALL_RESULTS = [*MATCH, "ml_anomaly_score", "chain_risk_score", "chain_description", "chain_matched_pattern",
               "final_verdict", "priority", "confidence", "explanation"]


# ---- anomaly model ----------------------------------------------------------
@query("m01_matrix_prep", """
SELECT event_id, coalesce(length(CommandLine), 0)::DOUBLE AS command_line_length,
  CASE WHEN label = 'malicious' THEN 0.0::DOUBLE ELSE ProcessId::DOUBLE END AS argument_count FROM process_events""")
def m01(spark, sf):
    """Null lengths and infinite counts are put to 0."""
    raw = process_events(spark, sf).select(
        "event_id", F.length("CommandLine").alias("command_line_length"),
        F.when(F.col("label") == "malicious", F.lit(float("-inf"))).otherwise(
            F.col("ProcessId").cast("double")).alias("argument_count"))
    return FE.model_matrix(raw)


@query("m02_standardise", "SELECT event_id, " + ", ".join(
    rr(c, e) for c, e in O.SCALED.items()) + " FROM features, fstats")
def m02(spark, sf):
    df = features(spark, sf)
    stats = S.fit_stats(P.benign_only(df))
    x = df.select("event_id", S.scaled_vector(stats).alias("x"))
    return x.select("event_id", *[X.half_even(F.col("x")[i], 6).alias(c) for i, c in enumerate(stats.columns)])


@query("m03_explain_stats", "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, {rr('mean', f'm_{c}')}, {rr('std', f'greatest(s_{c}, 0.001)')}, "
    f"{rr('min', f'l_{c}')}, {rr('max', f'h_{c}')} FROM fstats" for c in V.MODEL_COLUMNS))
def m03(spark, sf):
    stats = S.fit_stats(P.benign_only(features(spark, sf)))
    return S.stats_table(spark, stats).select("feature", *[r6(c) for c in ("mean", "std", "min", "max")])


@query("m04_forest_fit", f"""
SELECT tree::INTEGER AS tree, count(*) AS nodes, count(*) FILTER (f < 0) AS leaves, {rr('longest_path', 'max(path)')}
FROM forest_nodes GROUP BY tree""")
def m04(spark, sf):
    """Size, depth and leaf weight of every tree."""
    benign = P.benign_only(features(spark, sf))
    stats = S.fit_stats(benign)
    forest = fit_forest(benign.select("event_id", S.scaled_vector(stats).alias("x")), stats.rows,
                        pool_samples=POOL_SAMPLES)
    return forest.nodes.groupBy("tree").agg(
        F.count("*").alias("nodes"), F.count_if(F.col("feature") < 0).alias("leaves"),
        F.max("path").alias("longest_path")).select("tree", "nodes", "leaves", r6("longest_path"))


def part_scores(spark, sf, part: str) -> DataFrame:
    """Scores of one model by itself, fitted on as many rows as its SQL asks for."""
    return scored(spark, sf, (part,), digits=O.SCORE_DIGITS, reference=REFERENCE_ROWS, pool_samples=POOL_SAMPLES)[0]


@query("m05_forest_score", O.part_score("forest"))
def m05(spark, sf):
    return part_scores(spark, sf, "forest").select("event_id", "label", "ml_anomaly_score")


@query("m06_outlier_factor", O.part_score("lof"))
def m06(spark, sf):
    """Every event against the density of the reference rows."""
    return part_scores(spark, sf, "lof").select("event_id", "label", "ml_anomaly_score")


@query("m07_boundary_score", O.part_score("boundary"))
def m07(spark, sf):
    return part_scores(spark, sf, "boundary").select("event_id", "label", "ml_anomaly_score")


@query("m08_kernel_mean", f"SELECT event_id, {rr('similarity', '-raw')} FROM raw_scores")
def m08(spark, sf):
    fitted = checked_fit(spark, sf)
    x = FE.model_features(process_events(spark, sf), fitted.baseline).select(
        "event_id", S.scaled_vector(fitted.model.stats).alias("x"))
    raw = M.raw_columns(fitted.model, F.col("x"))["boundary"]
    return x.select("event_id", X.half_even(-raw, 6).alias("similarity"))


@query("m09_score_range", f"SELECT 'boundary' AS part, {rr('low', 'lo')}, {rr('high', 'hi')} FROM score_range")
def m09(spark, sf):
    model = checked_fit(spark, sf).model
    low, high = model.ranges["boundary"]
    return spark.range(0, 1, 1, 1).select(
        F.lit("boundary").alias("part"), X.half_even(F.lit(float(low)), 6).alias("low"),
        X.half_even(F.lit(float(high)), 6).alias("high"))


@query("m10_normalised_score", "SELECT event_id, ml_anomaly_score FROM scores")
def m10(spark, sf):
    return scored(spark, sf)[0].select("event_id", "ml_anomaly_score")


@query("m11_ensemble", "SELECT event_id, label, ml_anomaly_score FROM all_scores JOIN scaled USING (event_id)", every_row=True)
def m11(spark, sf):
    """All three models, fitted on all benign rows, over all events."""
    df = scored(spark, sf, M.PARTS, digits=O.SCORE_DIGITS)[0]
    return df.select("event_id", "label", "ml_anomaly_score")


@query("m12_explain", "SELECT event_id, explanation FROM explained")
def m12(spark, sf):
    df, fitted = scored(spark, sf)
    return df.select("event_id", F.expr(M.explanation(
        fitted.model.stats, df.columns, "ml_anomaly_score")).alias("explanation"))


@query("m13_score_summary", f"""
SELECT label, count(*) AS events, {rr('mean_score', 'avg(ml_anomaly_score)')},
  {rr('median_score', 'quantile_cont(ml_anomaly_score, 0.5)', 4)}, {rr('std_score', 'stddev_samp(ml_anomaly_score)')},
  min(ml_anomaly_score) AS min_score, max(ml_anomaly_score) AS max_score,
  count(*) FILTER (ml_anomaly_score > 70) AS above,
  {rr('above_pct', 'count(*) FILTER (ml_anomaly_score > 70) / count(*) * 100')}
FROM scores JOIN process_events USING (event_id) GROUP BY label""")
def m13(spark, sf):
    return M.score_summary(scored(spark, sf)[0]).select(
        "label", "events", r6("mean_score"), r6("median_score", 4), r6("std_score"), "min_score", "max_score",
        "above", r6("above_pct"))


@query("m14_saved_model", "SELECT event_id, ml_anomaly_score FROM scores")
def m14(spark, sf):
    """First use fits and stores, second use loads; the loaded model scores."""
    path = scratch_path(spark, "model")
    df = cut_lineage(features(spark, sf).select("event_id", "label", *V.MODEL_COLUMNS))
    benign = P.benign_only(df)
    options = {"parts": ("boundary",), "steps": 0, "digits": 6}
    MS.load_or_fit(benign, path, **options)
    return M.score(df, MS.load_or_fit(benign, path, **options)).select("event_id", "ml_anomaly_score")


@query("m14_stored_run", f"SELECT {', '.join(ALL_RESULTS)} FROM reasoned")
def m14_run(spark, sf):
    """First use fits and stores all artefacts, second use detects with what was stored."""
    path = scratch_path(spark, "artefacts")
    options = {"parts": ("boundary",), "steps": 0, "digits": 6, "codes": False}
    MS.run_with_store(P.benign_only(process_events(spark, sf)), path, keep=[], **options)
    return MS.run_with_store(process_events(spark, sf), path, keep=[], **options).select(*ALL_RESULTS)


@query("m15_top_anomalies", f"""
SELECT event_id, label, CASE WHEN parent = 'unknown' THEN 'unknown' ELSE {O.base('ParentImage')} END AS parent_process,
  {O.base('Image')} AS child_process, ml_anomaly_score, explanation
FROM prepared JOIN scores USING (event_id) JOIN explained USING (event_id)
ORDER BY ml_anomaly_score DESC, event_id LIMIT 10""")
def m15(spark, sf):
    df, fitted = scored(spark, sf, keep=("Image", "ParentImage"))
    return P.with_display_names(M.top_anomalies(df, fitted.model)).select(
        "event_id", "label", "parent_process", "child_process", "ml_anomaly_score", "explanation")


@query("m16_alert_count", "SELECT count(*) FILTER (ml_anomaly_score > 70) AS ml_alerts FROM scores")
def m16(spark, sf):
    return M.alert_count(scored(spark, sf)[0])


# ---- chains -----------------------------------------------------------------
@query("c01_pair_lookup", """
SELECT event_id, parent, child, coalesce(pair_score, 0) AS base_score, descr AS description,
  pair_score IS NOT NULL AS matched FROM chains""")
def c01(spark, sf):
    return C.with_pair(prepared(spark, sf)).select(
        "event_id", F.col("_parent").alias("parent"), F.col("_child").alias("child"),
        F.coalesce("pair_score", F.lit(0)).alias("base_score"), F.col("pair_desc").alias("description"),
        F.col("pair_desc").isNotNull().alias("matched"))


MODIFIER_IDS = ["c02_office_script", "c03_url", "c04_binary_child", "c05_off_hours", "c06_encoded", "c07_flags"]
for _i, _key in enumerate(MODIFIER_IDS):
    def _register_modifier(i: int, key: str) -> None:
        points = C.MODIFIERS[i][0]

        @query(key, f"SELECT event_id, CASE WHEN m{i} THEN {points} ELSE 0 END AS points FROM chains")
        def run(spark, sf):
            return C.with_pair(prepared(spark, sf)).select("event_id", C.modifier(i).alias("points"))
    _register_modifier(_i, _key)


@query("c08_capped_score", "SELECT event_id, chain_risk_score FROM chains")
def c08(spark, sf):
    return chained(spark, sf).select("event_id", "chain_risk_score")


@query("c09_description", "SELECT event_id, chain_description FROM chains")
def c09(spark, sf):
    return chained(spark, sf).select("event_id", "chain_description")


CHAIN = ["event_id", "label", "chain_risk_score", "chain_description", "chain_matched_pattern"]


@query("c10_dataset_columns", f"SELECT {', '.join(CHAIN)} FROM chains")
def c10(spark, sf):
    return chained(spark, sf).select(*CHAIN)


@query("c11_summary_by_label", f"""
SELECT label, count(*) AS events, {rr('mean_risk', 'avg(chain_risk_score)')}, max(chain_risk_score) AS max_risk,
  count(*) FILTER (chain_matched_pattern) AS matched, count(*) FILTER (chain_risk_score > 50) AS high_risk,
  {rr('matched_pct', 'count(*) FILTER (chain_matched_pattern) / count(*) * 100')},
  {rr('high_risk_pct', 'count(*) FILTER (chain_risk_score > 50) / count(*) * 100')} FROM chains GROUP BY label""")
def c11(spark, sf):
    return C.chain_summary(chained(spark, sf)).select(
        "label", "events", r6("mean_risk"), "max_risk", "matched", "high_risk",
        r6("matched_pct"), r6("high_risk_pct"))


@query("c12_top_chains", """
SELECT event_id, label, chain_risk_score, substr(chain_description, 1, 80) AS description
FROM chains ORDER BY chain_risk_score DESC, event_id LIMIT 15""")
def c12(spark, sf):
    return C.top_chains(chained(spark, sf))


@query("c13_alert_count", "SELECT count(*) FILTER (chain_risk_score > 60) AS chain_alerts FROM chains")
def c13(spark, sf):
    return chained(spark, sf).agg(F.count_if(F.col("chain_risk_score") > V.CHAIN_THRESHOLD).alias("chain_alerts"))


# ---- fusion -----------------------------------------------------------------
@query("u1_verdict", "SELECT event_id, final_verdict, priority FROM detected")
def u1(spark, sf):
    return detected(spark, sf).select("event_id", "final_verdict", "priority")


@query("u2_confidence", "SELECT event_id, priority, confidence FROM detected")
def u2(spark, sf):
    return detected(spark, sf).select("event_id", "priority", "confidence")


@query("u3_explanation", "SELECT event_id, explanation FROM reasoned")
def u3(spark, sf):
    return detected(spark, sf).select("event_id", "explanation")


ALL_FEATURES = ["event_id", *FE.ROW_FEATURES, "parent_child_pair_rarity", "command_length_zscore", "entropy_zscore",
                *[name for name, _, _ in FE.CODED]]


@query("u4_detect", f"SELECT {', '.join(ALL_RESULTS)} FROM reasoned")
def u4(spark, sf):
    return detected(spark, sf).select(*ALL_RESULTS)


@query("u4_detect_full_ensemble", f"SELECT {', '.join(ALL_RESULTS)} FROM all_reasoned", every_row=True)
def u4_full(spark, sf):
    return D.run(process_events(spark, sf), digits=O.SCORE_DIGITS, keep=[], codes=False).select(*ALL_RESULTS)


@query("u4_features", f"""
SELECT {', '.join(f'f.{c}' for c in ALL_FEATURES[:-6])}, {', '.join(f"{O.rnd('f.' + c)} AS {c}" for c in ALL_FEATURES[-6:-3])},
  {', '.join(f'{name}.code AS {name}' for name in O.CODES)}
FROM features f """ + " ".join(f"JOIN ({O.codes(v)}) {name} ON {name}.v = {v}" for name, v in O.CODES.items()))
def u4_features(spark, sf):
    """All 29 features of the one-pass detection."""
    df = D.run(process_events(spark, sf), ("boundary",), steps=0, keep=[])
    plain = [c for c in ALL_FEATURES if c not in ALL_FEATURES[-6:-3]]
    return df.select(*plain, *[r6(c) for c in ALL_FEATURES[-6:-3]])


# ---- evaluation and reports ---------------------------------------------------
@query("e01_confusion", "SELECT layer, tp, fp, fn, tn FROM confusion")
def e01(spark, sf):
    return E.confusion(detected(spark, sf, "is_malicious"))


@query("e02_rates", "SELECT layer, precision, recall, f1, fpr FROM metrics WHERE layer = 'combined'")
def e02(spark, sf):
    return E.evaluate_layers(detected(spark, sf, "is_malicious")).filter("layer = 'combined'").select(
        "layer", "precision", "recall", "f1", "fpr")


@query("e03_layers", "SELECT layer, precision, recall, f1, fpr, tp, fp, fn, tn FROM metrics")
def e03(spark, sf):
    return E.evaluate_layers(detected(spark, sf, "is_malicious"))


@query("e04_compare", """
SELECT c.recall >= s.recall AS recall_ge_sigma, c.recall >= m.recall AS recall_ge_ml, c.precision > 0 AS has_precision,
  c.recall AS combined_recall, c.precision AS combined_precision
FROM metrics c, metrics s, metrics m WHERE c.layer = 'combined' AND s.layer = 'sigma' AND m.layer = 'ml'""")
def e04(spark, sf):
    return E.compare_layers(detected(spark, sf, "is_malicious"))


@query("e05_missed_by_rules", """
SELECT mitre_technique_id, arg_min(technique_name, event_id) AS technique_name, count(*) AS missed
FROM detected WHERE is_malicious = 1 AND NOT sigma_match AND mitre_technique_id <> '' GROUP BY 1""")
def e05(spark, sf):
    return E.missed_by_rules(detected(spark, sf, *TECHNIQUE))


@query("e06_technique_breakdown", f"""
SELECT mitre_technique_id, arg_min(technique_name, event_id) AS technique_name, count(*) AS total,
  {', '.join(f'count(*) FILTER ({h}) AS {layer}' for layer, h in O.LAYER_HITS.items())},
  {rr('detection_pct', f'count(*) FILTER ({O.FLAGGED}) / count(*) * 100')}
FROM detected WHERE is_malicious = 1 AND mitre_technique_id <> '' GROUP BY 1""")
def e06(spark, sf):
    return E.technique_breakdown(detected(spark, sf, *TECHNIQUE)).withColumn("detection_pct", r6("detection_pct"))


@query("e07_technique_coverage", f"""
SELECT mitre_technique_id || ': ' || arg_min(technique_name, event_id) AS technique, count(*) AS total,
  count(*) FILTER ({O.FLAGGED}) AS detected, {rr('detection_rate', f'count(*) FILTER ({O.FLAGGED}) / count(*) * 100')}
FROM detected WHERE is_malicious = 1 AND mitre_technique_id <> '' GROUP BY mitre_technique_id""")
def e07(spark, sf):
    return E.technique_coverage(detected(spark, sf, *TECHNIQUE)).withColumn("detection_rate", r6("detection_rate"))


@query("e08_roc", f"SELECT score, tp, fp, {rr('tpr')}, {rr('fpr')} FROM rates")
def e08(spark, sf):
    return E.roc_points(detected(spark, sf, "is_malicious")).select("score", "tp", "fp", r6("tpr"), r6("fpr"))


@query("e08_area_under_curve", f"""
SELECT {rr('auc', 'sum(neg / (SELECT sum(neg) FROM roc) * (tp + tp - pos) / 2 / (SELECT sum(pos) FROM roc))')} FROM roc""")
def e08_auc(spark, sf):
    return E.area_under_curve(E.roc_points(detected(spark, sf, "is_malicious"))).select(r6("auc"))


@query("e09_operating_point", f"""
SELECT score, {rr('tpr')}, {rr('fpr')} FROM rates ORDER BY abs(score - 70), score DESC LIMIT 1""")
def e09(spark, sf):
    return E.operating_point(E.roc_points(detected(spark, sf, "is_malicious"))).select("score", r6("tpr"), r6("fpr"))


FP = f"FROM detected WHERE is_malicious = 0 AND {O.FLAGGED}"


@query("e10_false_positives_by_label", f"""
SELECT label, count(*) AS fps, (sum(count(*)) OVER ())::BIGINT AS total_fps {FP} GROUP BY label""")
def e10(spark, sf):
    return E.false_positives_by_label(detected(spark, sf, "is_malicious"))


@query("e11_false_positives_by_process", f"""
SELECT child AS process, count(*) AS fps {FP} GROUP BY 1 ORDER BY fps DESC, process LIMIT 5""")
def e11(spark, sf):
    return E.false_positives_by_process(detected(spark, sf, "is_malicious", "Image"))


@query("e12_false_positive_triggers", f"""
SELECT count(*) AS total, count(*) FILTER (sigma_match) AS by_sigma,
  count(*) FILTER (ml_anomaly_score > 70) AS by_ml, count(*) FILTER (chain_risk_score > 60) AS by_chain {FP}""")
def e12(spark, sf):
    return E.false_positive_triggers(detected(spark, sf, "is_malicious"))


@query("e13_tuning_hints", f"""
SELECT 'exclude' AS hint, sigma_rule_name AS subject, count(*) AS fps {FP} AND sigma_match GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'raise', 'ml 70 to 75', count(*) FILTER (ml_anomaly_score > 70) AS n {FP}) WHERE n > 5
UNION ALL SELECT * FROM (SELECT 'raise', 'chain 60 to 70', count(*) FILTER (chain_risk_score > 60) AS n {FP}) WHERE n > 5""")
def e13(spark, sf):
    return E.tuning_hints(detected(spark, sf, "is_malicious"))


@query("e14_verdict_shares", f"""
SELECT final_verdict, count(*) AS events, {rr('pct', 'count(*) / (SELECT count(*) FROM detected) * 100')}
FROM detected GROUP BY 1""")
def e14(spark, sf):
    return RP.verdict_shares(detected(spark, sf)).withColumn("pct", r6("pct"))


@query("e15_priority_counts", "SELECT priority, count(*) AS events FROM detected GROUP BY 1")
def e15(spark, sf):
    return RP.priority_counts(detected(spark, sf))


@query("e16_detection_vs_truth", f"""
SELECT count(*) FILTER (final_verdict = 'ALERT' AND is_malicious = 1) AS true_positives,
  count(*) FILTER (final_verdict = 'ALERT' AND is_malicious = 0) AS false_positives,
  count(*) FILTER (is_malicious = 1 AND {O.FLAGGED}) AS caught, count(*) FILTER (is_malicious = 1) AS malicious,
  {rr('caught_pct', f'count(*) FILTER (is_malicious = 1 AND {O.FLAGGED}) / count(*) FILTER (is_malicious = 1) * 100')}
FROM detected""")
def e16(spark, sf):
    return RP.detection_vs_truth(detected(spark, sf, "is_malicious")).withColumn("caught_pct", r6("caught_pct"))


@query("e17_first_alerts", """
SELECT event_id, substr(UtcTime, 1, 19) AS timestamp, priority, sigma_rule_name, ml_anomaly_score, confidence
FROM detected WHERE final_verdict = 'ALERT' ORDER BY event_id LIMIT 20""")
def e17(spark, sf):
    return RP.first_alerts(detected(spark, sf, "UtcTime"))


HEAD = """count(*) AS total_events, count(*) FILTER (final_verdict = 'ALERT') AS alerts,
  count(*) FILTER (priority = 'CRITICAL') AS critical, count(*) FILTER (priority = 'HIGH') AS high,
  count(*) FILTER (priority = 'MEDIUM') AS medium"""


@query("e18_headline_counts", f"SELECT {HEAD} FROM detected")
def e18(spark, sf):
    return RP.headline_counts(detected(spark, sf))


@query("e19_score_histogram", """
SELECT bin, label, count(*) AS events, bin * 2.5::DOUBLE AS bin_start
FROM (SELECT floor(least(ml_anomaly_score, 99.999::DOUBLE) / 2.5::DOUBLE)::BIGINT AS bin, label FROM detected)
GROUP BY bin, label""")
def e19(spark, sf):
    return RP.score_histogram(detected(spark, sf))


@query("e20_hour_histogram", "SELECT hour_of_day, label, count(*) AS events FROM row_features GROUP BY 1, 2")
def e20(spark, sf):
    return RP.hour_histogram(FE.row_features(prepared(spark, sf), ["hour_of_day"]))


@query("e21_entropy_summary", "SELECT label, " + ", ".join(
    rr(n, f"quantile_cont(command_line_entropy, {p})", 4) for n, p in
    [("low", 0.0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("high", 1.0)]) + " FROM row_features GROUP BY label")
def e21(spark, sf):
    five = RP.entropy_summary(FE.row_features(prepared(spark, sf), ["command_line_entropy"]))
    return five.select("label", *[r6(c, 4) for c in ("low", "q1", "median", "q3", "high")])


@query("e22_alert_listing", f"""
SELECT event_id, UtcTime, priority, CASE WHEN parent = 'unknown' THEN 'unknown' ELSE {O.base('ParentImage')} END
    AS parent_process, {O.base('Image')} AS child_process, sigma_rule_name, ml_anomaly_score, chain_risk_score,
  confidence, label FROM detected WHERE {O.FLAGGED}""")
def e22(spark, sf):
    return RP.alert_listing(detected(spark, sf, "UtcTime", "Image", "ParentImage"))


@query("e23_incident_row", "SELECT * FROM (SELECT " + HEAD + " FROM detected), (SELECT " + ", ".join(
    f"max({m}) FILTER (layer = '{layer}') AS {layer}_{m}" for layer in E.LAYERS for m in E.METRICS) + " FROM metrics)")
def e23(spark, sf):
    return RP.incident_row(detected(spark, sf, "is_malicious"))


@query("e24_label_profile", f"""
SELECT label, count(*) AS events, {rr('pct', 'count(*) / (SELECT count(*) FROM prepared) * 100')},
  count(*) FILTER (hour(stamp) BETWEEN 8 AND 17) AS business, count(*) FILTER (hour(stamp) BETWEEN 0 AND 5) AS off_hours,
  count(*) - count(*) FILTER (hour(stamp) BETWEEN 8 AND 17) - count(*) FILTER (hour(stamp) BETWEEN 0 AND 5) AS other
FROM prepared GROUP BY label""")
def e24(spark, sf):
    return RP.label_profile(process_events(spark, sf)).withColumn("pct", r6("pct"))


@query("e24_technique_profile", """
SELECT mitre_technique_id, technique_name, count(*) AS events FROM process_events WHERE is_malicious = 1 GROUP BY 1, 2""")
def e24_techniques(spark, sf):
    return RP.technique_profile(process_events(spark, sf))


@query("d1_facets", """
SELECT (SELECT string_agg(DISTINCT priority, ',' ORDER BY priority) FROM detected) AS priorities,
  (SELECT string_agg(DISTINCT final_verdict, ',' ORDER BY final_verdict) FROM detected) AS verdicts,
  (SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM detected) AS labels""")
def d1(spark, sf):
    return RP.facets(detected(spark, sf))


@query("s1_union_labelled", "SELECT event_id, label, is_malicious, mitre_technique_id FROM process_events")
def s1(spark, sf):
    events = process_events(spark, sf).select("event_id", "label", "is_malicious", "mitre_technique_id")
    return RP.union_labelled(*[events.filter(F.col("label") == x) for x in ("benign", "malicious", "gray_area")])
