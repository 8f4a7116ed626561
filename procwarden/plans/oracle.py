"""The registered queries as SQL, for the correctness check.

Written for the engine that checks the results, independently of the column
expressions.  ``sql(body)`` puts the views that ``body`` names in front of it.
"""

from __future__ import annotations

import re

from procwarden import fixed_values as V
from procwarden.operators import boundary, forest, neighbours
from procwarden.operators.boundary import make_directions
from procwarden.sources import tables as B


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def names(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def listed(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def any_in(column: str, needles) -> str:
    return "(" + " OR ".join(f"contains({column}, {q(n)})" for n in needles) + ")"


def rnd(expr: str, digits: int = 6) -> str:
    scale = f"1e{digits}::DOUBLE"
    return f"(round_even(({expr})::DOUBLE * {scale}, 0) / {scale})"


def base(column: str) -> str:
    """Last path segment, not lower-cased."""
    return f"regexp_extract(replace({column}, '/', '\\'), '[^\\\\]*$')"


def name_of(column: str) -> str:
    return f"CASE WHEN coalesce({column}, '') = '' THEN 'unknown' ELSE lower({base(column)}) END"


N_T, N_I, N_P = len(B.TEMPLATES), len(B.IMAGES), len(B.PARENTS)

VIEWS: dict[str, str] = {}

VIEWS["indexed"] = f"""
SELECT e.*, CASE WHEN event_id < n_docs THEN {B.DOC_TEMPLATES}[event_id % {len(B.DOC_TEMPLATES)} + 1]
    WHEN event_id < n_docs + n_pages THEN {B.URL_TEMPLATES}[event_id % {len(B.URL_TEMPLATES)} + 1]
    ELSE (event_id * 3 + user_id) % {N_T} END AS t,
  replace({listed([t[1] or '' for t in B.TEMPLATES])}[t + 1], 'doc',
    CASE WHEN event_id < n_docs THEN 'doc' ELSE 'props' END) AS kind,
  {listed(B.IMAGES)}[(event_id * 7 + user_id) % {N_I} + 1] AS image,
  CASE WHEN event_id % 101 <> 0 THEN {listed(B.PARENTS)}[(event_id * 5 + user_id) % {N_P} + 1] END AS parent
FROM (SELECT *, (SELECT count(*) FROM documents) AS n_docs, (SELECT count(*) FROM pages) AS n_pages FROM events) e"""

# Documents in turn for later events, too.
EVERY_DOCUMENT = {"indexed": VIEWS["indexed"].replace("CASE WHEN event_id < n_docs THEN 'doc' ELSE 'props' END", "'doc'")}

VIEWS["process_events"] = f"""
SELECT i.event_id,
  CASE WHEN event_id % 89 = 0 THEN 'bad-time'
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' END AS UtcTime,
  '{{' || substr(upper(md5(event_id::VARCHAR)), 1, 8) || '-' || substr(upper(md5(event_id::VARCHAR)), 9, 4)
    || '-' || substr(upper(md5(event_id::VARCHAR)), 13, 4) || '-' || substr(upper(md5(event_id::VARCHAR)), 17, 4)
    || '-' || substr(upper(md5(event_id::VARCHAR)), 21, 12) || '}}' AS ProcessGuid,
  (1000 + event_id % 64536)::INTEGER AS ProcessId,
  image AS Image,
  CASE WHEN event_id % 97 <> 0 OR event_id < n_docs + n_pages THEN {base('image')}
    || {listed([t[0] for t in B.TEMPLATES])}[t + 1]
    || CASE kind WHEN 'url' THEN p.url WHEN 'props' THEN props
         WHEN 'props64' THEN base64(encode(props)) WHEN 'doc' THEN d.text
         WHEN 'doc64' THEN base64(encode(d.text)) ELSE '' END
    || {listed([t[2] for t in B.TEMPLATES])}[t + 1] END AS CommandLine,
  parent AS ParentImage,
  CASE WHEN parent IS NOT NULL THEN {base('parent')} END AS ParentCommandLine,
  (1000 + (event_id * 31) % 64536)::INTEGER AS ParentProcessId,
  CASE WHEN user_id % 11 = 0 THEN 'NT AUTHORITY\\SYSTEM' WHEN user_id % 11 = 1 THEN 'corp\\svc-ecosystem'
       ELSE 'CORP\\User' || user_id END AS "User",
  {listed(B.INTEGRITY)}[user_id % {len(B.INTEGRITY)} + 1] AS IntegrityLevel,
  (event_type = 'error')::INTEGER AS is_malicious,
  CASE WHEN event_type = 'error' THEN {listed([t[0] for t in B.TECHNIQUES])}[event_id % 10 + 1] ELSE '' END
    AS mitre_technique_id,
  CASE WHEN event_type = 'error' THEN {listed([t[1] for t in B.TECHNIQUES])}[event_id % 10 + 1] ELSE '' END
    AS technique_name,
  CASE event_type WHEN 'error' THEN 'malicious' WHEN 'signup' THEN 'gray_area' ELSE 'benign' END AS label
FROM indexed i
LEFT JOIN pages p ON p.page_id = event_id % n_pages AND kind = 'url'
LEFT JOIN documents d ON d.doc_id = event_id % n_docs
  AND kind IN ('doc', 'doc64')"""

VIEWS["prepared"] = f"""
SELECT event_id, ProcessGuid, ProcessId, ParentProcessId, is_malicious, mitre_technique_id, technique_name, label,
  coalesce(UtcTime, '') AS UtcTime, coalesce(Image, '') AS Image, coalesce(CommandLine, '') AS CommandLine,
  coalesce(ParentImage, '') AS ParentImage, coalesce(ParentCommandLine, '') AS ParentCommandLine,
  coalesce("User", '') AS "User", coalesce(IntegrityLevel, '') AS IntegrityLevel,
  {name_of('Image')} AS child, {name_of('ParentImage')} AS parent,
  lower(coalesce(CommandLine, '')) AS cmd,
  try_cast(UtcTime AS TIMESTAMP) AS stamp
FROM process_events"""

# Coded column and the value it codes.
CODES = {"parent_process_name": "parent", "child_process_name": "child", "user_encoded": 'lower("User")'}


def codes(value: str) -> str:
    """Codes by first appearance."""
    return (f"SELECT v, row_number() OVER (ORDER BY first) - 1 AS code "
            f"FROM (SELECT {value} AS v, min(event_id) AS first FROM prepared GROUP BY 1)")


ARGS = f"list_filter(string_split_regex(cmd, {q(V.WHITESPACE_PATTERN)}), lambda a: a <> '')"
NEAR = V.SCRIPT_ENGINES + V.OFFICE_APPS + V.BROWSERS

# Feature expressions over ``prepared``.
FEATURES = {
    "is_known_lolbin": f"(child IN {names(V.KNOWN_BINARIES)})::INTEGER",
    "is_scripting_engine": f"(child IN {names(V.SCRIPT_ENGINES)})::INTEGER",
    "command_line_length": "length(CommandLine)::INTEGER",
    "command_line_entropy": "CASE WHEN CommandLine = '' THEN 0.0::DOUBLE ELSE " + rnd(
        "-list_sum(list_transform(list_distinct(string_split(CommandLine, '')), lambda ch: "
        "((length(CommandLine) - length(replace(CommandLine, ch, ''))) / length(CommandLine))"
        " * log2((length(CommandLine) - length(replace(CommandLine, ch, ''))) / length(CommandLine))))",
        4) + " + 0.0 END",
    "has_suspicious_flag": f"{any_in('cmd', V.SUSPICIOUS_FLAGS)}::INTEGER",
    "contains_url": "regexp_matches(CommandLine, '(?i)https?://')::INTEGER",
    "contains_ip_address": f"regexp_matches(CommandLine, {q(V.IP_PATTERN)})::INTEGER",
    "has_base64_pattern": f"regexp_matches(CommandLine, {q(V.BASE64_PATTERN)})::INTEGER",
    "argument_count": f"length({ARGS})::INTEGER",
    "suspicious_argument_ratio": f"CASE WHEN length({ARGS}) = 0 THEN 0.0::DOUBLE ELSE " + rnd(
        f"length(list_filter({ARGS}, lambda a: {any_in('a', V.SUSPICIOUS_FLAGS)})) / length({ARGS})", 4) + " END",
    "has_encoded_command": "(contains(cmd, '-enc ') OR contains(cmd, '-enc' || chr(9)) "
                           "OR ends_with(cmd, '-enc') OR contains(cmd, '-encodedcommand'))::INTEGER",
    "has_download_indicator": f"{any_in('cmd', V.DOWNLOAD_INDICATORS)}::INTEGER",
    "process_ancestry_depth": f"CASE WHEN parent IN {names(V.ROOT_PROCESSES)} THEN 1 "
                              f"WHEN parent IN {names(NEAR)} THEN 2 ELSE 3 END",
    "parent_is_office_app": f"(parent IN {names(V.OFFICE_APPS)})::INTEGER",
    "parent_is_browser": f"(parent IN {names(V.BROWSERS)})::INTEGER",
    "parent_is_script_engine": f"(parent IN {names(V.SCRIPT_ENGINES)})::INTEGER",
    "chain_hash": "('0x' || substr(md5(parent || '>' || child), 1, 8))::BIGINT",
    "hour_of_day": "coalesce(hour(stamp), 12)::INTEGER",
    "is_off_hours": "(coalesce(hour(stamp), 12) BETWEEN 0 AND 5)::INTEGER",
    "is_weekend": "coalesce(isodow(stamp) >= 6, false)::INTEGER",
    "minute_of_hour": "coalesce(minute(stamp), 0)::INTEGER",
    "is_system_user": "(contains(upper(\"User\"), 'NT AUTHORITY') OR contains(upper(\"User\"), 'SYSTEM'))::INTEGER",
    "integrity_encoded": "CASE IntegrityLevel WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 "
                         "WHEN 'System' THEN 3 ELSE 1 END",
}

VIEWS["row_features"] = "SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in FEATURES.items()) + " FROM prepared"

VIEWS["baseline"] = """
SELECT count(*) AS n, avg(command_line_length) AS lm, greatest(coalesce(stddev_samp(command_line_length), 0), 1.0) AS ls,
  avg(command_line_entropy) AS em, greatest(coalesce(stddev_samp(command_line_entropy), 0), 0.1) AS es
FROM row_features WHERE label = 'benign'"""

VIEWS["pairs"] = f"""
SELECT parent, child, count(*) AS n, count(*) / (SELECT n FROM baseline) AS freq,
  {rnd('-log10(greatest(count(*) / (SELECT n FROM baseline), 1e-10))', 4)} AS rarity
FROM row_features WHERE label = 'benign' GROUP BY parent, child"""

VIEWS["features"] = f"""
SELECT r.*, coalesce(p.rarity, (SELECT {rnd('max(-log10(greatest(freq, 1e-10))) + 1.0', 4)} FROM pairs))
    AS parent_child_pair_rarity,
  (command_line_length - lm) / ls AS command_length_zscore,
  (command_line_entropy - em) / es AS entropy_zscore
FROM row_features r LEFT JOIN pairs p USING (parent, child), baseline"""

# ---- rules, as their effective predicates -------------------------------
IMG, PAR, LINE = "lower(coalesce(Image, ''))", "lower(coalesce(ParentImage, ''))", "lower(coalesce(CommandLine, ''))"


def ends(column: str, values) -> str:
    return "(" + " OR ".join(f"ends_with({column}, {q(v.lower())})" for v in values) + ")"


def has(*values) -> str:
    return any_in(LINE, [v.lower() for v in values])


URLS = ("http://", "https://")
RULES = {
    "bitsadmin_download": f"{ends(IMG, [chr(92) + 'bitsadmin.exe'])} AND {has(*URLS)}",
    "certutil_download": f"{ends(IMG, [chr(92) + 'certutil.exe'])} AND {has('-urlcache', '/urlcache')} "
                         f"AND NOT {has('-verify', '-hashfile')}",
    "certutil_encode_decode": f"{ends(IMG, [chr(92) + 'certutil.exe'])} "
                              f"AND {has('-decode', '-encode', '/decode', '/encode')}",
    "msbuild_execution": f"{ends(IMG, [chr(92) + 'msbuild.exe'])} AND " + has(
        "\\users\\public\\", "\\temp\\", "\\appdata\\", "\\downloads\\"),
    "mshta_remote_hta": f"{ends(IMG, [chr(92) + 'mshta.exe'])} AND {has(*URLS, 'vbscript:', 'javascript:')}",
    "office_spawns_shell": ends(PAR, ["\\winword.exe", "\\excel.exe", "\\powerpnt.exe", "\\outlook.exe"])
    + " AND " + ends(IMG, ["\\cmd.exe", "\\powershell.exe", "\\wscript.exe", "\\cscript.exe", "\\mshta.exe"]),
    "powershell_encoded": f"{ends(IMG, [chr(92) + 'powershell.exe'])} "
                          f"AND {has('-enc ', '-encodedcommand', '-ec ', '-nop', '-noprofile')}",
    "regsvr32_squiblydoo": f"{ends(IMG, [chr(92) + 'regsvr32.exe'])} AND {has('/i:http', '/i:https', 'scrobj.dll')}",
    "rundll32_javascript": f"{ends(IMG, [chr(92) + 'rundll32.exe'])} "
                           f"AND {has('javascript:', 'vbscript:', 'runhtmlapplication')}",
    "wscript_remote": f"{ends(IMG, [chr(92) + 'wscript.exe', chr(92) + 'cscript.exe'])} "
                      f"AND {has(*URLS, '//e:jscript', '//e:vbscript')}",
}


def techniques(tags) -> str:
    return ", ".join(t for t in tags if t.startswith("attack.t"))


VIEWS["rules"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {q(r['title'])}, {q(r['id'])}, {q(r['level'])}, {V.SEVERITY[r['level']]}, {q(techniques(r['tags']))}, "
    f"{q(r['filename'])}, {q(r['description'])})" for i, r in enumerate(V.RULES)
) + ") v(ord, title, id, level, severity, tags, filename, description)"

VIEWS["hits"] = " UNION ALL ".join(
    f"SELECT event_id, {i} AS ord FROM process_events WHERE {RULES[r['filename'][:-4]]}"
    for i, r in enumerate(V.RULES))

VIEWS["best"] = """
SELECT event_id, arg_min(title, -severity * 1000 + ord) AS title, arg_min(level, -severity * 1000 + ord) AS level,
  arg_min(tags, -severity * 1000 + ord) AS tags FROM hits JOIN rules USING (ord) GROUP BY event_id"""

VIEWS["matched"] = """
SELECT e.event_id, e.label, b.event_id IS NOT NULL AS sigma_match, coalesce(b.title, 'None') AS sigma_rule_name,
  coalesce(b.level, 'none') AS sigma_level, coalesce(b.tags, '') AS sigma_mitre_tags
FROM process_events e LEFT JOIN best b USING (event_id)"""

# ---- chains -------------------------------------------------------------
VIEWS["suspicious"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({q(p)}, {q(c)}, {s}, {q(d)})" for p, c, s, d in V.SUSPICIOUS_PAIRS) + ") v(parent, child, score, descr)"

VIEWS["chain_parts"] = f"""
SELECT e.*, s.score AS pair_score, s.descr,
  coalesce(parent IN {names(V.OFFICE_APPS)} AND child IN {names(V.SCRIPT_ENGINES)}, false) AS m0,
  regexp_matches(cmd, 'https?://') AS m1,
  child IN {names(V.CHAIN_BINARIES)} AND s.score IS NULL AS m2,
  coalesce(hour(stamp) BETWEEN 0 AND 5, false) AS m3,
  {any_in('cmd', ['-enc ', '-encodedcommand'])} AS m4,
  {any_in('cmd', V.CHAIN_FLAGS)} AS m5
FROM prepared e LEFT JOIN suspicious s USING (parent, child)"""

VIEWS["chains"] = """
SELECT event_id, label, parent, child, m0, m1, m2, m3, m4, m5, pair_score, descr,
  least(coalesce(pair_score, 0) + 20 * m0::INT + 15 * m1::INT + 10 * m2::INT + 10 * m3::INT + 10 * m4::INT
    + 5 * m5::INT, 100)::INTEGER AS chain_risk_score,
  parent || ' → ' || child || ': ' || coalesce(descr, 'No known suspicious pattern')
    || CASE WHEN m0 OR m1 OR m2 OR m3 OR m4 OR m5 THEN ' [Modifiers: ' || concat_ws(', ',
         CASE WHEN m0 THEN '+20 Office→Script chain' END, CASE WHEN m1 THEN '+15 URL in command' END,
         CASE WHEN m2 THEN '+10 LOLBin child' END, CASE WHEN m3 THEN '+10 off-hours' END,
         CASE WHEN m4 THEN '+10 encoded command' END, CASE WHEN m5 THEN '+5 suspicious flags' END) || ']'
       ELSE '' END AS chain_description,
  pair_score IS NOT NULL AS chain_matched_pattern
FROM chain_parts"""

# ---- model with the kernel-mean boundary --------------------------------
MODEL_D = 128
_dirs = make_directions(len(V.MODEL_COLUMNS), MODEL_D)

VIEWS["directions"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({j}, [{', '.join(repr(float(v)) for v in _dirs.directions[:, j])}]::DOUBLE[], {float(_dirs.phases[j])!r}::DOUBLE)"
    for j in range(MODEL_D)) + ") v(j, w, b)"

VIEWS["fstats"] = "SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}, min({c}) AS l_{c}, max({c}) AS h_{c}"
    for c in V.MODEL_COLUMNS) + " FROM features WHERE label = 'benign'"

SCALED = {c: f"({c} - m_{c}) / (CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END)" for c in V.MODEL_COLUMNS}
VIEWS["scaled"] = "SELECT event_id, label, [" + ", ".join(SCALED.values()) + "]::DOUBLE[] AS x FROM features, fstats"

VIEWS["lifted"] = f"""
SELECT event_id, label, j, sqrt(2.0 / {MODEL_D}) * cos(list_dot_product(x, w) + b) AS z
FROM scaled CROSS JOIN directions"""
VIEWS["kernel_mean"] = "SELECT j, avg(z) AS w FROM lifted WHERE label = 'benign' GROUP BY j"
VIEWS["raw_scores"] = """
SELECT event_id, any_value(label) AS label, -sum(z * w) AS raw FROM lifted JOIN kernel_mean USING (j) GROUP BY event_id"""
VIEWS["score_range"] = "SELECT min(raw) AS lo, max(raw) AS hi FROM raw_scores WHERE label = 'benign'"
VIEWS["scores"] = f"""
SELECT event_id, {rnd('greatest(0.0, least(100.0, (raw - lo) / greatest(hi - lo, 0.001) * 100.0))')} AS ml_anomaly_score
FROM raw_scores, score_range"""

VIEWS["deviations"] = "\nUNION ALL ".join(
    f"SELECT event_id, {i} AS i, {c}::DOUBLE AS v, m_{c} AS m, greatest(s_{c}, 0.001) AS s, "
    f"{q(V.FEATURE_DESCRIPTIONS.get(c, c))} AS d FROM features, fstats" for i, c in enumerate(V.MODEL_COLUMNS))
VIEWS["factors"] = f"""
SELECT event_id, string_agg(printf('%s: %.2f (baseline: %.2f±%.2f, z=%.1f)', d, {rnd('v', 2)}, {rnd('m', 2)} + 0.0,
    {rnd('s', 2)}, {rnd('z', 1)}), '; ' ORDER BY z DESC, i) AS told
FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY z DESC, i) AS rn
      FROM (SELECT *, {rnd('abs((v - m) / s)', 9)} AS z FROM deviations WHERE abs((v - m) / s) > 2.0))
WHERE rn <= 5 GROUP BY event_id"""
VIEWS["explained"] = f"""
SELECT s.event_id, printf('ANOMALY SCORE: %.0f/100', {rnd('ml_anomaly_score', 0)})
  || CASE WHEN told IS NULL THEN ' | No significantly unusual features detected.'
          ELSE ' | Unusual factors: ' || told END AS explanation
FROM scores s LEFT JOIN factors f USING (event_id)"""

# ---- the three trained models --------------------------------------------
# Draws and splits are MD5 of names, so the same trees grow here.
def chance(*name: str) -> str:
    joined = " || ':' || ".join(name)
    return f"(('0x' || substr(md5({joined}), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def drawn(name: str, wanted: int, n: str) -> str:
    """Whether a row is among about ``wanted`` of ``n``, by the hash of a name."""
    limit = f"ceil({forest.HASH_SPACE}::DOUBLE * ({wanted}::DOUBLE / {n}))::BIGINT"
    return f"({n} <= {wanted} OR substr(md5({name}), 1, 10) < printf('%010x', {limit}))"


def path_of(n: str) -> str:
    return (f"CASE WHEN {n} <= 1 THEN 0.0::DOUBLE WHEN {n} = 2 THEN 1.0::DOUBLE "
            f"ELSE 2.0::DOUBLE * (ln({n} - 1.0::DOUBLE) + {forest.EULER}::DOUBLE) - 2.0::DOUBLE * ({n} - 1.0::DOUBLE) / {n} END")


DEPTH = (V.FOREST_SAMPLE - 1).bit_length()
SCORE_DIGITS = 4  # of scores of trained models
VIEWS["benign_rows"] = "SELECT event_id, x, count(*) OVER () AS n FROM scaled WHERE label = 'benign'"
VIEWS["forest_pool"] = "SELECT event_id, x, n FROM benign_rows WHERE " + drawn(
    f"'pool:{V.SEED}:' || event_id", V.FOREST_SAMPLE * forest.POOL_SAMPLES, "n")
# The models of the ensemble are fitted on all benign rows.
EVERY_ROW = {"forest_pool": "SELECT event_id, x, n FROM benign_rows", "reference_rows": "SELECT event_id, x FROM benign_rows"}
VIEWS["forest_values"] = f"""
SELECT event_id, unnest(range({len(V.MODEL_COLUMNS)})) AS f, unnest(x) AS v FROM forest_pool"""
VIEWS["members_0"] = f"""
SELECT tree, event_id, 1 AS node FROM (
  SELECT tree, event_id, row_number() OVER (
    PARTITION BY tree ORDER BY substr(md5('{V.SEED}:' || tree || ':' || event_id), 1, 10), event_id) AS place
  FROM forest_pool, (SELECT unnest(range({V.FOREST_TREES})) AS tree))
WHERE place <= {V.FOREST_SAMPLE}"""
for _d in range(DEPTH):
    VIEWS[f"spreads_{_d}"] = f"""
SELECT tree, node, f, min(v) AS low, max(v) AS high FROM members_{_d} JOIN forest_values USING (event_id)
GROUP BY tree, node, f HAVING max(v) > min(v)"""
    VIEWS[f"splits_{_d}"] = f"""
SELECT tree, node, f, low + {chance(f"'{V.SEED}'", 'tree', 'node', "'cut'")} * (high - low) AS cut FROM (
  SELECT *, row_number() OVER (PARTITION BY tree, node ORDER BY f) - 1 AS place, count(*) OVER (PARTITION BY tree, node) AS m
  FROM spreads_{_d})
WHERE place = floor({chance(f"'{V.SEED}'", 'tree', 'node', "'feature'")} * m)
  AND {_d} < (SELECT ceil(log2(greatest(least({V.FOREST_SAMPLE}, any_value(n)), 2))) FROM benign_rows)"""
    VIEWS[f"members_{_d + 1}"] = f"""
SELECT tree, event_id, 2 * node + (v > cut)::INTEGER AS node
FROM members_{_d} JOIN splits_{_d} USING (tree, node) JOIN forest_values USING (event_id, f)"""
VIEWS["forest_nodes"] = "\nUNION ALL ".join(
    [f"SELECT tree, node, f, cut, 0.0::DOUBLE AS path FROM splits_{d}" for d in range(DEPTH)]
    + [f"SELECT tree, node, -1 AS f, 0.0::DOUBLE AS cut, {d} + {path_of('count(*)')} AS path FROM members_{d} "
       + (f"ANTI JOIN splits_{d} USING (tree, node) " if d < DEPTH else "") + "GROUP BY tree, node"
       for d in range(DEPTH + 1)])
VIEWS["walk_0"] = f"SELECT event_id, tree, 1 AS node FROM scaled, (SELECT unnest(range({V.FOREST_TREES})) AS tree)"
for _d in range(DEPTH):
    VIEWS[f"walk_{_d + 1}"] = f"""
SELECT event_id, tree, CASE WHEN f < 0 THEN node ELSE 2 * node + (x[f + 1] > cut)::INTEGER END AS node
FROM walk_{_d} JOIN forest_nodes USING (tree, node) JOIN scaled USING (event_id)"""
VIEWS["forest_raw"] = f"""
SELECT event_id, pow(2.0::DOUBLE, -(sum(path) / {V.FOREST_TREES})
  / (SELECT {path_of(f'least({V.FOREST_SAMPLE}, any_value(n))')} FROM benign_rows)) AS raw
FROM walk_{DEPTH} JOIN forest_nodes USING (tree, node) GROUP BY event_id"""

K = V.LOF_NEIGHBOURS
VIEWS["reference_rows"] = "SELECT event_id, x FROM benign_rows WHERE " + drawn(
    "'density:' || event_id", neighbours.REFERENCE_ROWS, "n")
VIEWS["refs"] = "SELECT x, min(event_id) AS vid, count(*) AS copies FROM reference_rows GROUP BY x"
VIEWS["lof_k"] = f"SELECT greatest(1, least({K}, sum(copies) - 1))::INTEGER AS k FROM refs"


def near(queries: str, key: str, more: int) -> str:
    """The nearest vectors of the reference, by (distance, vid)."""
    return f"""
SELECT qid, unnest(found, recursive := true) FROM (
  SELECT q.{key} AS qid, min({{'dist': {rnd('list_distance(q.x, r.x)', neighbours.DIGITS)}, 'vid': r.vid, 'copies': r.copies}},
    {K + more}) AS found FROM {queries} q, refs r GROUP BY q.{key})"""


def taken(pairs: str, copies: str) -> str:
    """How many copies of each neighbour are among the k nearest points."""
    return f"""
SELECT qid, vid, dist, least(copies, k - before) AS take FROM (
  SELECT qid, vid, dist, copies, coalesce(sum(copies) OVER (
    PARTITION BY qid ORDER BY dist, vid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM (SELECT qid, vid, dist, {copies} AS copies FROM {pairs}) WHERE copies > 0), lof_k
WHERE before < k"""


DENSITY = f"1.0::DOUBLE / (sum(take * greatest(dist, kdist)) / any_value(k) + {neighbours.DENSITY_FLOOR}::DOUBLE)"
VIEWS["ref_near"] = near("refs", "vid", 1)
VIEWS["ref_taken"] = taken("ref_near", "copies - (qid = vid)::INTEGER")
VIEWS["kdists"] = "SELECT qid AS vid, max(dist) AS kdist FROM ref_taken GROUP BY qid"
VIEWS["densities"] = f"""
SELECT qid AS vid, {DENSITY} AS density FROM ref_taken JOIN kdists USING (vid), lof_k GROUP BY qid"""
VIEWS["event_near"] = near("scaled", "event_id", 0)
VIEWS["event_taken"] = taken("event_near", "copies")
VIEWS["lof_raw"] = f"""
SELECT qid AS event_id, sum(take * density) / any_value(k) / ({DENSITY}) AS raw
FROM event_taken JOIN kdists USING (vid) JOIN densities USING (vid), lof_k GROUP BY qid"""

BINS, STEPS, SPAN = boundary.BINS, boundary.STEPS, boundary.SPAN
VIEWS["benign_lifted"] = "SELECT event_id, j, z FROM lifted WHERE label = 'benign'"
VIEWS["weights_0"] = "SELECT j, avg(z) AS w, true AS live FROM benign_lifted GROUP BY j"
for _t in range(STEPS):
    VIEWS[f"bins_{_t}"] = f"""
SELECT event_id, least({BINS - 1}, floor((greatest(-{SPAN}::DOUBLE, least({SPAN}::DOUBLE, {rnd('sum(z * w)', boundary.DIGITS)}))
  + {SPAN}::DOUBLE) / {2 * SPAN}::DOUBLE * {BINS}))::INTEGER AS bin
FROM benign_lifted JOIN weights_{_t} USING (j) GROUP BY event_id"""
    VIEWS[f"shares_{_t}"] = f"""
SELECT bin, c, greatest(0.0::DOUBLE, least(1.0::DOUBLE, ({V.BOUNDARY_NU}::DOUBLE * sum(c) OVER ()
  - (sum(c) OVER (ORDER BY bin) - c)) / c)) AS part
FROM (SELECT bin, count(*) AS c FROM bins_{_t} GROUP BY bin)"""
    VIEWS[f"lowest_{_t}"] = f"""
SELECT j, sum(part * z) / (SELECT sum(part * c) FROM shares_{_t}) AS l
FROM benign_lifted JOIN bins_{_t} USING (event_id) JOIN shares_{_t} USING (bin) WHERE part > 0 GROUP BY j"""
    VIEWS[f"weights_{_t + 1}"] = f"""
SELECT j, CASE WHEN live THEN w + move ELSE w END AS w, live AND sqrt(sum(move * move) OVER ())
  > {boundary.TOLERANCE}::DOUBLE * sqrt(sum((w + move) * (w + move)) OVER ()) AS live
FROM (SELECT j, w, live, (l - w) / {_t + 2}::DOUBLE AS move FROM weights_{_t} JOIN lowest_{_t} USING (j))"""
VIEWS["boundary_raw"] = f"SELECT event_id, -sum(z * w) AS raw FROM lifted JOIN weights_{STEPS} USING (j) GROUP BY event_id"

for _part, _known in [("forest", "benign_rows"), ("lof", "reference_rows"), ("boundary", "benign_rows")]:
    VIEWS[f"{_part}_placed"] = f"""
SELECT event_id, greatest(0.0::DOUBLE, least(100.0::DOUBLE, (raw - low) / greatest(high - low, 0.001::DOUBLE) * 100.0::DOUBLE))
  AS score FROM {_part}_raw, (SELECT min(raw) AS low, max(raw) AS high FROM {_part}_raw SEMI JOIN {_known} USING (event_id))"""
VIEWS["all_scores"] = f"""
SELECT event_id, {rnd(' + '.join(f"{w}::DOUBLE * {p}_placed.score" for p, w in V.WEIGHTS.items()), SCORE_DIGITS)}
  AS ml_anomaly_score FROM forest_placed JOIN lof_placed USING (event_id) JOIN boundary_placed USING (event_id)"""


def part_score(part: str) -> str:
    """Scores of one trained model by itself."""
    return (f"SELECT event_id, label, {rnd('score', SCORE_DIGITS)} AS ml_anomaly_score "
            f"FROM {part}_placed JOIN scaled USING (event_id)")


# ---- fusion -------------------------------------------------------------
def ladder(a, b, c, d, e) -> str:
    return (f"CASE WHEN sigma_match THEN {a} WHEN chain_risk_score > 60 AND ml_anomaly_score > 70 THEN {b} "
            f"WHEN ml_anomaly_score > 70 THEN {c} WHEN chain_risk_score > 60 THEN {d} ELSE {e} END")


VIEWS["layered"] = """
SELECT f.*, m.sigma_match, m.sigma_rule_name, m.sigma_level, m.sigma_mitre_tags, s.ml_anomaly_score,
  c.chain_risk_score, c.chain_description, c.chain_matched_pattern
FROM features f JOIN matched m USING (event_id) JOIN scores s USING (event_id) JOIN chains c USING (event_id)"""

VIEWS["detected"] = f"""
SELECT l.*, {ladder("'ALERT'", "'ALERT'", "'ALERT'", "'REVIEW'", "'CLEAR'")} AS final_verdict,
  {ladder("'CRITICAL'", "'HIGH'", "'MEDIUM'", "'LOW'", "'NONE'")} AS priority,
  {rnd(ladder('least(90 + ml_anomaly_score / 10, 100.0)',
              '75 + least((ml_anomaly_score - 70) / 3 + (chain_risk_score - 60)::DOUBLE / 4, 14.0)',
              '50 + least((ml_anomaly_score - 70) / 1.5::DOUBLE, 24.0)',
              '30 + least((chain_risk_score - 60)::DOUBLE / 2, 19.0)',
              'greatest(0.0, ml_anomaly_score / 3)'), 1)} AS confidence
FROM layered l"""

VIEWS["reasoned"] = "SELECT d.*, " + ladder(
    "printf('Sigma rule matched: %s | ML Score: %.0f | Chain Risk: %.0f', sigma_rule_name, "
    f"{rnd('ml_anomaly_score', 0)}, chain_risk_score::DOUBLE)",
    f"printf('Chain + ML anomaly detected | ML Score: %.0f | Chain: %s', {rnd('ml_anomaly_score', 0)}, chain_description)",
    "x.explanation", "'Suspicious chain detected | Chain: ' || chain_description", "''"
) + " AS explanation FROM detected d LEFT JOIN explained x USING (event_id)"

FLAGGED = "final_verdict IN ('ALERT', 'REVIEW')"
LAYER_HITS = {"sigma": "sigma_match", "ml": "ml_anomaly_score > 70", "chain": "chain_risk_score > 60",
              "combined": FLAGGED}
VIEWS["confusion"] = "\nUNION ALL ".join(
    f"SELECT '{layer}' AS layer, count(*) FILTER (is_malicious = 1 AND {h}) AS tp, "
    f"count(*) FILTER (is_malicious = 0 AND {h}) AS fp, count(*) FILTER (is_malicious = 1 AND NOT ({h})) AS fn, "
    f"count(*) FILTER (is_malicious = 0 AND NOT ({h})) AS tn FROM detected" for layer, h in LAYER_HITS.items())
VIEWS["metrics"] = f"""
SELECT layer, {rnd('p', 4)} AS precision, {rnd('r', 4)} AS recall,
  {rnd('2.0::DOUBLE * p * r / greatest(p + r, 0.001::DOUBLE)', 4)} AS f1, {rnd('fp / greatest(fp + tn, 1)', 4)} AS fpr, tp, fp, fn, tn
FROM (SELECT *, tp / greatest(tp + fp, 1) AS p, tp / greatest(tp + fn, 1) AS r FROM confusion)"""
VIEWS["roc"] = """
SELECT score, pos, neg, sum(pos) OVER w::BIGINT AS tp, sum(neg) OVER w::BIGINT AS fp
FROM (SELECT ml_anomaly_score AS score, count(*) FILTER (is_malicious = 1) AS pos,
        count(*) FILTER (is_malicious = 0) AS neg FROM detected GROUP BY 1)
WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)"""
VIEWS["rates"] = """
SELECT *, tp / greatest((SELECT sum(pos) FROM roc), 1) AS tpr, fp / greatest((SELECT sum(neg) FROM roc), 1) AS fpr FROM roc"""

def _with_all_models(name: str) -> str:
    """A view of the fused results, on the scores of all three models."""
    text = VIEWS[name]
    for word in ("scores", "explained", "layered", "detected"):
        text = re.sub(rf"\b(FROM|JOIN) {word}\b", rf"\1 all_{word}", text)
    return text


for _name in ("explained", "layered", "detected", "reasoned"):
    VIEWS[f"all_{_name}"] = _with_all_models(_name)

_WORDS = {name: re.compile(rf"\b{name}\b") for name in VIEWS}


def sql(body: str, every_document: bool = False, every_row: bool = False) -> str:
    """``body`` with the views it needs, each computed once."""
    needed: set[str] = set()
    views = VIEWS | (EVERY_DOCUMENT if every_document else {}) | (EVERY_ROW if every_row else {})

    def visit(text: str) -> None:
        for name, word in _WORDS.items():
            if name not in needed and word.search(_no_strings(text)):
                needed.add(name)
                visit(views[name])

    visit(body)
    parts = [f"{n} AS MATERIALIZED ({views[n]})" for n in views if n in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def _no_strings(text: str) -> str:
    return re.sub(r"'(?:[^']|'')*'", "''", text)
