"""The 29 behavioural features of a process event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procwarden import fixed_values as V
from procwarden.functions import text as X
from procwarden.functions import timeparts as T
from procwarden.operators.baseline import Baseline
from procwarden.operators.clean import drop_helpers, prepare
from procwarden.operators.encoders import Encoder, encode
from procwarden.operators.lookup import lookup_join


NEAR = V.SCRIPT_ENGINES + V.OFFICE_APPS + V.BROWSERS
TIME = "_time"  # helper column: the time text, read once
CODES = " ".join(f"WHEN {X.quoted(k)} THEN {v}" for k, v in V.INTEGRITY_CODES.items())

# Features of one row alone, as SQL over the prepared columns, or as a function that gives a column.
ROW_FEATURES = {
    "is_known_lolbin": X.flag(f"_child IN {X.name_list(V.KNOWN_BINARIES)}"),
    "is_scripting_engine": X.flag(f"_child IN {X.name_list(V.SCRIPT_ENGINES)}"),
    "command_line_length": "length(CommandLine)",
    "command_line_entropy": lambda: X.shannon_entropy("CommandLine"),
    "has_suspicious_flag": lambda: X.matched("_cmd", X.any_of(V.SUSPICIOUS_FLAGS)),
    "contains_url": lambda: X.matched("_cmd", V.URL_PATTERN.removeprefix("(?i)")),  # no wide letter is lowered to one of these
    "contains_ip_address": lambda: X.ip_address("CommandLine", V.IP_PATTERN),
    "has_base64_pattern": lambda: X.matched("CommandLine", V.BASE64_PATTERN),
    "argument_count": lambda: X.argument_count("CommandLine"),
    "suspicious_argument_ratio": lambda: X.flagged_share("_cmd"),
    "has_encoded_command": lambda: X.matched(
        "_cmd", X.any_of(["-enc ", "-enc\t", "-encodedcommand"]) + r"|-enc\z"),
    "has_download_indicator": lambda: X.matched("_cmd", X.any_of(V.DOWNLOAD_INDICATORS)),
    "process_ancestry_depth": f"CASE WHEN _parent IN {X.name_list(V.ROOT_PROCESSES)} THEN 1 "
                              f"WHEN _parent IN {X.name_list(NEAR)} THEN 2 ELSE 3 END",
    "parent_is_office_app": X.flag(f"_parent IN {X.name_list(V.OFFICE_APPS)}"),
    "parent_is_browser": X.flag(f"_parent IN {X.name_list(V.BROWSERS)}"),
    "parent_is_script_engine": X.flag(f"_parent IN {X.name_list(V.SCRIPT_ENGINES)}"),
    "chain_hash": "cast(conv(substring(md5(cast(concat(_parent, '>', _child) AS binary)), 1, 8), 16, 10) AS bigint)",
    "hour_of_day": T.hour_of_day(TIME),
    "is_off_hours": X.flag(f"{T.hour_of_day('UtcTime')} BETWEEN 0 AND 5"),
    "is_weekend": T.is_weekend(TIME),
    "minute_of_hour": T.minute_of_hour(TIME),
    "is_system_user": X.flag(X.contains_any("upper(User)", ["NT AUTHORITY", "SYSTEM"])),
    "integrity_encoded": f"CASE IntegrityLevel {CODES} ELSE {V.INTEGRITY_DEFAULT} END",
}


def row_features(prepared: DataFrame, names: list[str] | None = None, more: dict | None = None) -> DataFrame:
    """Add row features; ``more`` are further columns, given alike, that are made in the same pass over the texts."""
    made = {n: ROW_FEATURES[n] for n in names or ROW_FEATURES} | (more or {})
    timed = any(isinstance(f, str) and TIME in f for f in made.values())
    rows = prepared.withColumn(TIME, X.col("try_to_timestamp(UtcTime)")) if timed else prepared
    return rows.withColumns({n: f() if callable(f) else X.col(f) for n, f in made.items()}).drop(TIME)


def pair_rarity(prepared: DataFrame, baseline: Baseline) -> DataFrame:
    """Rarity of the pair; unseen pairs get one more than the rarest seen."""
    if baseline.pairs is None:
        return prepared.withColumn("parent_child_pair_rarity", F.lit(0.0))
    known = baseline.pairs.select(
        F.col("parent").alias("_parent"), F.col("child").alias("_child"), "rarity")
    return (
        lookup_join(prepared, known, ["_parent", "_child"], baseline.n_pairs)
        .withColumn("parent_child_pair_rarity",
                    F.coalesce("rarity", F.lit(baseline.unseen_rarity)))
        .drop("rarity"))


def zscores(df: DataFrame, baseline: Baseline) -> DataFrame:
    def z(c: str, mean: float, std: float):
        return (F.col(c) - F.lit(float(mean))) / F.lit(float(std))

    return df.withColumns({
        "command_length_zscore": z("command_line_length", baseline.length_mean, baseline.length_std),
        "entropy_zscore": z("command_line_entropy", baseline.entropy_mean, baseline.entropy_std),
    })


# Coded column, value column and encoder name of the three label encodings.
CODED = [
    ("parent_process_name", "_parent", "parent_process"),
    ("child_process_name", "_child", "child_process"),
    ("user_encoded", "_user", "user"),
]


def label_codes(prepared: DataFrame, encoders: dict[str, Encoder]) -> DataFrame:
    """Add the label codes; ``_user`` is taken from the events if it is not there yet."""
    df = prepared if "_user" in prepared.columns else prepared.withColumn("_user", F.lower("User"))
    for name, value, encoder in CODED:
        df = encode(df, value, encoders[encoder], name)
    return df.drop("_user")


def relative_features(rows: DataFrame, baseline: Baseline) -> DataFrame:
    """Add what depends on the baseline to rows that have names and row features."""
    return zscores(pair_rarity(rows, baseline), baseline)


def model_features(events: DataFrame, baseline: Baseline, more: dict | None = None) -> DataFrame:
    """All features but the three label codes, which no model reads; ``more`` as in ``row_features``.

    No shuffle while the pair table is small enough to broadcast.
    """
    return relative_features(row_features(prepare(events), more=more), baseline)


def extract_features(events: DataFrame, baseline: Baseline | None = None,
                     encoders: dict[str, Encoder] | None = None) -> DataFrame:
    """Events with all 29 features; label codes only when encoders are given."""
    df = model_features(events, baseline or Baseline())
    if encoders:
        df = label_codes(df, encoders)
    return drop_helpers(df)


def model_matrix(df: DataFrame) -> DataFrame:
    """The model columns that are present, as clean doubles; error when none is."""
    present = [c for c in V.MODEL_COLUMNS if c in df.columns]
    if not present:
        raise ValueError(f"no model column found, expected some of {V.MODEL_COLUMNS[:5]}")
    return df.withColumns({c: X.col(clean_number(c)) for c in present})


def clean_number(c: str) -> str:
    """Missing and infinite values become 0: only a finite number times 0 is 0."""
    d = f"cast({c} AS double)"
    return f"CASE WHEN {d} * 0D = 0D THEN {d} ELSE 0D END"
