"""The whole detection as one plan.

``event_facts`` derives from an event all that it tells by itself: features, rule match,
chain risk.  Fitting and detecting go on from these facts and never read a text again.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procwarden.fixed_values import MODEL_COLUMNS
from procwarden.operators.baseline import Baseline, fit_baseline_rows
from procwarden.operators.chains import TESTS, chain_codes, told_chains
from procwarden.operators.clean import benign_only, drop_helpers, prepare
from procwarden.operators.ensemble import PARTS, Model, explanation, fit_model, score
from procwarden.operators.encoders import Encoder, fit_encoders
from procwarden.operators.features import CODED, ROW_FEATURES, label_codes, relative_features, row_features
from procwarden.operators.fusion import fuse
from procwarden.operators.rules import NO_MATCH, Rule, apply_rules
from procwarden.schema import EVENT_KEY
from procwarden.session import cut_lineage

CHAIN_COLUMNS = ["chain_risk_score", "chain_description", "chain_matched_pattern"]


@dataclass
class Artefacts:
    """What is fitted on the benign baseline and reused on every later table."""

    baseline: Baseline
    model: Model
    encoders: dict[str, Encoder] | None = None


def event_facts(events: DataFrame, rules: list[Rule] | None = None, duplicate_keys: str = "last",
                keep: Iterable[str] | None = None, layers: bool = True) -> DataFrame:
    """One row per event: the columns to ``keep`` (None: all), names and row features.

    With ``layers`` also rule match and the code of the chain, which ``detect_facts`` spells out.
    """
    df = row_features(prepare(events), more=TESTS if layers else None)
    made = [EVENT_KEY, "_parent", "_child", "_user", *ROW_FEATURES]
    if layers:
        df = chain_codes(apply_rules(df, rules, duplicate_keys))
        made += [*NO_MATCH, "_chain"]
    kept = [c for c in (events.columns if keep is None else keep) if c not in [*made, *CHAIN_COLUMNS]]
    return df.withColumn("_user", F.lower("User")).select(*[F.col(f"`{c}`") for c in kept], *made)


def fit_facts(facts: DataFrame, parts: tuple[str, ...] = PARTS, codes: bool = False, **options) -> Artefacts:
    """Baseline and ensemble from the benign facts; with ``codes`` label encoders from all of them."""
    benign = benign_only(facts)
    baseline = fit_baseline_rows(benign)
    inputs = [options.get("order", EVENT_KEY), *MODEL_COLUMNS]
    model = fit_model(relative_features(benign, baseline).select(*inputs), parts, **options)
    return Artefacts(baseline, model, fit_label_codes(facts) if codes else None)


def fit_label_codes(facts: DataFrame) -> dict[str, Encoder]:
    return fit_encoders(facts, {encoder: value for _, value, encoder in CODED})


def detect_facts(facts: DataFrame, artefacts: Artefacts) -> DataFrame:
    """Score, codes and fused verdict of event facts with all layers."""
    df = relative_features(told_chains(facts), artefacts.baseline)
    if artefacts.encoders:
        df = label_codes(df, artefacts.encoders)
    df = score(df, artefacts.model)
    told = explanation(artefacts.model.stats, df.columns, "ml_anomaly_score")
    return drop_helpers(fuse(df, told)).drop("_user")


def fit(benign: DataFrame, parts: tuple[str, ...] = PARTS, **options) -> Artefacts:
    """Baseline and ensemble from benign events, whose texts are read once."""
    return fit_facts(cut_lineage(event_facts(benign, keep=["label"], layers=False)), parts, **options)


def detect(events: DataFrame, artefacts: Artefacts, rules: list[Rule] | None = None,
           duplicate_keys: str = "last", encoders: dict[str, Encoder] | None = None) -> DataFrame:
    """Events with features, rule match, score, chain risk and fused verdict."""
    if encoders:
        artefacts = Artefacts(artefacts.baseline, artefacts.model, encoders)
    return detect_facts(event_facts(events, rules, duplicate_keys), artefacts)


def run(events: DataFrame, parts: tuple[str, ...] = PARTS, rules: list[Rule] | None = None,
        duplicate_keys: str = "last", keep: Iterable[str] | None = None, codes: bool = True, **options) -> DataFrame:
    """Fit on the benign rows of the events, then detect on all of them.

    The events are read once: their facts are written as one table, on which both work.
    ``keep`` names the event columns that the result holds (``label`` is always one; None:
    all), ``codes`` asks for the three label codes, which complete the 29 features.
    """
    kept = events.columns if keep is None else list(dict.fromkeys([*keep, "label"]))
    facts = cut_lineage(event_facts(events, rules, duplicate_keys, kept))
    return detect_facts(facts, fit_facts(facts, parts, codes, **options))
