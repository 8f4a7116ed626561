"""Detection rules compiled to boolean columns.

A rule is compiled once, on the driver, to one expression; matching a table is
a projection, without joins or Python in the tasks.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from procwarden.fixed_values import RULES, SEVERITY
from procwarden.functions.text import quoted
from procwarden.operators.clean import HELPERS

log = logging.getLogger(__name__)
TECHNIQUE_PREFIX = "attack.t"
LOWERED = "_lower_"  # before a field's name: the field in lower case
CHUNK = 50  # rules of one CASE
NO_MATCH = {"sigma_match": False, "sigma_rule_name": "None",
            "sigma_level": "none", "sigma_mitre_tags": ""}


@dataclass
class Rule:
    title: str
    id: str = ""
    level: str = "medium"
    tags: list = field(default_factory=list)
    description: str = ""
    filename: str = ""
    blocks: dict = field(default_factory=dict)  # name -> [(field key, values)]
    condition: str = "selection"

    @property
    def techniques(self) -> list[str]:
        return [t for t in self.tags if t.startswith(TECHNIQUE_PREFIX)]

    @property
    def severity(self) -> int:
        return SEVERITY.get(self.level, 0)


def parse_rule(doc: dict, filename: str = "") -> Rule:
    """A rule from its document.

    ``detection`` and its blocks may be mappings or lists of pairs; the latter
    can hold a key twice.  A block that is neither is refused: read literally
    it would be an empty conjunction that matches every event.
    """
    def items(x):
        return list(x.items()) if isinstance(x, dict) else [tuple(p) for p in x]

    blocks, condition = {}, "selection"
    for name, body in items(doc["detection"]):
        if name == "condition":
            condition = body
            continue
        pairs = isinstance(body, list) and all(
            isinstance(p, (list, tuple)) and len(p) == 2 for p in body)
        if not isinstance(body, dict) and not pairs:
            raise ValueError(f"block {name!r} of {filename or doc.get('title')} is not a mapping")
        blocks[name] = items(body)
    return Rule(
        title=doc.get("title", filename), id=doc.get("id", ""),
        level=doc.get("level", "medium"), tags=list(doc.get("tags") or []),
        description=doc.get("description", ""), filename=filename or doc.get("filename", ""),
        blocks=blocks, condition=condition)


def default_rules() -> list[Rule]:
    return [parse_rule(doc, doc["filename"]) for doc in RULES]


def _usable_pattern(df: DataFrame, pattern: str) -> bool:
    try:
        re.compile(pattern)
        df.sparkSession._jvm.java.util.regex.Pattern.compile(pattern)
    except Exception as err:  # an invalid pattern is skipped, not fatal
        log.warning("skipping pattern %r: %s", pattern, err)
        return False
    return True


def match_field(df: DataFrame, name: str, modifier: str, values) -> str:
    """OR over the values; an absent, null, empty, zero or false value never matches."""
    if name not in df.columns:
        return "false"
    if not isinstance(values, list):
        values = [values]
    kind = df.schema[name].dataType
    value = f"cast(`{name}` AS string)" if not isinstance(kind, T.StringType) else f"`{name}`"
    if isinstance(kind, T.BooleanType):
        present = f"`{name}`"
    elif isinstance(kind, T.NumericType):
        present = f"`{name}` != 0"
    else:
        present = f"{value} != ''"
    low = f"`{LOWERED}{name}`" if f"{LOWERED}{name}" in df.columns else f"lower({value})"
    tests = []
    for v in values:
        needle = quoted(str(v).lower())
        if modifier == "startswith":
            tests.append(f"startswith({low}, {needle})")
        elif modifier == "endswith":
            tests.append(f"endswith({low}, {needle})")
        elif modifier == "re":
            if _usable_pattern(df, str(v)):
                tests.append(f"rlike({value}, {quoted('(?i)' + str(v))})")
        elif modifier == "exact":
            tests.append(f"{low} = {needle}")
        else:  # contains, and every unknown modifier
            tests.append(f"contains({low}, {needle})")
    return f"coalesce({present} AND ({' OR '.join(tests) or 'false'}), false)"


def match_block(df: DataFrame, entries: list, duplicate_keys: str = "last") -> str:
    """AND over the fields of a block.

    ``duplicate_keys``: "last" keeps the last of equal keys, as the usual file
    parser does; "and" requires all of them, as the authors of such rules mean.
    """
    if duplicate_keys == "last":
        entries = list(dict(entries).items())
    parts = []
    for key, values in entries:
        name, _, modifiers = key.partition("|")
        parts.append(match_field(df, name, modifiers.split("|")[0] or "exact", values))
    return f"({' AND '.join(parts) or 'true'})"


def rule_condition(df: DataFrame, rule: Rule, duplicate_keys: str = "last") -> str:
    """The rule's condition over the columns of ``df``, as SQL."""
    filters = {n: b for n, b in rule.blocks.items() if n.startswith("filter")}
    selections = {n: b for n, b in rule.blocks.items() if n not in filters}

    def any_block(entries: list) -> str:
        return f"({' OR '.join(match_block(df, e, duplicate_keys) for e in entries) or 'false'})"

    def positive(part: str) -> str:
        return part.split(" and not ")[0].strip()

    if " or " in rule.condition:
        names = [positive(p) for p in rule.condition.split(" or ")]
        chosen = [selections[n] for n in names if n in selections]
    else:
        name = positive(rule.condition)
        if name not in selections:
            name = "selection" if "selection" in selections else next(iter(selections), None)
        chosen = [selections[name]] if name is not None else []
    result = any_block(chosen)
    if "and not" in rule.condition and filters:
        result += f" AND NOT {any_block(list(filters.values()))}"
    return f"({result})"


def match_rule(df: DataFrame, rule: Rule, duplicate_keys: str = "last") -> Column:
    """The rule as one boolean column."""
    return F.expr(rule_condition(df, rule, duplicate_keys))


def with_lowered(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add every field that the rules compare in lower case, lowered once per row.

    The command line of prepared events is there in lower case.
    """
    asked = {key.partition("|")[0] for r in rules for block in r.blocks.values() for key, _ in block}
    present = [c for c in df.columns if c in asked]
    known = {"CommandLine": F.col("_cmd")} if {*HELPERS} <= {*df.columns} else {}
    return df.withColumns({f"{LOWERED}{c}": known.get(c, F.lower(F.col(f"`{c}`").cast("string"))) for c in present})


def all_matches(df: DataFrame, rules: list[Rule], duplicate_keys: str = "last") -> DataFrame:
    """Add ``rule_matches``: one struct per matching rule, in rule order."""
    found = ", ".join(
        f"CASE WHEN {rule_condition(df, r, duplicate_keys)} THEN named_struct("
        f"'rule_title', {quoted(r.title)}, 'rule_id', {quoted(r.id)}, 'level', {quoted(r.level)}, "
        f"'mitre_tags', cast(array({', '.join(quoted(t) for t in r.techniques)}) AS array<string>), "
        f"'description', {quoted(r.description)}) END" for r in rules)
    return df.withColumn("rule_matches", F.expr(f"filter(array({found}), m -> m IS NOT NULL)"))


def apply_rules(df: DataFrame, rules: list[Rule] | None = None,
                duplicate_keys: str = "last") -> DataFrame:
    """Add the best match of every event.

    Severity and file order are known when the rules are compiled, so the best
    match is the first hit of one ordered CASE.
    """
    rules = default_rules() if rules is None else rules
    if not rules:
        return df.withColumns({k: F.lit(v) for k, v in NO_MATCH.items()})
    low = with_lowered(df, rules)
    ranked = best_first(rules)
    told = [list(NO_MATCH.values()), *[[True, r.title, r.level, ", ".join(r.techniques)] for r in ranked]]
    best = first_hit(low, ranked, duplicate_keys, lambda place: str(place + 1))
    return low.withColumn("_rule", F.expr(f"coalesce({best}, 0)")).drop(*[c for c in low.columns if c not in df.columns]).withColumns({
        k: F.element_at(F.array(*[F.lit(t[i]) for t in told]), F.col("_rule") + 1) for i, k in enumerate(NO_MATCH)}).drop("_rule")


def best_first(rules: list[Rule]) -> list[Rule]:
    """By falling severity, and by file order among equals."""
    return [r for _, r in sorted(enumerate(rules), key=lambda r: (-r[1].severity, r[0]))]


def first_hit(low: DataFrame, ranked: list[Rule], duplicate_keys: str, told: Callable[[int], str]) -> str:
    """What ``told`` says of the place of the first rule that hits, as SQL; null if none does.

    The rules are cut into CASE expressions of ``CHUNK`` rules, of which the first that hits
    ends the search; so generated methods stay small for large rule sets.
    """
    whens = [f"WHEN {rule_condition(low, r, duplicate_keys)} THEN {told(i)}" for i, r in enumerate(ranked)]
    cases = [f"CASE {' '.join(whens[i:i + CHUNK])} END" for i in range(0, len(whens), CHUNK)]
    return f"coalesce({', '.join(cases)})" if len(cases) > 1 else cases[0]


def with_best(df: DataFrame, rules: list[Rule], duplicate_keys: str = "last") -> DataFrame:
    """Add ``_best``: the best match as a struct, null if there is none."""
    low = with_lowered(df, rules)
    ranked = best_first(rules)

    def told(place: int) -> str:
        r = ranked[place]
        return (f"named_struct('sigma_match', true, 'sigma_rule_name', {quoted(r.title)}, 'sigma_level', {quoted(r.level)}, "
                f"'sigma_mitre_tags', {quoted(', '.join(r.techniques))})")

    return low.withColumn("_best", F.expr(first_hit(low, ranked, duplicate_keys, told))).drop(
        *[c for c in low.columns if c not in df.columns])


def matched_events(df: DataFrame, rules: list[Rule] | None = None, duplicate_keys: str = "last") -> DataFrame:
    """Only the events that match, with their best match.

    The match is a row of a generated table: a filter on it would be pushed below the
    CASE together with a copy of it, so that all rules would be tested twice.
    """
    rules = default_rules() if rules is None else rules
    if not rules:
        return apply_rules(df, rules).limit(0)
    best = with_best(df, rules, duplicate_keys)
    return best.select(*[F.col(f"`{c}`") for c in df.columns], F.inline(F.array_compact(F.array("_best"))))


def rules_table(spark, rules: list[Rule]) -> DataFrame:
    """One row of metadata per rule, in file order."""
    rows = ", ".join(
        f"({i}, {', '.join(quoted(v) for v in (r.title, r.id, r.level, ', '.join(r.techniques), r.filename))})"
        for i, r in enumerate(rules))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(rule_order, title, id, level, mitre_tags, filename)")


def match_rate_by_label(df: DataFrame) -> DataFrame:
    return df.groupBy("label").agg(
        F.count("*").alias("events"),
        F.count_if("sigma_match").alias("matched"),
    ).withColumn("match_rate", F.col("matched") / F.col("events"))


def events_per_rule(df: DataFrame) -> DataFrame:
    # counted before they are filtered: a filter on the match would repeat all rules
    return (df.groupBy("sigma_rule_name").agg(F.count_if("sigma_match").alias("n_events")).where("n_events > 0")
            .orderBy(F.desc("n_events"), "sigma_rule_name"))
