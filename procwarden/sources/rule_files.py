"""Rule files of a folder that any Hadoop file system holds, read and parsed by Spark.

Every file gives one row: the rule's document, or the reason why it was rejected, so
that a rule set cannot shrink unnoticed.  Only the accepted documents, a small piece of
configuration, come to the driver, where they are compiled to columns.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procwarden.operators.rules import Rule, parse_rule
from procwarden.session import file_system

try:
    import yaml
except ImportError:  # JSON rule files still work
    yaml = None

PATTERN = "*.{yml,yaml}"
PARSED = "file string, document string, reason string"


@dataclass
class RuleSet:
    """Rules in order of file name, and the rejected files as a table (file, reason)."""

    rules: list[Rule]
    rejects: DataFrame


def _pair_loader():
    """A safe loader that keeps repeated keys below ``detection`` as pairs."""

    class PairLoader(yaml.SafeLoader):
        pass

    def value(loader, node):
        return loader.construct_object(node, deep=True)

    def pairs(loader, node, depth):
        if not isinstance(node, yaml.MappingNode) or not depth:
            return value(loader, node)
        return [[value(loader, k), pairs(loader, v, depth - 1)] for k, v in node.value]

    def mapping(loader, node):
        return {k.value: pairs(loader, v, 2) if k.value == "detection" else value(loader, v)
                for k, v in node.value}

    PairLoader.add_constructor(yaml.resolver.BaseResolver.DEFAULT_MAPPING_TAG, mapping)
    return PairLoader


def parse_document(body: bytes, name: str) -> dict:
    """The document of a rule file; a ValueError tells what is wrong with it."""
    try:
        text = body.decode("utf-8")
        doc = json.loads(text) if yaml is None else yaml.load(text, Loader=_pair_loader())  # noqa: S506 - a SafeLoader
    except Exception as err:
        raise ValueError(f"cannot be read: {type(err).__name__}") from err
    if not isinstance(doc, dict):
        raise ValueError("is no mapping")
    if "detection" not in doc:
        raise ValueError("has no detection")
    doc = json.loads(json.dumps(doc, default=str))  # dates as text
    try:
        parse_rule(doc, name)
    except Exception as err:
        raise ValueError(f"detection cannot be read: {err}") from err
    return doc


def _parse(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for name, body in zip(pdf["file"], pdf["content"], strict=True):
            try:
                rows.append((name, json.dumps(parse_document(bytes(body), name)), None))
            except ValueError as err:
                rows.append((name, None, str(err)))
        yield pd.DataFrame(rows, columns=["file", "document", "reason"])


def read_rule_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, document, reason) of every rule file that lies in the folder itself.

    A folder that does not exist gives one rejected row with its name.
    """
    fs, where = file_system(spark, folder)
    if not fs.exists(where):
        return spark.createDataFrame([(folder, None, "no such folder")], PARSED)
    top = fs.makeQualified(where).toString().rstrip("/")
    listed = {f.getPath().getName(): f.getLen() for f in fs.listStatus(where) if f.isFile()}
    sizes = {name: n for name, n in listed.items() if name.endswith((".yml", ".yaml"))}
    empty = spark.createDataFrame([(name, None, "is empty") for name, n in sizes.items() if not n], PARSED)
    if not any(sizes.values()):
        return empty
    files = spark.read.format("binaryFile").option("pathGlobFilter", PATTERN).load(folder)
    inside = F.regexp_replace("path", "/[^/]*$", "")
    plain = F.lit(top.split(":", 1)[-1].lstrip("/"))  # the scheme's slashes are written in several ways
    return (files.where(F.ltrim(F.regexp_replace(inside, "^[^:/]*:", ""), F.lit("/")) == plain)
            .select(F.substring_index("path", "/", -1).alias("file"), "content").mapInPandas(_parse, PARSED)
            .unionByName(empty))  # Spark's reader passes over files without bytes


def load_rules(spark: SparkSession, folder: str) -> RuleSet:
    """All rules of a folder and what was rejected."""
    parsed = read_rule_files(spark, folder)
    known = parsed.where("document IS NOT NULL").orderBy("file").collect()  # rules are configuration
    rules = [parse_rule(json.loads(r["document"]), r["file"]) for r in known]
    return RuleSet(rules, parsed.where("reason IS NOT NULL").select("file", "reason"))
