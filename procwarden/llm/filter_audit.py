"""Interaction of filters: what every filter removes in every order of them.

A document has one bit per filter.  Per part its documents are counted by their five
bits; such a table is a tensor of shape 2 x 2 x 2 x 2 x 2, one axis per filter with
the places pass and fail.  Every figure of every step of an order is a contraction of
it: along each axis pass, fail or all is taken.  The tensors are all that leaves the
documents, 32 cells a part, so 120 orders cost no further pass over them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from procwarden.llm.common import small_or_shuffled
from procwarden.session import cut_lineage

FILTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
SIGNS = "[#$%&*|]"
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
_PASS, _FAIL, _ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])
_PARTS = 200  # tensors that are contracted at once
MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES)


def failures(text: Column) -> Column:
    """Bits of the filters that see a text alone: 1 for A, 2 for B, 4 for C, 8 for D.

    A text without words has one empty word here, which fails A and passes B as none would.
    """
    words = F.split(F.btrim(text, F.lit(_SPACES)), "[\\x20\\x09-\\x0D]+")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    tests = [n < MIN_WORDS, distinct * 100 < n * DISTINCT_PERCENT,
             capitals.cast("long") * 100 > F.length(text).cast("long") * CAPITAL_PERCENT, text.rlike(SIGNS)]
    return sum((t.cast("int") * (1 << i) for i, t in enumerate(tests)), F.lit(0))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``good`` and ``toxic`` (0 or 1): one of the labels of the row's id says so."""
    told = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    told = cut_lineage(told.where("good = 1 OR toxic = 1"))
    known = rows.where("doc_id IS NOT NULL").join(small_or_shuffled(told), "doc_id", "left")
    unknown = rows.where("doc_id IS NULL")  # their one key would meet in a task
    return known.unionByName(unknown, allowMissingColumns=True).fillna(0, ["good", "toxic"])


def count_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, n, good, toxic): documents by the filters they fail, at most 32 rows a part.

    A document fails E if a smaller id has its text.  Texts are compared by their SHA-256
    and do not move.  Equal texts are counted before they meet: first rows of one
    id, then the rows of a part, so a text that a third of all rows hold comes to its
    group as a few rows from every task.
    """
    text = F.coalesce("text", F.lit(""))
    facts = cut_lineage(docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), failures(text).alias("bits"),
                                    F.unhex(F.sha2(text, 256)).alias("digest")))
    cell = ["digest", "part", "bits", "good", "toxic"]
    by_id = with_labels(facts, labels).groupBy(*cell, "doc_id").agg(F.count("*").alias("n"))
    cells = by_id.groupBy(*cell).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))).alias("loose"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("head"))
    first = F.min("head.doc_id").over(W.partitionBy("digest"))
    passing = F.coalesce("loose", F.lit(0)) + F.when(F.col("head.doc_id") == first, F.col("head.n")).otherwise(0)
    parted = cells.withColumn("passing", passing)
    both = F.inline(F.array(F.struct(F.col("bits"), F.col("passing").alias("m")),
                            F.struct((F.col("bits") + 16).alias("bits"), (F.col("n") - F.col("passing")).alias("m"))))
    return parted.select("part", "good", "toxic", both).groupBy("part", "bits").agg(
        F.sum("m").alias("n"), F.sum(F.col("m") * F.col("good")).alias("good"),
        F.sum(F.col("m") * F.col("toxic")).alias("toxic"))


def contract(tensors: np.ndarray, passing: str, failing: str = "") -> np.ndarray:
    """Sums of (part, measure, 2, 2, 2, 2, 2) tensors over documents that pass and fail the named filters."""
    along = [_PASS if f in passing else _FAIL if f in failing else _ALL for f in FILTERS]
    return np.einsum("pmabcde,a,b,c,d,e->pm", tensors, *along)


def step_figures(tensors: np.ndarray) -> np.ndarray:
    """(part, order and step, measure) for all orders of the filters."""
    known: dict[tuple[str, str], np.ndarray] = {}

    def sums(passing: Iterable[str], failing: str = "") -> np.ndarray:
        key = "".join(sorted(passing)), failing
        if key not in known:
            known[key] = contract(tensors, *key)
        return known[key]

    removed_in = {f: sum(sums(o[:o.index(f)], f)[:, 0] for o in permutations(FILTERS)) for f in FILTERS}
    out = []
    for order in permutations(FILTERS):
        for k, f in enumerate(order):
            gone, failing = sums(order[:k], f), sums("", f)[:, 0]
            alone = sums([g for g in FILTERS if g != f], f)[:, 0]
            out.append(np.stack([sums(order[:k + 1])[:, 0], gone[:, 0], failing - gone[:, 0], alone,
                                 gone[:, 1], gone[:, 2], removed_in[f]], axis=1))
    return np.stack(out, axis=1)


def _audit(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    steps = [("".join(o), k + 1) for o in permutations(FILTERS) for k in range(len(FILTERS))]
    for batch in batches:
        for at in range(0, len(batch), _PARTS):
            pdf = batch.iloc[at:at + _PARTS]
            flat = np.zeros((len(pdf), 3, 32), np.int64)
            for i, cells in enumerate(pdf["cells"]):
                for c in cells:
                    flat[i, :, c["bits"]] = c["n"], c["good"], c["toxic"]
            # bit 0, filter A, is the last axis of the reshaped array: turn the axes round
            tensors = flat.reshape(len(pdf), 3, 2, 2, 2, 2, 2).transpose(0, 1, 6, 5, 4, 3, 2)
            found = step_figures(tensors).reshape(-1, len(MEASURES))
            yield pd.DataFrame({"part": np.repeat(pdf["part"].to_numpy(), len(steps)),
                                "filter_order": [o for o, _ in steps] * len(pdf), "step": [k for _, k in steps] * len(pdf),
                                **{m: found[:, i] for i, m in enumerate(MEASURES)}})


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with ``MEASURES``.

    A part is a value of ``source``, null counts as the empty string.  Null texts count as
    empty.  Every row counts, repeated ones too; rows with the smallest id of a text pass E
    all of them.  A row without an id passes E and has no labels.  Labels with null
    values say nothing; of several labels of an id one is enough.  Only the named columns
    are read, whatever others are called; a table without rows gives none.
    """
    cells = F.collect_list(F.struct("bits", "n", "good", "toxic"))  # at most 32 of a part
    return count_cells(docs, labels).groupBy("part").agg(cells.alias("cells")).mapInPandas(_audit, SCHEMA)


ORACLE = """
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM texts),
failed AS (
  SELECT doc_id, part, CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN min(doc_id) OVER (PARTITION BY t) < doc_id THEN 'E' ELSE '' END AS bad FROM split),
told AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, string_split(bad, '') AS bad, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM failed LEFT JOIN told USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, k AS step, filter_order[k] AS f, string_split(filter_order[1:k - 1], '') AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS k)),
judged AS (
  SELECT part, filter_order, step, f, n, good, toxic, bad, list_contains(bad, f) AS fails,
    step > 1 AND list_has_any(list_filter(bad, lambda x: x <> ''), before) AS gone FROM steps, cells),
figures AS (
  SELECT part, filter_order, step, any_value(f) AS f, coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails AND len(bad) = 1), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM judged GROUP BY part, filter_order, step)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM figures"""
