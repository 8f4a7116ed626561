"""Toxicity: cumulative-link ordinal regression on sparse text features.

Severity grades 0 to 3: 0 for documents labelled clean, 1 to 3 for the thirds of
the toxic ones by dose.  The dose is the sum of log(1 + count) over marker words,
the words that the labels themselves show to be tied to toxic documents.  One
weight vector serves all grades; ordered thresholds turn its score into
P(grade > k), whose sum over k is the expected severity.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procwarden.llm.common import byte_slices, span_hashes, text_bytes, words
from procwarden.session import cut_lineage

BITS = 20  # hashed features: 2**BITS
STEMS = (4, 5)  # bytes of a word's beginning that are features beside the word
GRADES = 4
#: Labelled documents that the model is fitted on, at most about so many of either kind.
SAMPLE_PER_LABEL = 3_000
EPOCHS, RATE, L1, L2 = 8, 0.8, 25.0, 0.1
L1_ROWS = 600  # with fewer labelled documents than this L1 shrinks in proportion
MIN_DOCS = 4  # labelled documents that must hold a feature
MARKER_ODDS = 3.0  # log odds between toxic and clean documents
MARKER_DOCS = 3

_SEPARATORS = np.ones(256, bool)
_SEPARATORS[128:] = False  # letters beyond ASCII belong to words
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _SEPARATORS[_a:_b] = False


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every word and word beginning, lower-cased."""
    data, offsets = text_bytes(pc.utf8_lower(texts.cast(pa.large_string())))
    starts, ends, first = words(data, offsets, _SEPARATORS)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    found, who = [span_hashes(data, starts, ends)], [owner]
    for size in STEMS:
        longer = ends - starts > size
        found.append(span_hashes(data, starts[longer], starts[longer] + size) ^ np.uint64(size))
        who.append(owner[longer])
    return np.concatenate(who), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in byte_slices(batches, "text"):
        owner, found = features(batch.column("text"))
        keys, n = np.unique((owner << BITS) | found, return_counts=True)
        ends = np.searchsorted(keys >> BITS, np.arange(batch.num_rows + 1))
        yield pa.RecordBatch.from_pydict({
            "toxic": batch.column("toxic"),
            "features": [(keys[a:b] & ((1 << BITS) - 1)).astype(np.int32) for a, b in zip(ends, ends[1:])],
            "n": [n[a:b].astype(np.int32) for a, b in zip(ends, ends[1:])]},
            schema=pa.schema([("toxic", pa.int32()), ("features", pa.list_(pa.int32())), ("n", pa.list_(pa.int32()))]))


def grades(rows: pd.DataFrame) -> np.ndarray:
    """Grade of every labelled document: 0 if clean, else 1 to 3 by its dose of markers."""
    toxic = rows["toxic"].to_numpy() == 1
    seen = np.zeros((2, 1 << BITS))
    for f, t in zip(rows["features"], toxic, strict=True):
        seen[int(t), f] += 1
    odds = np.log((seen[1] + 0.5) / (toxic.sum() + 1)) - np.log((seen[0] + 0.5) / ((~toxic).sum() + 1))
    marker = (odds > MARKER_ODDS) & (seen[1] >= MARKER_DOCS)
    dose = np.array([np.log1p(np.asarray(n)[marker[np.asarray(f, int)]]).sum()
                     for f, n in zip(rows["features"], rows["n"], strict=True)])
    out = np.zeros(len(rows), int)
    if toxic.any():
        cuts = np.quantile(dose[toxic], [1 / 3, 2 / 3])
        out[toxic] = 1 + (dose[toxic] > cuts[0]) + (dose[toxic] > cuts[1])
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def train(rows: pd.DataFrame) -> pd.DataFrame:
    """(feature, weight) of the bounded sample; features -1, -2, -3 are the ordered thresholds."""
    rows = rows.sort_values("_order").reset_index(drop=True)
    y = grades(rows)
    docs = np.zeros(1 << BITS)
    for f in rows["features"]:
        docs[f] += 1
    examples = []
    for f, n in zip(rows["features"], rows["n"], strict=True):
        common = docs[f] >= MIN_DOCS
        examples.append((np.asarray(f, int)[common], np.log1p(np.asarray(n, float)[common])))
    # follow the regularised leader: a weight stays 0 until its gradients add up to L1
    z, seen, cuts = np.zeros(1 << BITS), np.zeros(1 << BITS), np.array([1.0, 2.0, 3.0])
    cut_seen, penalty = np.zeros(GRADES - 1), L1 * min(1.0, len(rows) / L1_ROWS)

    def weights(at: np.ndarray) -> np.ndarray:
        pull = np.sign(z[at]) * np.maximum(0, np.abs(z[at]) - penalty)
        return -pull / ((1 + np.sqrt(seen[at])) / RATE + L2)

    order = np.random.default_rng(11)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            at, x = examples[i]
            w = weights(at)
            eta = w @ x
            high = _sigmoid(cuts[y[i]] - eta) if y[i] < GRADES - 1 else 1.0
            low = _sigmoid(cuts[y[i] - 1] - eta) if y[i] else 0.0
            p = max(high - low, 1e-6)
            g = (1 - high - low) * x
            z[at] += g - (np.sqrt(seen[at] + g * g) - np.sqrt(seen[at])) / RATE * w
            seen[at] += g * g
            grad = np.zeros(GRADES - 1)
            if y[i] < GRADES - 1:
                grad[y[i]] -= min(1.0, high * (1 - high) / p)
            if y[i]:
                grad[y[i] - 1] += min(1.0, low * (1 - low) / p)
            cut_seen += grad * grad
            cuts = np.maximum.accumulate(cuts - RATE * grad / (1 + np.sqrt(cut_seen)) + np.arange(GRADES - 1) * 1e-9)
    w = weights(np.arange(1 << BITS))
    kept = np.flatnonzero(np.abs(w) > 1e-6)
    return pd.DataFrame({"feature": np.r_[-1, -2, -3, kept], "weight": np.r_[cuts, w[kept]]})


def fit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The model as a table, from texts and their toxic labels (0 or 1; null ones are no labels).

    About ``SAMPLE_PER_LABEL`` toxic documents are drawn by hash, and no more clean ones
    than there are toxic ones.  A document with several labels counts as toxic if one of them says so.  Without a
    toxic label in the draw nothing is learned and every severity is 0.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    spark = docs.sparkSession
    if not sizes.get(1):
        return spark.createDataFrame([], "feature long, weight double")
    rate = F.when(F.col("toxic") == 1, min(1.0, SAMPLE_PER_LABEL / sizes[1])).otherwise(
        min(1.0, min(SAMPLE_PER_LABEL, sizes[1]) / max(1, sizes.get(0, 0))))
    drawn = known.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < rate * 1_000_000)
    sample = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(
        F.broadcast(drawn), F.col("doc_id") == F.col("_id")).select("text", "toxic")
    counted = sample.mapInArrow(_counts, "toxic int, features array<int>, n array<int>")
    return cut_lineage(counted.withColumns({"_order": F.xxhash64("features", "n", "toxic"), "_all": F.lit(0)})
                       .groupBy("_all").applyInPandas(train, "feature long, weight double"))


def grade_documents(docs: DataFrame, model: DataFrame) -> DataFrame:
    """(doc_id, severity, grade, p_toxic, toxic), one row per row of ``docs``.

    ``severity`` is the expected grade, ``p_toxic`` the probability of a grade above 0,
    ``toxic`` whether it is at least one half, ``grade`` the likeliest grade.  Whole texts
    are read; null and empty ones have no features and get severity 0.
    """
    rows = [(r["feature"], r["weight"]) for r in model.collect()]  # at most 2**BITS + 3
    weights = np.zeros(1 << BITS)
    cuts = np.array([dict(rows).get(-k, np.inf) for k in (1, 2, 3)])
    for feature, weight in rows:
        if feature >= 0:
            weights[feature] = weight
    learned = bool(rows)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            owner, found = features(batch.column("text"))
            heavy = weights[found] != 0
            keys, n = np.unique((owner[heavy] << BITS) | found[heavy], return_counts=True)
            eta = np.bincount(keys >> BITS, np.log1p(n) * weights[keys & ((1 << BITS) - 1)], batch.num_rows)
            spoken = (np.bincount(owner, minlength=batch.num_rows) > 0) & learned
            above = np.where(spoken[:, None], _sigmoid(eta[:, None] - cuts[None, :]), 0.0)
            p = -np.diff(np.c_[np.ones(batch.num_rows), above, np.zeros(batch.num_rows)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(above.sum(axis=1)), pa.array(p.argmax(axis=1).astype(np.int32)),
                 pa.array(above[:, 0]), pa.array(above[:, 0] >= 0.5)],
                ["doc_id", "severity", "grade", "p_toxic", "toxic"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, severity double, grade int, p_toxic double, toxic boolean")
