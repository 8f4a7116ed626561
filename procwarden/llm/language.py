"""Language identification: sparse multinomial logistic regression on character n-grams.

Features are hashed n-grams of letters (everything else counts as one space),
weighted by tf-idf with the term frequency taken as a share of the text.  The
model is trained with the follow-the-regularised-leader rule and elastic-net
penalties on a bounded sample, and its scores are calibrated by a temperature
fitted on training documents that the weights never saw.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from procwarden.llm.common import byte_slices, small_or_shuffled
from procwarden.session import cut_lineage

ORDERS = (1, 2, 3)
BITS = 18  # hashed features: 2**BITS
SCALE = 40.0  # shares of a text are small numbers
#: Documents per language that the model is fitted on, at most about so many (hash sample).
SAMPLE_PER_LABEL = 700
#: Documents of all languages together, at most about so many: with more than 60 languages each has fewer.
SAMPLE = 42_000
DRAWS = 1_000_000  # steps of the draw by hash
ROWS_AT_ONCE = 1 << 14  # features whose weights are worked out at once
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.02, 0.5
BLOCK = 1 << 20  # code points worked on at once
UNKNOWN = "und"


def _letters() -> np.ndarray:
    """Lower case of every letter of the basic plane, a space for all else."""
    out = np.full(1 << 16, 32, np.uint32)
    for code in range(1 << 16):
        if not 0xD800 <= code < 0xE000 and chr(code).isalpha():
            low = chr(code).lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


class Grams:
    """Hashed n-grams of a row of texts, in blocks of bounded size."""

    def __init__(self) -> None:
        self.letters = _letters()

    def blocks(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
        """(text of each place, whether a letter stands there, the n-grams from there on)."""
        pad = max(ORDERS) - 1
        parts = [np.full(pad, 32, np.uint32)]
        sizes = []
        for t in texts:
            codes = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
            low = np.where(codes < 1 << 16, self.letters[np.minimum(codes, (1 << 16) - 1)], codes)
            for astral in np.unique(codes[codes >= 1 << 16]):
                if not chr(astral).isalpha():
                    low[codes == astral] = 32
            parts += [low, np.full(pad, 32, np.uint32)]
            sizes.append(len(low) + pad)
        all_codes, owner = np.concatenate(parts), np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        for a in range(0, len(owner), BLOCK):
            b = min(a + BLOCK, len(owner))
            window = all_codes[a:b + pad]  # text places are shifted by the padding in front
            grams, h = [], np.zeros(b - a, np.uint32)
            for k in range(max(ORDERS)):
                h = (h ^ window[k:k + b - a]) * np.uint32(0x9E3779B1)
                h ^= h >> np.uint32(15)
                if k + 1 in ORDERS:
                    grams.append(h >> np.uint32(32 - BITS))
            # a run of spaces only says nothing
            said = window[:b - a] != 32
            for k in range(1, pad + 1):
                said = said | (window[k:k + b - a] != 32)
            yield owner[a:b][said], (window[:b - a] != 32)[said], [g[said] for g in grams]


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text its distinct features and their tf (share of the text times SCALE)."""
    grams = Grams()
    for batch in byte_slices(batches, "text"):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        keys, total = [], np.zeros(len(texts))
        for owner, _, found in grams.blocks(texts):
            total += np.bincount(owner, minlength=len(texts))
            keys.append(np.concatenate([(owner.astype(np.int64) << BITS) | g for g in found]))
        keys, n = np.unique(np.concatenate(keys), return_counts=True) if keys else (np.zeros(0, np.int64),) * 2
        owner = keys >> BITS
        tf = n / np.maximum(total, 1)[owner] * SCALE
        ends = np.searchsorted(owner, np.arange(len(texts) + 1))
        yield pa.RecordBatch.from_pydict({
            "label": batch.column("lang"), "part": batch.column("part"),
            "features": [(keys[a:b] & ((1 << BITS) - 1)).astype(np.int32) for a, b in zip(ends, ends[1:])],
            "tf": [tf[a:b].astype(np.float32) for a, b in zip(ends, ends[1:])]},
            schema=pa.schema([("label", pa.string()), ("part", pa.int32()), ("features", pa.list_(pa.int32())),
                              ("tf", pa.list_(pa.float32()))]))


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: pd.DataFrame) -> pd.DataFrame:
    """Weights (label, feature, weight) fitted on the bounded sample; feature -1 is the bias, -2 the temperature."""
    rows = rows.sort_values(["_order", "label"]).reset_index(drop=True)
    labels = sorted(rows["label"].unique())
    # a label that has held out rows only is fitted on these
    held = ((rows["part"] == 3) & rows["label"].isin(rows["label"][rows["part"] != 3])).to_numpy()
    fitted = np.flatnonzero(~held)
    df = np.zeros(1 << BITS)
    for i in fitted:
        df[rows["features"][i]] += 1
    idf = np.log((1 + len(fitted)) / (1 + df)) + 1
    idf[df == 0] = 0
    target = rows["label"].map({x: i for i, x in enumerate(labels)}).to_numpy()
    z, n = np.zeros(((1 << BITS) + 1, len(labels))), np.zeros(((1 << BITS) + 1, len(labels)))

    def weights(at: np.ndarray) -> np.ndarray:
        zi, free = z[at], at == 1 << BITS
        l1 = np.where(free, 0.0, L1)[:, None]
        w = -(zi - np.sign(zi) * l1) / ((BETA + np.sqrt(n[at])) / ALPHA + np.where(free, 0.0, L2)[:, None])
        return np.where(np.abs(zi) <= l1, 0.0, w)

    def example(i: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.asarray(rows["features"][i], np.int64)
        return np.append(at, 1 << BITS), np.append(np.asarray(rows["tf"][i], float) * idf[at], 1.0)

    shuffled = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in shuffled.permutation(fitted):
            at, x = example(i)
            w = weights(at)
            p = _softmax(x @ w)
            p[target[i]] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    tune = np.flatnonzero(held) if held.any() else fitted
    logits = np.stack([x @ weights(at) for at, x in map(example, tune)])
    grid = np.exp(np.linspace(np.log(0.05), np.log(10), 80))
    loss = [-np.log(_softmax(logits / t)[np.arange(len(tune)), target[tune]] + 1e-12).mean() for t in grid]
    names = np.array(labels, object)
    out = [(np.array([""], object), np.array([-2]), grid[[int(np.argmin(loss))]]),
           (names, np.full(len(labels), -1), weights(np.array([1 << BITS]))[0])]
    for a in range(0, 1 << BITS, ROWS_AT_ONCE):
        at = np.arange(a, min(a + ROWS_AT_ONCE, 1 << BITS))
        w = weights(at)
        j, k = np.nonzero(w)
        out.append((names[k], at[j], w[j, k] * idf[at[j]]))
    return pd.DataFrame(dict(zip(("label", "feature", "weight"), map(np.concatenate, zip(*out)))))


def part_of(doc_id: Column) -> Column:
    """crc32 of the id's text, modulo 4; null counts as the empty text."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4).cast("int")


def fit(docs: DataFrame) -> DataFrame:
    """The model, as a table, from (doc_id, text, lang) rows whose ``part_of`` is not 2.

    Every language is learned.  Of each at most about ``SAMPLE_PER_LABEL`` documents are drawn
    by hash, fewer if all languages together would have more than ``SAMPLE``, but one at least.
    """
    key = F.xxhash64("doc_id", "text")
    rows = docs.select("doc_id", "text", "lang", part_of(F.col("doc_id")).alias("part")).where(
        (F.col("part") != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    draw = F.pmod(key, F.lit(DRAWS))
    counts = cut_lineage(rows.groupBy("lang").agg(
        F.count("*").alias("n"), F.min(F.struct(draw.alias("draw"), key.alias("key"))).alias("least")))
    n_labels = counts.count()
    if not n_labels:
        return docs.sparkSession.createDataFrame([("", -2, 1.0)], "label string, feature int, weight double")
    each = min(SAMPLE_PER_LABEL, SAMPLE / n_labels)
    below = F.least(F.lit(1.0), F.lit(each) / F.col("n")) * DRAWS
    limits = counts.select("lang", below.alias("_below"), "least")
    drawn = rows.join(small_or_shuffled(limits.select("lang", "_below"), n_labels), "lang").where(draw < F.col("_below"))
    sample = drawn.select("text", "lang", "part")
    missed = limits.where(F.col("least.draw") >= F.col("_below")).select("lang", F.col("least.key").alias("_key"))
    n_missed = missed.count()
    if n_missed:  # the draw left a language out
        first = rows.join(small_or_shuffled(missed, n_missed), "lang").where(key == F.col("_key"))
        sample = sample.unionByName(first.dropDuplicates(["lang"]).select("text", "lang", "part"))
    features = sample.mapInArrow(_counts, "label string, part int, features array<int>, tf array<float>")
    order = F.xxhash64(F.to_json(F.struct("features", "tf")))
    return cut_lineage(features.withColumns({"_order": order, "_all": F.lit(0)}).groupBy("_all").applyInPandas(
        train, "label string, feature int, weight double"))


class Model:
    """Dense weights of a fitted model; its size is bounded by labels times 2**BITS."""

    def __init__(self, rows: list[tuple[str, int, float]]) -> None:
        self.labels = sorted({r[0] for r in rows if r[1] == -1})
        at = {x: i for i, x in enumerate(self.labels)}
        self.temperature = next((r[2] for r in rows if r[1] == -2), 1.0)
        self.bias = np.zeros(len(self.labels))
        self.weights = np.zeros((1 << BITS, len(self.labels)), np.float32)
        for label, feature, weight in rows:
            if feature == -1:
                self.bias[at[label]] = weight
            elif feature >= 0:
                self.weights[feature, at[label]] = weight

    def predict(self, texts: list[str], grams: Grams) -> tuple[list[str], np.ndarray, np.ndarray]:
        n = len(texts)
        total, letters, sums = np.zeros(n), np.zeros(n), np.zeros((n, len(self.labels)))
        for owner, letter, found in grams.blocks(texts):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(owner) else []
            if not len(starts):
                continue
            who = owner[starts]
            total[who] += np.diff(np.r_[starts, len(owner)])
            letters[who] += np.add.reduceat(letter.astype(np.int64), starts)
            for g in found:
                sums[who] += np.add.reduceat(self.weights[g], starts, axis=0)
        if not self.labels:
            return [UNKNOWN] * n, np.zeros(n), letters > 0
        p = _softmax((sums * (SCALE / np.maximum(total, 1))[:, None] + self.bias) / self.temperature)
        best = p.argmax(axis=1)
        known = letters > 0
        return ([self.labels[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)],
                np.where(known, p[np.arange(n), best], 0.0), known)


def _predictions(model: DataFrame):
    learned = Model([tuple(r) for r in model.select("label", "feature", "weight").collect()])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for batch in byte_slices(batches, "text"):
            labels, score, letters = learned.predict([t or "" for t in batch.column("text").to_pylist()], grams)
            out = pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(labels, pa.string()), pa.array(np.clip(score, 0, 1), pa.float64()),
                 pa.array(letters, pa.bool_())], [*batch.schema.names, "lang_pred", "score", "has_letters"])
            yield out
    return run


def add_language(docs: DataFrame, model: DataFrame) -> DataFrame:
    """``docs`` with lang_pred, score and has_letters, which look at the text only.

    Null texts, and texts without a letter, are ``und`` with score 0, as is every text if
    nothing could be learned; equal texts get equal answers.  The three names must be free.
    """
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType()), T.StructField("has_letters", T.BooleanType())])
    return docs.mapInArrow(_predictions(model), schema)


def identify(docs: DataFrame, model: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per row of ``docs``; other columns are ignored."""
    slim = docs.select("doc_id", (part_of(F.col("doc_id")) == 2).alias("held_out"), "text")
    return add_language(slim, model).select("doc_id", "held_out", "lang_pred", "score")
