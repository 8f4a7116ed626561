"""One-class kernel boundary on random Fourier features.

The radial kernel exp(-g * d^2) is approximated by the inner product of cosine
features (Rahimi and Recht, 2007).  In that space the one-class problem is a
linear one, and each training step is a single pass whose result is one vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procwarden.fixed_values import BOUNDARY_NU, SEED
from procwarden.operators.scaling import matrix

FEATURES = 128
BINS = 256
STEPS = 16  # at most
TOLERANCE = 0.01  # training stops after a step that moves the weights by no more than this share of them
DIGITS = 9  # decimals of the decision values that rows are binned by
LIFTED = 512  # rows that are lifted at once, so that their features stay in the processor's cache
SPAN = 2.0  # |w . z| <= 2: the weights are always a mean of lifted rows, and |z| <= sqrt(2)


@dataclass
class Boundary:
    """Directions (inputs x features), phases and the learnt weights."""

    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None


def make_directions(inputs: int, features: int = FEATURES, seed: int = SEED) -> Boundary:
    """Directions ~ N(0, 2g) with g = 1 / inputs, rounded to 6 decimals."""
    rng = np.random.default_rng(seed)
    gamma = 1.0 / inputs
    return Boundary(
        np.round(rng.normal(0.0, np.sqrt(2.0 * gamma), (inputs, features)), 6),
        np.round(rng.uniform(0.0, 2.0 * np.pi, features), 6))


def lift(x: np.ndarray, b: Boundary) -> np.ndarray:
    z = x @ b.directions
    z += b.phases
    np.cos(z, out=z)
    z *= np.sqrt(2.0 / len(b.phases))
    return z


def slices(x: np.ndarray) -> Iterator[slice]:
    return (slice(i, i + LIFTED) for i in range(0, len(x), LIFTED))


def _sum_parts(vectors: DataFrame, part, width: int, small: bool = False) -> np.ndarray:
    """Sum a per-batch vector over all rows; Spark adds, the driver gets ``width`` numbers.

    ``small``: the vector is short, so that ``part`` is asked for a few rows at a time.
    """
    def run(batches):
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                x, copies = matrix(batch.column(0)), batch.column(1).to_numpy().astype(float)
                for s in slices(x) if small else [slice(None)]:
                    total += part(x[s], copies[s])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], ["position", "value"])

    parts = vectors.select("x", "copies").mapInArrow(run, "position int, value double")
    sums = parts.groupBy("position").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(width)
    for r in sums:
        out[r["position"]] = r["value"]
    return out


def kernel_mean(vectors: DataFrame, b: Boundary) -> Boundary:
    """Mean feature vector: w . z(x) is the mean kernel value of x to the baseline."""
    return _mean(vectors, b)[0]


def _mean(vectors: DataFrame, b: Boundary) -> tuple[Boundary, float]:
    width = len(b.phases)
    sums = _sum_parts(vectors, lambda x, n: np.append(n @ lift(x, b), n.sum()), width + 1, small=True)
    return Boundary(b.directions, b.phases, sums[:-1] / max(sums[-1], 1.0)), float(sums[-1])


def _by_value(vectors: DataFrame, b: Boundary, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One pass: rows, and summed features, by bins of the decision value under ``w``."""
    width = len(b.phases)

    def part(x, n):
        z = lift(x, b)
        value = np.clip(np.round(z @ w, DIGITS), -SPAN, SPAN)
        place = np.floor((value + SPAN) / (2 * SPAN) * BINS).astype(int)
        place = np.minimum(place, BINS - 1)
        sums, sort = np.zeros((BINS, width)), np.argsort(place, kind="stable")
        bins, begins = np.unique(place[sort], return_index=True)
        sums[bins] = np.add.reduceat((n[:, None] * z)[sort], begins)
        return np.concatenate([np.bincount(place, n, BINS), sums.ravel()])

    found = _sum_parts(vectors, part, BINS * (width + 1))
    return found[:BINS], found[BINS:].reshape(BINS, width)


def lowest_mean(counts: np.ndarray, sums: np.ndarray, share: float) -> np.ndarray:
    """Mean features of the ``share`` of rows with the lowest values; the last bin counts in part."""
    wanted = share * counts.sum()
    before = np.cumsum(counts) - counts
    part = np.clip((wanted - before) / np.maximum(counts, 1e-12), 0.0, 1.0) * (counts > 0)
    return part @ sums / max(part @ counts, 1e-12)


def fit_boundary(vectors: DataFrame, inputs: int, features: int = FEATURES,
                 steps: int = STEPS, nu: float = BOUNDARY_NU, seed: int = SEED,
                 tolerance: float = TOLERANCE) -> Boundary:
    """Subgradient steps on the one-class objective, from the kernel mean.

    Every step is one pass over the distinct vectors, which gives the rows and
    their summed features by bins of the decision value under the weights of
    that step.  The weights move towards the mean of the ``nu`` lowest rows, so
    they stay a mean of lifted rows and every value lies in the bins' range.  Training
    ends after ``steps`` steps, or after one that hardly moved the weights.
    """
    b, rows = _mean(vectors, make_directions(inputs, features, seed))
    w = b.weights
    for step in range(steps if rows else 0):
        counts, sums = _by_value(vectors, b, w)
        if abs(counts.sum() - rows) > 1e-6 * rows:
            raise RuntimeError(f"a training step saw {counts.sum():.0f} of {rows:.0f} rows")
        move = (lowest_mean(counts, sums, nu) - w) / (step + 2.0)
        w = w + move
        if np.linalg.norm(move) <= tolerance * np.linalg.norm(w):
            break
    return Boundary(b.directions, b.phases, w)


def boundary_score(b: Boundary, x: Column) -> Column:
    """-w . z(x): higher is odder.  The offset cancels in the normalisation."""
    @F.arrow_udf("double")
    def score(batch: pa.Array) -> pa.Array:
        if not len(batch):
            return pa.array([], pa.float64())
        x = matrix(batch)
        return pa.array(np.concatenate([-(lift(x[s], b) @ b.weights) for s in slices(x)]))

    return score(x)
