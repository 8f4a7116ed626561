"""Isolation forest: samples drawn by Spark from all rows, one tree per group, batch scoring.

Draws and splits come from MD5 of names, which every engine has, so that the trees are
the same wherever they are grown.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procwarden.fixed_values import FOREST_SAMPLE, FOREST_TREES, SEED
from procwarden.operators.scaling import matrix
from procwarden.schema import EVENT_KEY
from procwarden.session import cut_lineage

NODE_SCHEMA = ("tree int, node int, feature int, threshold double, "
               "left int, right int, path double")
HASH_SPACE = 1 << 40  # fine enough to draw a pool of 10**12 rows
POOL_SAMPLES = 64  # a pool, where one is asked for, holds so many samples
EULER = 0.5772156649015329


@dataclass
class Forest:
    """Node table, at most trees * (2 * sample - 1) rows, and the sample size."""

    nodes: DataFrame
    trees: int
    sample: int


def expected_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


def below(share: float) -> str:
    """The first ten digits that the MD5 of a drawn name lies below, for a share under 1."""
    return f"{math.ceil(HASH_SPACE * share):010x}"


def _digits(*name: Column | str | int) -> Column:
    """The first ten digits of the MD5 of a name whose parts are joined by colons."""
    parts = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in name]
    return F.substring(F.md5(F.concat_ws(":", *parts)), 1, 10)


def draw_samples(rows: DataFrame, n_rows: int, trees: int, sample: int, seed: int,
                 order: str = EVENT_KEY, pool_samples: int | None = None) -> DataFrame:
    """(tree, order, rank, x): for every tree about twice the sample.

    Every row is hashed for every tree.  With ``pool_samples`` one hash per row first draws a pool of
    so many samples, the only rows that trees are drawn from.  Hashes are of names, so the draw does
    not depend on partitioning, and only the drawn rows move.  The tree keeps the ``sample``
    rows of lowest rank.
    """
    pool = n_rows if pool_samples is None else sample * pool_samples
    key = F.col(order)
    if n_rows > pool:
        rows = rows.where(_digits("pool", seed, key) < below(pool / n_rows))
    offered = rows.select(order, "x", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    ranked = offered.withColumn("rank", _digits(seed, F.col("tree"), key))
    share = 2.0 * sample / min(n_rows, pool)
    return ranked if share >= 1 else ranked.where(F.col("rank") < below(share))


def chance(*name) -> float:
    """A number from 0 to below 1, from the MD5 of a name."""
    return int(hashlib.md5(":".join(map(str, name)).encode()).hexdigest()[:13], 16) / (1 << 52)


def grow_tree(pdf: pd.DataFrame, sample: int, seed: int, order: str) -> pd.DataFrame:
    """Random splits down to single points, equal points or the depth limit.

    Nodes are numbered as in a heap: the root is 1, below node n lie 2 n and 2 n + 1.
    """
    tree = int(pdf["tree"].iloc[0])
    pdf = pdf.sort_values(["rank", order]).head(sample)
    points = np.stack(pdf["x"].to_numpy())
    limit = math.ceil(math.log2(max(len(points), 2)))
    nodes, todo = [], [(1, points, 0)]
    while todo:
        node, part, depth = todo.pop()
        low, high = part.min(axis=0), part.max(axis=0)
        open_features = np.flatnonzero(high > low)
        if depth >= limit or len(part) <= 1 or not len(open_features):
            nodes.append((tree, node, -1, 0.0, -1, -1, depth + expected_path(len(part))))
            continue
        f = int(open_features[int(chance(seed, tree, node, "feature") * len(open_features))])
        cut = float(low[f] + chance(seed, tree, node, "cut") * (high[f] - low[f]))
        goes_left = part[:, f] <= cut
        nodes.append((tree, node, f, cut, 2 * node, 2 * node + 1, 0.0))
        todo += [(2 * node, part[goes_left], depth + 1), (2 * node + 1, part[~goes_left], depth + 1)]
    return pd.DataFrame(nodes, columns=[c.split()[0] for c in NODE_SCHEMA.split(", ")])


def fit_forest(rows: DataFrame, n_rows: int, trees: int = FOREST_TREES,
               sample: int = FOREST_SAMPLE, seed: int = SEED, order: str = EVENT_KEY,
               pool_samples: int | None = None) -> Forest:
    """Grow one tree per group; a group holds about two samples, whatever the data."""
    drawn = draw_samples(rows, n_rows, trees, sample, seed, order, pool_samples)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        return grow_tree(pdf, sample, seed, order)

    nodes = drawn.groupBy("tree").applyInPandas(grow, NODE_SCHEMA)
    return Forest(cut_lineage(nodes), trees, min(sample, n_rows))


def node_arrays(nodes: pd.DataFrame) -> dict[str, np.ndarray]:
    """The bounded node table as (tree, node) arrays of trees filled up to one depth.

    Below a leaf above the last level every row goes left, down to the node that has its path.
    """
    levels = int(nodes["node"].max()).bit_length()
    shape = (nodes["tree"].max() + 1, 1 << levels)
    inner = nodes[nodes["feature"] >= 0]
    leaves = nodes[nodes["feature"] < 0]
    out = {"feature": np.zeros(shape, np.int64), "threshold": np.full(shape, np.inf), "path": np.zeros(shape),
           "used": np.unique(nodes["tree"]), "levels": levels}
    for name in ("feature", "threshold"):
        out[name][inner["tree"], inner["node"]] = inner[name]
    last = [n << levels - n.bit_length() for n in leaves["node"].tolist()]
    out["path"][leaves["tree"], last] = leaves["path"]
    return out


def mean_path(x: np.ndarray, a: dict[str, np.ndarray]) -> np.ndarray:
    """Mean path length of a batch over all trees, level by level; below node n lie 2 n and 2 n + 1."""
    total, values = np.zeros(len(x)), x.ravel()
    row = np.arange(len(x)) * x.shape[1]
    for t in a["used"]:
        feature, threshold = a["feature"][t], a["threshold"][t]
        at = np.ones(len(x), dtype=np.int64)  # the root
        for _ in range(a["levels"] - 1):
            goes_right = values[row + feature[at]] > threshold[at]
            at = 2 * at + goes_right
        total += a["path"][t][at]
    return total / len(a["used"])


def forest_score(forest: Forest, x: Column) -> Column:
    """2 ** (-mean path / expected path): higher is odder."""
    arrays = node_arrays(forest.nodes.toPandas())  # bounded: trees * (2 * sample - 1) rows
    shared = forest.nodes.sparkSession.sparkContext.broadcast(arrays)
    unit = max(expected_path(forest.sample), 1e-12)

    @F.arrow_udf("double")
    def score(batch: pa.Array) -> pa.Array:
        if not len(batch):
            return pa.array([], pa.float64())
        return pa.array(2.0 ** (-mean_path(matrix(batch), shared.value) / unit))

    return score(x)
