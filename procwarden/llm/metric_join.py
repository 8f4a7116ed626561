"""Near-duplicate vectors: an exact range join in cells around pivots.

Unit vectors of one label whose cosine is at least the threshold are no farther
apart than ``reach``.  A cell with many vectors is split by pivots drawn from
it: a vector's home is the cell of its nearest pivot, and it is a guest of every
cell that may hold a home vector within reach.  By the triangle inequality that
is a cell whose pivot is at most two reaches farther off than the nearest one
(and, vectors being Euclidean, whose bisecting plane is within reach).  Cells are
then joined one by one; each home vector sees all its partners in its own cell.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procwarden.llm.graph import components
from procwarden.session import cut_lineage

THRESHOLD = 0.93
CELL = 2_048  # home vectors of a cell; larger ones are split
PIVOTS = 16  # pivots of one split, at most about so many
LEVELS = 4  # splits in a row; what is still larger is joined in tiles of CELL rows
SLACK = 1e-6  # more than rounding can move a distance
_CHUNK = 512


def usable(label: Column, vector: Column) -> Column:
    """Whether a vector can link at all: label and all components there, finite, not all zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(label.isNotNull() & fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(vectors: pd.Series) -> np.ndarray:
    """Rows of length one in double precision, whatever their scale."""
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _cosine(x: np.ndarray, y: np.ndarray) -> float:
    x, y = np.asarray(x, np.float64), np.asarray(y, np.float64)
    x, y = x / np.abs(x).max(), y / np.abs(y).max()
    return float((x * y).sum() / np.sqrt((x * x).sum() * (y * y).sum()))


def _split(rows: DataFrame, counts: DataFrame, reach: float) -> DataFrame:
    """Rows of the counted cells, dealt to the cells of pivots drawn from them."""
    wanted = F.least(F.lit(PIVOTS), F.ceil(F.col("homes") / CELL))
    drawn = F.pmod(F.xxhash64("vector", "cell"), F.lit(1_000_000)) < wanted / F.col("homes") * 1_000_000
    homes = rows.where("home").join(counts, "cell")
    pivots = (homes.groupBy("cell").agg(
        F.collect_list(F.when(drawn, F.col("vector"))).alias("drawn"), F.min_by("vector", "_key").alias("one"))
        .select("cell", F.concat(F.array("one"), F.filter("drawn", lambda v: v != F.col("one"))).alias("pivots")))

    def deal(frames):
        for frame in frames:
            out = []
            for _, same in frame.groupby("cell", sort=False):
                points = _unit(same["pivots"].iloc[0])
                x = _unit(same["vector"])
                d = np.sqrt(np.maximum(0, 2 - 2 * x @ points.T))
                between = np.sqrt(np.maximum(0, 2 - 2 * points @ points.T))
                near = d.argmin(axis=1)
                best = d[np.arange(len(x)), near][:, None]
                plane = (d * d - best * best) / np.maximum(2 * between[near], SLACK)
                goes = (d - best <= 2 * reach + SLACK) & (plane <= reach + SLACK)
                at, to = np.nonzero(goes)
                copy = same.iloc[at].drop(columns="pivots")
                copy["home"] = copy["home"].to_numpy() & (to == near[at])
                copy["cell"] = copy["cell"].to_numpy() + "/" + to.astype(str)
                out.append(copy)
            yield pd.concat(out) if out else frame.drop(columns="pivots")

    dealt = rows.join(pivots, "cell").select(*rows.columns, "pivots")
    return dealt.mapInPandas(deal, rows.schema)


def _join_tile(threshold: float):
    """Links of one tile: per home vector the rows it is linked with, and a spanning set of links."""
    def run(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values(["rep", "_key"]).reset_index(drop=True)
        x = _unit(tile["vector"])
        n, reps = tile["n"].to_numpy(), tile["rep"].to_numpy()
        homes, others = np.flatnonzero(tile["as_home"]), np.flatnonzero(tile["as_other"])
        root = np.arange(len(tile))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        counts, links = np.zeros(len(homes), np.int64), []
        for a in range(0, len(homes), _CHUNK):
            part = homes[a:a + _CHUNK]
            cos = x[part] @ x[others].T
            linked = cos >= threshold
            for i, j in zip(*np.nonzero(np.abs(cos - threshold) < 1e-9), strict=True):
                linked[i, j] = _cosine(tile["vector"][part[i]], tile["vector"][others[j]]) >= threshold
            linked &= part[:, None] != others[None, :]
            counts[a:a + _CHUNK] = linked @ n[others]
            for i, j in zip(*np.nonzero(linked), strict=True):
                p, q = find(part[i]), find(others[j])
                if p != q:
                    root[max(p, q)] = min(p, q)
                    links.append((part[i], others[j]))
        ends = np.array(links, np.int64).reshape(-1, 2)
        return pd.concat([
            pd.DataFrame({"link": False, "a": reps[homes], "b": counts, "_key": tile["_key"].to_numpy()[homes]}),
            pd.DataFrame({"link": True, "a": reps[ends[:, 0]], "b": reps[ends[:, 1]], "_key": np.int64(0)})])
    return run


def link_vectors(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for (vec_id, embedding, label), one row per row.

    Vectors of one label and one length link if their cosine, in double precision, is
    at least ``threshold``.  Equal vectors are joined once, with their number.  Vectors
    that are null, zero or hold null or non-finite components, vectors without a label
    and rows without an id link with nothing; a row without an id is not kept.  Rows
    with the same id are vectors of their own in ``n_links`` and share a component.
    An empty table gives no rows; other columns are ignored.
    """
    reach = float(np.sqrt(2 - 2 * threshold))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"), F.col("label").alias("label"),
        (usable(F.col("label"), F.col("embedding")) & F.col("vec_id").isNotNull()).alias("_usable"))
    rows = rows.withColumn("_key", F.xxhash64(F.col("label").cast("string"), "vector"))
    distinct = cut_lineage(rows.where("_usable").groupBy("label", "_key", "vector").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n")))
    cells = distinct.select(
        F.concat_ws("/", F.col("label").cast("string"), F.size("vector").cast("string")).alias("cell"),
        F.lit(True).alias("home"), "rep", "n", "_key", "vector")
    done = []
    for _ in range(LEVELS):
        counts = cut_lineage(cells.groupBy("cell").agg(F.sum(F.col("home").cast("long")).alias("homes"))
                             .where(F.col("homes") > CELL))
        if counts.isEmpty():
            break
        done.append(cells.join(counts, "cell", "left_anti"))
        cells = cut_lineage(_split(cells.join(counts, "cell", "left_semi"), counts, reach))
    for other in done:
        cells = cells.unionByName(other)
    # cells that are still large become tiles: blocks of home rows against blocks of all rows
    sizes = cells.groupBy("cell").agg(F.ceil(F.sum(F.col("home").cast("long")) / CELL).alias("_homes"),
                                      F.ceil(F.count("*") / CELL).alias("_all"))
    cells = cells.join(sizes, "cell")
    spread = F.xxhash64("_key", "rep")
    tiled = cells.withColumns({"_i": F.pmod(spread, F.greatest("_homes", F.lit(1))), "_j": F.pmod(spread, F.col("_all"))})
    across = F.transform(F.sequence(F.lit(0), F.col("_all") - 1), lambda j: F.struct(
        F.col("_i").alias("i"), j.cast("long").alias("j")))
    down = F.transform(F.sequence(F.lit(0), F.greatest("_homes", F.lit(1)) - 1), lambda i: F.struct(
        i.cast("long").alias("i"), F.col("_j").alias("j")))
    tiled = tiled.withColumn("_tile", F.explode(F.array_union(F.when(F.col("home"), across).otherwise(
        F.array().cast("array<struct<i:bigint,j:bigint>>")), down)))
    tiled = tiled.select("cell", "_tile.i", "_tile.j", "rep", "n", "_key", "vector",
                         (F.col("home") & (F.col("_tile.i") == F.col("_i"))).alias("as_home"),
                         (F.col("_tile.j") == F.col("_j")).alias("as_other"))
    found = cut_lineage(tiled.groupBy("cell", "i", "j").applyInPandas(
        _join_tile(threshold), "link boolean, a long, b long, _key long"))
    counted = found.where("not link").groupBy(F.col("a").alias("rep"), "_key").agg(F.sum("b").alias("_links"))
    named = components(found.where("link").select("a", "b"))
    known = (distinct.join(counted, ["rep", "_key"], "left")
             .join(named.withColumnRenamed("node", "rep"), "rep", "left")
             .select("label", "_key", "vector", "n", F.coalesce("_links", F.lit(0)).alias("_links"),
                     F.coalesce("component", "rep").alias("_component")))
    out = (rows.join(known.withColumn("_usable", F.lit(True)), ["_usable", "label", "_key", "vector"], "left")
           .select("vec_id", (F.coalesce("_links", F.lit(0)) + F.coalesce("n", F.lit(1)) - 1).alias("n_links"),
                   F.coalesce("_component", "vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CASE WHEN embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR isnan(x) OR isinf(x)]) = 0
      AND len([x FOR x IN embedding IF x <> 0]) > 0 THEN embedding::DOUBLE[] END AS e
  FROM embeddings
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e)
  WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
), comp AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT v.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, comp.component_id, v.vec_id = comp.component_id AS kept
FROM v LEFT JOIN n ON n.a = v.vec_id JOIN comp ON comp.a = v.vec_id
"""
