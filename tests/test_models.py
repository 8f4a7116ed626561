import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from procwarden.operators import ensemble as M
from procwarden.operators import neighbours as N
from procwarden.operators import ordered
from procwarden.operators.boundary import (
    LIFTED, _by_value, boundary_score, fit_boundary, kernel_mean, lift, lowest_mean, make_directions, slices,
)
from procwarden.operators.forest import draw_samples, fit_forest, forest_score, mean_path, node_arrays
from procwarden.operators.lookup import lookup_join
from procwarden.operators.scaling import distinct_vectors, fit_stats, row_vectors
from procwarden.plans.catalog import CHECKS
from procwarden.session import step_tables
from procwarden.sources import model_store as MS


def points(spark, n=600, seed=5, width=3):
    """Clustered vectors; the first one is held by a third of all rows."""
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, width)) + 6 * rng.integers(0, 3, (n, 1)), 2)
    copies = rng.integers(1, 4, n)
    copies[0] = copies.sum() // 2
    rows = [(i, int(c), v.tolist()) for i, (c, v) in enumerate(zip(copies, x))]
    return spark.createDataFrame(rows, "vid long, copies long, x array<double>"), x, copies


def all_distances(a, b):
    return np.round(np.sqrt(((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2)), N.DIGITS)


def brute_factors(x, copies, queries, k):
    def near(d, drop=None):
        out, left = [], k
        for j in np.argsort(d, kind="stable"):
            take = min(copies[j] - (j == drop), left)
            if take > 0:
                out.append((j, take))
                left -= take
            if not left:
                break
        return out

    own = all_distances(x, x)
    fit = [near(own[i], i) for i in range(len(x))]
    kdist = np.array([max(own[i][j] for j, _ in f) for i, f in enumerate(fit)])

    def density(d, found):
        return 1 / (sum(t * max(d[j], kdist[j]) for j, t in found) / k + 1e-10)

    dens = np.array([density(own[i], f) for i, f in enumerate(fit)])
    out = []
    for d in all_distances(queries, x):
        found = near(d)
        out.append(sum(t * dens[j] for j, t in found) / k / density(d, found))
    return np.array(out)


@pytest.mark.parametrize("block_bytes, chunk", [(N.BLOCK_BYTES, N.CHUNK_CELLS), (4000, 500), (1200, 1)])
def test_outlier_factor_is_exact(spark, monkeypatch, block_bytes, chunk):
    """One block and several, against all pairs; a vector holds a third of all rows."""
    monkeypatch.setattr(N, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(N, "CHUNK_CELLS", chunk)
    df, x, copies = points(spark, 300)
    model, own = N.fit_outliers(df, int(copies.sum()), 3, 7)
    assert (model.blocks == 1) == (block_bytes == 64_000_000)
    got = np.array([r["lof"] for r in own.orderBy("vid").collect()])
    np.testing.assert_allclose(got, brute_factors(x, copies, x, 7), rtol=1e-9)
    asked = np.round(np.random.default_rng(1).uniform(-5, 20, (60, 3)), 3)
    asked[::7] = x[5]  # equal vectors, and equal to one of the reference
    queries = spark.createDataFrame([(1000 + i, v.tolist()) for i, v in enumerate(asked)], "vid long, x array<double>")
    got = np.array([r["lof"] for r in N.outlier_factors(queries, model).orderBy("vid").collect()])
    np.testing.assert_allclose(got, brute_factors(x, copies, asked, 7), rtol=1e-9)


def test_nearest_orders_ties():
    """Many equal distances, far vectors, and fewer rows than neighbours."""
    rng = np.random.default_rng(2)
    refs, vids = rng.integers(0, 3, (200, 4)).astype(float), rng.permutation(200)
    x = np.r_[refs[:20], rng.integers(0, 3, (20, 4)) * 1e4]
    for k in (1, 5, 200, 300):
        places, dist = N.nearest(x, refs, vids, k)
        for i, d in enumerate(all_distances(x, refs)):
            want = np.lexsort((vids, d))[:k]
            assert places[i].tolist() == want.tolist() and dist[i].tolist() == d[want].tolist()


def test_events_do_not_move(spark, labelled):
    """The plan that scores events has no exchange; the reference is bounded by the option."""
    model = M.fit_model(labelled.filter("label = 'benign'"), parts=("lof",), neighbours=5, reference=100)
    assert 50 <= model.lof.refs.agg(F.sum("copies")).first()[0] <= 150
    plan = M.score(labelled, model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def many_rows(spark, n=12_000):
    """Benign rows, more than a bounded reference or a pool of the trees would hold."""
    rng = np.random.default_rng(9)
    rows = zip(range(n), rng.integers(20, 400, n).tolist(), np.round(rng.normal(4, 0.5, n), 4).tolist(), rng.integers(0, 24, n).tolist())
    return spark.createDataFrame([*rows], "event_id long, command_line_length int, command_line_entropy double, hour_of_day int")


@pytest.mark.parametrize("block_bytes", [N.BLOCK_BYTES, 200_000])
def test_density_is_fitted_on_all_rows(spark, monkeypatch, block_bytes):
    """The ensemble's density and the range of its scores, against all pairs of all benign rows."""
    monkeypatch.setattr(N, "BLOCK_BYTES", block_bytes)
    rows = many_rows(spark)
    model = M.fit_model(rows, parts=("lof",), neighbours=5)
    assert model.lof.refs.agg(F.sum("copies")).first()[0] == 12_000
    known = model.lof.refs.orderBy("vid").toPandas()
    x = np.stack(known["x"].to_numpy())
    assert (known["copies"] == 1).all()
    found = []
    for i in range(0, len(x), 500):
        d = all_distances(x[i:i + 500], x)
        some = np.sort(np.argpartition(d, 40, axis=1)[:, :40], axis=1)
        found.append(np.take_along_axis(some, np.argsort(np.take_along_axis(d, some, 1), axis=1, kind="stable")[:, :6], 1))
    nearest = np.concatenate(found)
    dist = np.stack([all_distances(x[i:i + 1], x[near])[0] for i, near in enumerate(nearest)])
    kdist = dist[:, 5]
    np.testing.assert_array_equal(known["kdist"], kdist)
    density = 1 / (np.maximum(dist[:, 1:], kdist[nearest[:, 1:]]).mean(axis=1) + 1e-10)
    np.testing.assert_allclose(known["density"], density, rtol=1e-9)
    factors = density[nearest[:, :5]].mean(axis=1) * (np.maximum(dist[:, :5], kdist[nearest[:, :5]]).mean(axis=1) + 1e-10)
    np.testing.assert_allclose(model.ranges["lof"], (factors.min(), factors.max()), rtol=1e-9)


def test_trees_draw_from_all_rows(spark):
    """m11_ensemble, u4_detect_full_ensemble: the trees' samples are of all rows, in code and SQL; a pool is asked for by name."""
    rows = spark.range(4000).select(F.col("id").alias("event_id"), F.array(F.col("id").cast("double")).alias("x"))
    seen = [draw_samples(rows, 4000, 100, 16, 42, pool_samples=p).select("event_id").distinct().count() for p in (None, 64)]
    assert seen[0] > 2000 > 1200 > seen[1]
    for key, cut in (("m11_ensemble", False), ("u4_detect_full_ensemble", False), ("m05_forest_score", True), ("m06_outlier_factor", True)):
        assert ("'pool:" in CHECKS[key] or "'density:" in CHECKS[key]) == cut


def test_several_blocks_score_events_alike(spark, labelled, monkeypatch):
    model = M.fit_model(labelled.filter("label = 'benign'"), trees=10, steps=2, rff=32, neighbours=5)
    one = {r.event_id: r.ml_anomaly_score for r in M.score(labelled, model).collect()}
    monkeypatch.setattr(N, "BLOCK_BYTES", 2000)
    assert model.lof.blocks > 3
    for r in M.score(labelled, model).collect():
        assert r.ml_anomaly_score == pytest.approx(one[r.event_id], abs=1e-9)


def test_own_vectors_are_not_searched_for_again(spark, labelled, monkeypatch):
    """Several blocks: only vectors that the model does not know are searched for, and factors are those of a full search."""
    monkeypatch.setattr(N, "BLOCK_BYTES", 4000)
    model = M.fit_model(labelled.filter("label = 'benign'"), parts=("lof",), neighbours=5)
    vectors, asked, near = distinct_vectors(labelled, model.stats), [], N._near
    monkeypatch.setattr(N, "_near", lambda queries, *rest: asked.append(queries.count()) or near(queries, *rest))
    some = {r.vid: r.lof for r in N.outlier_factors(vectors, model.lof).collect()}
    every = {r.vid: r.lof for r in N.outlier_factors(vectors.select("vid", "x"), model.lof).collect()}
    assert model.lof.blocks > 1 and asked == [vectors.count() - model.lof.rows, vectors.count()]
    assert some.keys() == every.keys() and all(some[v] == pytest.approx(every[v], rel=1e-12) for v in every)


def test_forest_does_not_depend_on_partitions(spark):
    df, x, _ = points(spark, 400)
    rows = df.select(F.col("vid").alias("event_id"), "x")
    far = spark.createDataFrame([(0, [50.0, -50.0, 50.0]), (1, x.mean(axis=0).tolist())], "id int, x array<double>")
    seen = []
    for parts in (1, 8):
        forest = fit_forest(rows.repartition(parts), 400, trees=30, sample=64)
        assert forest.nodes.groupBy("tree").count().count() == 30
        seen.append([r[0] for r in far.orderBy("id").select(forest_score(forest, F.col("x"))).collect()])
    assert seen[0] == seen[1] and seen[0][0] > seen[0][1]


def test_kernel_mean_and_boundary(spark):
    df, x, copies = points(spark, 200)
    b = make_directions(3, 64)
    z = lift(x, b)
    want = (copies[:, None] * z).sum(axis=0) / copies.sum()
    np.testing.assert_allclose(kernel_mean(df, b).weights, want, atol=1e-12)
    fitted = fit_boundary(df, 3, 64, steps=8)
    far = lift(np.array([[60.0, -60.0, 60.0]]), fitted) @ fitted.weights
    assert far[0] < np.quantile(z @ fitted.weights, 0.05)


@pytest.fixture(scope="module")
def labelled(spark):
    """Benign rows and odd rows over a few model columns."""
    rng = np.random.default_rng(3)
    rows = []
    for i in range(260):
        odd = i >= 200
        rows.append((i, "malicious" if odd else "benign", int(rng.integers(20, 60) + 200 * odd),
                     float(np.round(rng.normal(4, 0.2) + 1.5 * odd, 4)), int(odd), int(rng.integers(8, 18)) if not odd else 3))
    return spark.createDataFrame(rows, "event_id long, label string, command_line_length int, "
                                       "command_line_entropy double, has_suspicious_flag int, hour_of_day int")


def test_ensemble(spark, labelled, tmp_path):
    benign = labelled.filter("label = 'benign'")
    model = M.fit_model(benign, trees=40, steps=4, rff=64)
    assert model.parts == ["forest", "lof", "boundary"] and sum(model.weights.values()) == pytest.approx(1.0)
    got = M.score(labelled, model)
    s = got.groupBy("label").agg(F.avg("ml_anomaly_score").alias("m"), F.min("ml_anomaly_score").alias("lo"),
                                 F.max("ml_anomaly_score").alias("hi")).collect()
    means = {r["label"]: r["m"] for r in s}
    assert means["malicious"] > means["benign"] and all(0 <= r["lo"] and r["hi"] <= 100 for r in s)
    assert got.count() == 260
    path = str(tmp_path / "model")
    MS.save_model(spark, model, path)
    again = M.score(labelled, MS.load_or_fit(benign, path, trees=40, steps=4, rff=64))
    diff = got.alias("a").join(again.alias("b"), "event_id").agg(
        F.max(F.abs(F.col("a.ml_anomaly_score") - F.col("b.ml_anomaly_score")))).first()[0]
    assert diff < 1e-6
    with pytest.raises(ValueError):
        MS.load_or_fit(benign.filter("event_id < 100"), path, trees=40, steps=4, rff=64)
    for other in ({}, {"trees": 40, "steps": 4, "rff": 64, "parts": ("boundary",)}):
        with pytest.raises(ValueError, match="was fitted with"):
            MS.load_or_fit(benign, path, **other)


def test_stored_model_whatever_the_order_of_sums(spark, tmp_path):
    """The mean of a standardised column is rounding noise, which depends on the order of the rows."""
    x = np.random.default_rng(9).normal(size=400)
    z = (x - x.mean()) / x.std()
    rows = spark.createDataFrame([(i, float(v), 7) for i, v in enumerate(z)],
                                 "event_id long, entropy_zscore double, hour_of_day int")
    up, down = (rows.coalesce(1).sortWithinPartitions(F.expr(f"{sign} event_id")) for sign in "+-")
    assert fit_stats(up).mean != fit_stats(down).mean
    path = str(tmp_path / "model")
    first = MS.load_or_fit(up, path, parts=("boundary",), steps=0)
    assert MS.load_or_fit(down, path, parts=("boundary",), steps=0).stats.rows == first.stats.rows
    moved = down.withColumn("entropy_zscore", F.col("entropy_zscore") + 0.01)
    for other in (moved, down.withColumn("hour_of_day", F.lit(8)), down.unionAll(down)):
        with pytest.raises(ValueError, match="another baseline"):
            MS.load_or_fit(other, path, parts=("boundary",), steps=0)


def test_explanation(labelled):
    stats = fit_stats(labelled.filter("label = 'benign'"))
    text = labelled.filter("event_id = 259").withColumn("s", F.lit(85.0)).select(
        F.expr(M.explanation(stats, labelled.columns, "s"))).first()[0]
    assert text.startswith("ANOMALY SCORE: 85/100 | Unusual factors: suspicious command line flags detected: 1.00")
    assert "unusually long command line" in text
    typical = labelled.limit(1).selectExpr(*[
        f"{m}D AS {c}" for c, m in zip(stats.columns, stats.mean)])
    assert typical.select(F.expr(M.explanation(stats, typical.columns))).first()[0] == (
        "ANOMALY ANALYSIS | No significantly unusual features detected.")


def test_no_model_columns(spark):
    with pytest.raises(ValueError):
        fit_stats(spark.range(3))


def test_quantiles(spark, monkeypatch):
    monkeypatch.setattr(ordered, "RANGE_ROWS", 10)
    rng = np.random.default_rng(0)
    data = {g: np.round(rng.normal(size=n), 1) for g, n in [("a", 101), ("b", 64), ("c", 1)]}
    df = spark.createDataFrame([(g, float(v)) for g, vs in data.items() for v in vs], "g string, v double")
    counts = df.groupBy("g", "v").agg(F.count("*").alias("_n"))
    for r in ordered.exact_quantiles(counts, "g", "v", {"q1": 0.25, "q2": 0.5, "q4": 1.0}, counts.count()).collect():
        np.testing.assert_allclose([r["q1"], r["q2"], r["q4"]], np.quantile(data[r["g"]], [0.25, 0.5, 1.0]), atol=1e-12)


def test_lookup_ways_agree(spark):
    events = spark.range(500).select(F.col("id").alias("event_id"), F.when(F.col("id") % 3 > 0, 0).otherwise(
        F.col("id") % 50).alias("k"))
    table = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    small = sorted(map(tuple, lookup_join(events, table, ["k"], 40).collect()))
    large = sorted(map(tuple, lookup_join(events, table, ["k"], 40, broadcast_rows=1).collect()),)
    assert len(small) == 500 and [r[:2] for r in small] == [r[:2] for r in large]
    assert sorted((r[0], r[2] or -1) for r in small) == sorted((r[0], r[2] or -1) for r in large)


def test_boundary_keeps_every_row(spark):
    """Few varying columns: the weights stay bounded and every step sees all rows."""
    rng = np.random.default_rng(8)
    x = np.zeros((400, 24))
    x[:, 0], x[:, 1] = rng.normal(size=400), rng.integers(0, 2, 400) * 3.0
    copies = rng.integers(1, 4, 400)
    df = spark.createDataFrame([(i, int(c), [float(v) for v in row]) for i, (row, c) in enumerate(zip(x, copies))],
                               "vid long, copies long, x array<double>")
    first = make_directions(24, 64)
    for steps in (1, 6):
        fitted = fit_boundary(df, 24, 64, steps=steps)
        assert np.linalg.norm(fitted.weights) <= np.sqrt(2) + 1e-9
        counts, _ = _by_value(df, first, fitted.weights)
        assert counts.sum() == copies.sum()
    odd = lift(np.full((1, 24), 9.0), fitted) @ fitted.weights
    assert odd[0] < np.quantile(lift(x, fitted) @ fitted.weights, 0.2)


def test_lowest_mean():
    counts, sums = np.array([0.0, 2.0, 4.0]), np.array([[0.0], [2.0], [40.0]])
    np.testing.assert_allclose(lowest_mean(counts, sums, 0.5), [(2.0 + 10.0) / 3.0])  # three of six rows


def test_large_lookup_moves_rows_once(spark):
    """No copies of the table; a key with a third of all events is split."""
    rows = 30_000
    text = F.sha2(F.col("id").cast("string"), 512)
    events = spark.range(rows).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), text.alias("t"))
    table = spark.range(rows).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k", "spark.sql.shuffle.partitions": "16",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = lookup_join(events.repartition(8), table, ["k"], rows, broadcast_rows=1)
        got = joined.agg(F.count("*").alias("n"), F.sum((F.col("v") == F.col("k") * 2).cast("int")).alias("right"),
                         F.countDistinct("t").alias("texts"))
        assert got.collect()[0].asDict() == {"n": rows, "right": rows, "texts": rows}
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan and "Generate" not in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_in_levels(spark, monkeypatch, descending):
    """Ranges of ranges: as many levels as it takes, no window over more rows than a range has."""
    monkeypatch.setattr(ordered, "RANGE_ROWS", 7)
    rng = np.random.default_rng(6)
    rows = [(g, int(v), int(rng.integers(1, 9))) for g in "ab" for v in rng.choice(5000, 300, replace=False)]
    df = spark.createDataFrame(rows, "g string, v long, n long").repartition(5)
    got = ordered.running_totals(df, "v", {"n": "upto"}, len(rows), ["g"], descending).collect()
    for g in "ab":
        own = sorted((r for r in rows if r[0] == g), key=lambda r: r[1], reverse=descending)
        want = dict(zip([r[1] for r in own], np.cumsum([r[2] for r in own]), strict=True))
        assert {r["v"]: r["upto"] for r in got if r["g"] == g} == want
    assert len(got) == len(rows)


def test_row_at_a_position(spark, monkeypatch):
    rng = np.random.default_rng(7)
    keys = sorted(int(k) for k in rng.choice(10**6, 500, replace=False))
    df = spark.createDataFrame([(k,) for k in keys], "event_id long").repartition(6)
    for size in (200_000, 20, 3):
        monkeypatch.setattr(ordered, "RANGE_ROWS", size)
        for at in (0, 1, 250, 498, 499):
            assert [r[0] for r in ordered.at_position(df, "event_id", at).collect()] == [keys[at]]
        assert ordered.at_position(df, "event_id", 500).count() == 0
    same = spark.createDataFrame([(5,)] * 40, "event_id long")
    assert [r[0] for r in ordered.at_position(same, "event_id", 30).collect()] == [5]
    assert ordered.at_position(same.limit(0), "event_id", 0).count() == 0


def test_rows_are_fitted_where_they_lie(spark, labelled):
    """Forest and boundary move no row to merge equal ones; the fit is that of the distinct vectors with counts."""
    benign = labelled.filter("label = 'benign'")
    doubled = benign.unionAll(benign.withColumn("event_id", F.col("event_id") + 1000))
    stats = fit_stats(doubled)
    rows, merged = row_vectors(doubled, stats), distinct_vectors(doubled, stats)
    assert rows.count() == stats.rows == merged.agg(F.sum("copies")).first()[0] > merged.count()
    fitted = [fit_boundary(v, len(stats.columns), 32, steps=4).weights for v in (rows, merged)]
    assert np.allclose(*fitted, atol=1e-9)
    again = M.fit_model(doubled, ("boundary",), rff=32, steps=4).boundary.weights
    assert np.allclose(fitted[1], again, atol=1e-9)


@pytest.mark.parametrize("size", [1, 3, 16])
def test_nearest_by_groups(monkeypatch, size):
    """Whatever the groups' size, the nearest are those of all distances, ties by id among them."""
    monkeypatch.setattr(N, "GROUP", size)
    rng = np.random.default_rng(5)
    refs, x, vids = np.round(rng.normal(size=(1000, 3))), np.round(rng.normal(size=(40, 3))), rng.permutation(1000)
    places, dist = N.nearest(x, refs, vids, 6)
    for i, row in enumerate(x):
        every = np.round(np.sqrt(((row - refs) ** 2).sum(axis=1)), N.DIGITS)
        want = np.lexsort((vids, every))[:6]
        assert places[i].tolist() == want.tolist() and dist[i].tolist() == every[want].tolist()


def test_forest_filled_up_to_one_depth():
    """A leaf far above the last level keeps its path; before, rows were moved through masks of open nodes."""
    nodes = pd.DataFrame([(0, 1, 0, 0.5, 0.0), (0, 2, -1, 0.0, 1.5), (0, 3, 1, 2.0, 0.0), (0, 6, -1, 0.0, 2.5), (0, 7, -1, 0.0, 3.5),
                          (2, 1, -1, 0.0, 9.0)], columns=["tree", "node", "feature", "threshold", "path"])
    arrays = node_arrays(nodes)
    assert arrays["levels"] == 3
    x = np.array([[0.5, 9.0], [0.6, 2.0], [0.6, 2.1]])
    assert mean_path(x, arrays).tolist() == [5.25, 5.75, 6.25]


def test_statistics_over_tasks(spark):
    """A constant column has no deviation, however its rows are dealt out, and another one its exact moments."""
    df = spark.range(1000).repartition(7).select(F.lit(0.1).alias("command_line_entropy"), (F.col("id") + 1e6).alias("command_line_length"))
    stats = fit_stats(df)
    at = {c: i for i, c in enumerate(stats.columns)}
    i, j = at["command_line_entropy"], at["command_line_length"]
    assert (stats.mean[i], stats.std[i], stats.scale[i], stats.rows) == (0.1, 0.0, 1.0, 1000)
    assert stats.mean[j] == pytest.approx(1000499.5, abs=1e-6) and stats.std[j] == pytest.approx(np.arange(1000).std(), rel=1e-9)
    assert (stats.low[j], stats.high[j]) == (1e6, 1e6 + 999)


def test_two_passes_write_no_vectors(spark, labelled):
    """m08_kernel_mean and all queries of ``detected``: the kernel mean is fitted without a second table of the rows."""
    benign = labelled.filter("label = 'benign'")
    with step_tables(spark) as steps:
        plain = M.fit_model(benign, ("boundary",), rff=32, steps=0)
        assert not steps.paths
        vectors = row_vectors(benign, plain.stats)
        assert len(steps.paths) == 1
        written = fit_boundary(vectors, len(plain.stats.columns), 32, steps=0)
        low, high = vectors.agg(F.min(boundary_score(written, F.col("x"))), F.max(boundary_score(written, F.col("x")))).first()
    assert np.allclose(plain.boundary.weights, written.weights, atol=1e-12)
    assert np.allclose(plain.ranges["boundary"], (low, high), atol=1e-12)


def test_rows_are_lifted_in_slices(spark):
    """No more than ``LIFTED`` rows are lifted at once, and every row gets its own score."""
    x = np.random.default_rng(3).normal(size=(2 * LIFTED + 5, 4))
    b = make_directions(4, 16)
    b.weights = np.linspace(-1, 1, 16)
    df = spark.createDataFrame([(v.tolist(), 1) for v in x], "x array<double>, copies long").coalesce(1)
    want = -(np.sqrt(2 / 16) * np.cos(x @ b.directions + b.phases) @ b.weights)
    got = [r[0] for r in df.select(boundary_score(b, F.col("x"))).collect()]
    np.testing.assert_allclose(got, want, atol=1e-12)
    assert [s.stop - s.start for s in slices(x)] == [LIFTED] * 3
    np.testing.assert_allclose(kernel_mean(df, b).weights, lift(x, b).mean(axis=0), atol=1e-12)
