import math

import numpy as np
import pytest

from check import compare, connect
from conftest import SMALL
from procwarden.llm import metric_join as mj
from procwarden.llm.graph import components

SCHEMA = "vec_id long, embedding array<float>, label int, cell string, n long"


def expected(rows):
    def usable(v):
        return (v[1] is not None and v[2] is not None and v[0] is not None
                and all(x is not None and math.isfinite(x) for x in v[1]) and any(v[1]))
    n = len(rows)
    linked = [set() for _ in range(n)]
    for i in range(n):
        for j in range(i):
            a, b = rows[i], rows[j]
            if usable(a) and usable(b) and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = (np.array(v[1], np.float32).astype(float) for v in (a, b))
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= mj.THRESHOLD:
                    linked[i].add(j)
                    linked[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            k = todo.pop()
            more = linked[k] | ({m for m in range(n) if rows[m][0] == rows[k][0] and usable(rows[m])} if usable(rows[k]) else set())
            todo += more - seen
            seen |= more
        comp = min((rows[k][0] for k in seen), default=None) if rows[i][0] is not None else None
        out.append((rows[i][0], len(linked[i]), comp, comp is not None and comp == rows[i][0]))
    return out


def sample_rows(seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(25):
        centre = rng.normal(size=8)
        for _ in range(rng.integers(1, 9)):
            rows.append([len(rows), (centre + rng.normal(size=8) * 0.22).astype(np.float32).tolist(), int(c % 3)])
    copy = rows[4][1]
    rows += [[500 + i, copy, rows[4][2]] for i in range(30)]  # copies
    rows += [[600, [2.0 * x for x in copy], rows[4][2]], [601, copy, None], [602, None, 1], [603, [0.0] * 8, 1],
             [604, [1.0] * 7 + [float("nan")], 1], [605, [1.0] * 7 + [None], 1], [606, [1e-30] * 8, 1],
             [607, [1.0] * 8, 1], [None, copy, rows[4][2]], [608, [1.0] * 4, 1], [609, [], 1], [610, [float("inf")] * 8, 1]]
    return rows


def key(row):
    return (row[0] is not None, row[0], row[1:])


@pytest.mark.parametrize("cell,levels", [(10_000, 4), (12, 4), (6, 1)])  # one cell, pivots, tiles
def test_against_brute_force(spark, monkeypatch, cell, levels):
    monkeypatch.setattr(mj, "CELL", cell)
    monkeypatch.setattr(mj, "LEVELS", levels)
    rows = sample_rows()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in mj.link_vectors(df).collect()]
    assert sorted(got, key=key) == sorted(expected(rows), key=key)


def test_empty(spark):
    assert mj.link_vectors(spark.createDataFrame([], SCHEMA)).collect() == []


def test_against_sql(spark):
    assert compare(spark, connect(SMALL), "op9_metric_range_join", SMALL) == "ok"


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(i, i + 1) for i in range(50, 90)] + [(200 + i, 200) for i in range(60)] + [(5, 5), (7, None), (90, 300)]
    links += [(int(a), int(b)) for a, b in rng.integers(1000, 1200, (150, 2))]
    root = {}
    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        if b is not None and a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == {x: find(x) for x in root}
