import re
from itertools import permutations

import numpy as np

from check import compare, connect
from conftest import SMALL
from procwarden.llm import filter_audit as A

DOCS = "doc_id long, text string, source string, part string, bits int, digest string, good int, toxic string, n int"
LABELS = "doc_id long, quality int, toxic int, good string, n int"


def brute(docs, labels):
    """Every order applied to every document, one step after the other."""
    texts = [(i, t or "", s or "") for i, t, s in docs]

    def fails(i, t):
        words = re.findall("[^\x20\x09-\x0d]+", t)
        smaller = i is not None and any(j is not None and j < i and u == t for j, u, _ in texts)
        tests = [len(words) < 50, 100 * len(set(words)) < 65 * len(words),
                 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), re.search("[#$%&*|]", t), smaller]
        return {f for f, bad in zip("ABCDE", tests, strict=True) if bad}

    def marked(i, place):
        return i is not None and any(row[0] == i and row[place] == 1 for row in labels)

    facts = [(p, fails(i, t), marked(i, 1), marked(i, 2)) for i, t, p in texts]
    out, shapley = {}, {}
    for part in {p for p, *_ in facts}:
        rows = [f for f in facts if f[0] == part]
        for order in permutations("ABCDE"):
            left = rows
            for k, f in enumerate(order):
                lost = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                failing = [r for r in rows if f in r[1]]
                shapley[part, f] = shapley.get((part, f), 0) + len(lost)
                out[part, "".join(order), k + 1] = [
                    len(left), len(lost), len(failing) - len(lost), sum(r[1] == {f} for r in rows),
                    sum(r[2] for r in lost), sum(r[3] for r in lost)]
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(spark, docs, labels, parts=3):
    d = spark.createDataFrame([(*r, "x", 1, "y", 5, "z", 9) for r in docs], DOCS).repartition(parts)
    marks = spark.createDataFrame([(*r, "x", 1) for r in labels], LABELS)
    got = A.audit_filters(d, marks).collect()
    found = {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in got}
    assert len(found) == len(got)
    return found


def sample(n=240, seed=4):
    rng = np.random.default_rng(seed)
    words = ["alpha", "beta", "Gamma", "DELTA", "x#y", "10%", "eps", "zeta", "eta", "é", "\x0b", " ", "日本"]
    texts = ["  ".join(rng.choice(words[:rng.integers(3, 13)], rng.integers(0, 90))) for _ in range(40)]
    texts += [" ".join(f"w{i}{k}" for i in range(60)) for k in range(6)]
    texts += [None, "", " \t\n", "A", "#", "one " * 20_000, "Ab cd ef " * 7, "\x85 " * 60]
    docs = [(int(rng.integers(0, 200)), texts[rng.integers(len(texts))], ["web", "news", None, "", "b"][rng.integers(5)])
            for _ in range(n)]
    docs += [(None, texts[3], "web"), (None, texts[3], "b"), (5, "same", "b"), (5, "same", "b"), (5, "same", "c"), (-1, "same", "d")]
    labels = [(int(rng.integers(0, 220)), [0, 1, None][rng.integers(3)], [0, 1, None][rng.integers(3)]) for _ in range(150)]
    return docs, [*labels, (None, 1, 1)]


def test_every_order(spark):
    docs, labels = sample()
    assert audited(spark, docs, labels) == brute(docs, labels)


def test_labels_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr("procwarden.llm.common.BROADCAST_ROWS", 1)
    docs, labels = sample(60, 9)
    assert audited(spark, docs, labels, 1) == brute(docs, labels)


def test_steps_add_up(spark):
    docs, labels = sample(120, 1)
    sizes = {}
    for _, _, part in docs:
        sizes[part or ""] = sizes.get(part or "", 0) + 1
    found = audited(spark, docs, labels)
    for part, n in sizes.items():
        for order in permutations("ABCDE"):
            rows = [found[part, "".join(order), k] for k in range(1, 6)]
            assert sum(r[1] for r in rows) + rows[-1][0] == n


def test_no_rows(spark):
    assert audited(spark, [], []) == {}
    assert len(audited(spark, [(1, "A", None)], [])) == 600


def test_query_against_sql(spark):
    assert compare(spark, connect(SMALL), "op13_filter_audit", SMALL) == "ok"
