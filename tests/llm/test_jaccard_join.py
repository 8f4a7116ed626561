import re

import numpy as np
import pytest

from conftest import SMALL
from procwarden.llm import jaccard_join as jj
from procwarden.llm.common import table

SCHEMA = "doc_id long, text string, id long, comp string"


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def expected(rows):
    sets = [shingles(t) for _, t in rows]
    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    root = list(range(len(rows)))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, s in enumerate(sets):
        near = {}
        for x in s:
            for j in holders[x]:
                if j < i:
                    near[j] = near.get(j, 0) + 1
        for j, both in near.items():
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(rows))


def sample_rows():
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choice(vocabulary, 60))
    rows = []
    for _ in range(40):
        base = list(rng.choice(vocabulary, rng.integers(3, 120)))
        for _ in range(rng.integers(1, 8)):
            text = base[:]
            for _ in range(rng.integers(0, 5)):
                text[rng.integers(len(text))] = str(rng.choice(vocabulary))
            rows.append(" ".join(text).upper() if rng.random() < 0.3 else "\t".join(text))
    chain = [f"c{i}" for i in range(100)]  # each like its neighbours, the ends unlike
    rows += [" ".join(chain[i:i + 60]) for i in range(0, 30, 3)]
    rows += [passage + " " + " ".join(rng.choice(vocabulary, rng.integers(1, 90))) for _ in range(60)]
    rows += ["a b c d e"] * 12 + ["A B C D E", "a b c d", "a b c", "", " \x0b\n", None, "x" * 9000, "é É   z", "long one " * 20_000]
    return [(i * 7 + 3, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("block,rounds,sample", [(256, 2, 4_000), (4, 0, 4_000), (3, 1, 0)])
def test_against_brute_force(spark, monkeypatch, block, rounds, sample):
    """Large and tiny blocks, without leaders, and without frequent shingles: always the same."""
    monkeypatch.setattr(jj, "BLOCK", block)
    monkeypatch.setattr(jj, "ROUNDS", rounds)
    monkeypatch.setattr(jj, "SAMPLE", sample)
    rows = sample_rows()
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(4)
    assert sorted(tuple(r) for r in jj.join_documents(df).collect()) == expected(rows)


def test_whole_table(spark):
    docs = table(spark, SMALL.replace("0.001", "0.01"), "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in jj.join_documents(docs).collect()) == expected(rows)


def test_odd_rows(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert jj.join_documents(df).collect() == []
    df = spark.createDataFrame([(None, "a b c d e f", 1, None), (5, "a b c d e f", 1, None), (5, "a b c d e f", 1, None),
                                (9, "A b c d e f", 2, None)], SCHEMA)
    got = sorted((tuple(r) for r in jj.join_documents(df).collect()), key=str)
    assert got == [(5, 2, 5), (5, 2, 5), (9, 2, 5), (None, 2, None)]


@pytest.mark.parametrize("turned", [False, True])
def test_unlike_texts_under_one_id(spark, turned):
    """No link is lost, whatever the order of the rows."""
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    rows = [(1, a), (1, b), (2, b + " more"), (3, a + " more"), (1, b), (7, a), (7, None), (None, a), (None, ""), (4, "x y")]
    df = spark.createDataFrame([(*r, 1, "x") for r in (rows[::-1] if turned else rows)], SCHEMA).coalesce(1)
    got = sorted((tuple(r) for r in jj.join_documents(df).collect()), key=str)
    want = [(1, 56, 1), (1, 56, 1), (1, 56, 1), (2, 57, 1), (3, 57, 1), (7, 56, 1), (7, 0, 7), (4, 1, 4), (None, 56, None),
            (None, 0, None)]
    assert got == sorted(want, key=str)


def test_bounds_hold():
    rng = np.random.default_rng(4)
    for _ in range(500):
        a = np.unique(rng.integers(0, 400, rng.integers(1, 300)) * 0x9E3779B97F4A7)
        b = np.unique(np.concatenate([a[rng.random(len(a)) < rng.random() * 0.4 + 0.6], rng.integers(0, 99, rng.integers(0, 9))]))
        assert jj.overlap(a, b) == len(set(a) & set(b))
        if jj.overlap(a, b) >= jj.needed(len(a), len(b)):
            assert jj.may_link(len(a), len(b), jj.bitmap(a), jj.bitmap(b))
