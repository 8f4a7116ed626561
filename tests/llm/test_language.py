import zlib

import numpy as np

from conftest import SMALL
from procwarden.llm import language
from procwarden.llm.common import table

SCHEMA = "doc_id long, text string, lang string, label string"


def test_held_out_accuracy(spark):
    docs = table(spark, SMALL.replace("0.001", "0.01"), "documents")
    got = language.identify(docs, language.fit(docs)).join(docs, "doc_id").where("held_out").collect()
    assert len(got) > 150
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_edge_cases(spark):
    train = [(i, "der die das und nicht ein" if i % 2 else "the of and that is with", "de" if i % 2 else "en", "x")
             for i in range(80)]
    odd = [(1000, None, "de", "x"), (1001, "", None, "x"), (1002, "12 .. 7", "en", "x"), (None, "the the", None, "x"),
           (1003, "the that of \U00020000" * 40_000, "zz", None), (1004, "\U0001F600", "en", "x"), (1004, "das und", "en", "x")]
    df = spark.createDataFrame(train + odd, SCHEMA).repartition(3)
    got = language.identify(df, language.fit(spark.createDataFrame(train, SCHEMA))).collect()
    assert len(got) == len(train) + len(odd)
    for r in got:
        assert r.held_out == (zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 4 == 2)
    by_id = {r.doc_id: r.lang_pred for r in got if r.doc_id != 1004}
    assert [by_id[i] for i in (1000, 1001, 1002)] == ["und"] * 3
    assert by_id[None] == by_id[1003] == "en" and by_id[1] == "de" and by_id[2] == "en"
    assert sorted(r.lang_pred for r in got if r.doc_id == 1004) == ["de", "und"]


def test_nothing_to_learn(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert language.identify(none, language.fit(none)).collect() == []
    some = spark.createDataFrame([(1, "abc", None, None)], SCHEMA)
    assert [r.lang_pred for r in language.identify(some, language.fit(some)).collect()] == ["und"]


def test_blocks_change_nothing(monkeypatch):
    texts = ["abc déf " * 9, "", "x", "中文 text"]
    def sums():
        out = [0] * len(texts)
        for owner, _, grams in language.Grams().blocks(texts):
            for g in grams:
                for o, x in zip(owner, g):
                    out[o] += int(x) ** 2
        return out
    whole = sums()
    monkeypatch.setattr(language, "BLOCK", 7)
    assert sums() == whole


def test_every_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 200)
    names = [chr(0x4E00 + 7 * k) * 2 for k in range(70)]  # a language is a word of its own
    rows = [(100 * k + i, f"{w} {w}", f"l{k}", "x") for k, w in enumerate(names) for i in range(30 if k else 900)]
    rows += [(i, "zq zq", "rare", "x") for i in range(10_000, 10_100) if zlib.crc32(str(i).encode()) % 4 == 3][:1]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    model = language.fit(df)
    assert {r.label for r in model.where("feature = -1").collect()} == {f"l{k}" for k in range(70)} | {"rare"}
    got = language.identify(spark.createDataFrame([(k, f"{w} {w}", None, None) for k, w in enumerate([*names, "zq"])], SCHEMA), model)
    assert {r.doc_id: r.lang_pred for r in got.collect()} == {k: f"l{k}" if k < 70 else "rare" for k in range(71)}


def test_a_language_that_the_draw_leaves_out_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE", 0)  # nothing is drawn
    df = spark.createDataFrame([(i, w * 3, k, "x") for i in range(40) for k, w in (("a", "foo "), ("b", "bar "))], SCHEMA)
    model = language.fit(df)
    assert {r.label for r in model.where("feature = -1").collect()} == {"a", "b"}
