import numpy as np

from conftest import SMALL
from procwarden.llm import toxicity
from procwarden.llm.common import table

DOCS, LABELS = "doc_id long, text string, toxic int, features string", "doc_id long, quality int, toxic int"


def test_labels_are_learned(spark):
    folder = SMALL.replace("0.001", "0.1")
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    train = labels.where("doc_id % 3 != 0")
    got = toxicity.grade_documents(docs, toxicity.fit(docs, train)).join(
        labels.where("doc_id % 3 = 0").withColumnRenamed("toxic", "truth"), "doc_id").collect()
    truth, said = np.array([r.truth for r in got]), np.array([r.toxic for r in got])
    assert said[truth == 1].mean() > 0.9 and said[truth == 0].mean() < 0.01
    assert all(0 <= r.severity <= 3 and r.toxic == (r.p_toxic >= 0.5) for r in got)


def test_severity_follows_the_dose(spark):
    rng = np.random.default_rng(5)
    plain, bad = [f"word{i}" for i in range(60)], [f"bad{i}" for i in range(8)]
    docs = []
    for i in range(400):
        dose = (1, 3, 9)[i % 3] if i % 2 else 0
        docs.append((i, " ".join(list(rng.choice(plain, 40)) + list(rng.choice(bad, dose))), 7, "x"))
    odd = [(900, None, 1, None), (901, "", 1, None), (902, " ... ", 1, None), (None, "bad1 bad2 bad3 bad4", 1, None),
           (903, "word1 " * 30_000 + "BAD1 bad2 bad3 Bad4 bad5", 1, None), (904, "word1", 1, None), (904, "word1", 1, None)]
    df = spark.createDataFrame(docs + odd, DOCS).repartition(3)
    labels = spark.createDataFrame(
        [(i, 1, i % 2) for i in range(400)] + [(1, 1, 0), (2, None, None), (None, 0, 1), (5000, 1, 1)], LABELS)
    model = toxicity.fit(df, labels)
    got = toxicity.grade_documents(df, model).collect()
    assert len(got) == len(docs) + len(odd)
    by_id = {r.doc_id: r for r in got}
    mean = [np.mean([by_id[i].severity for i in range(400) if (i % 2, i % 3) == k])
            for k in ((0, 0), (1, 0), (1, 1), (1, 2))]
    assert mean[0] < 0.3 < mean[1] < mean[2] < mean[3]
    assert by_id[900].severity == by_id[901].severity == by_id[902].severity == 0
    assert by_id[903].toxic and by_id[None].toxic
    cuts = [r.weight for r in model.where("feature < 0").orderBy("feature").collect()]
    assert cuts == sorted(cuts, reverse=True)  # features -3, -2, -1


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "some text", 1, None)], DOCS)
    for rows in ([], [(1, 1, 0)], [(1, None, None)]):
        model = toxicity.fit(docs, spark.createDataFrame(rows, LABELS))
        assert [r.severity for r in toxicity.grade_documents(docs, model).collect()] == [0.0]
    none = docs.where("false")
    assert toxicity.grade_documents(none, toxicity.fit(none, spark.createDataFrame([], LABELS))).collect() == []
