import os

import corpus_pipeline as cp
from conftest import SMALL
from procwarden.llm import jaccard_join, language, line_templates, mixing
from procwarden.llm.common import table
from procwarden.session import working_folder

FOLDER = SMALL.replace("0.001", "0.01")


def rows(df):
    return sorted(map(tuple, df.select(*cp.COLUMNS).collect()), key=str)


def test_stages(spark):
    """Every stage over what the one before kept; decisions as the operators make them."""
    assert [name for name, _ in cp.STAGES] == ["language_id", "line_dedup", "jaccard_join", "curriculum_mix", "sentencepiece"]
    docs = table(spark, FOLDER, "documents")
    kept = {}
    for name, stage in cp.STAGES:
        before, docs = docs, cp.cut_lineage(stage(spark, docs, FOLDER))
        kept[name] = docs.count()
        if name != "sentencepiece":
            assert docs.columns == cp.COLUMNS and docs.dtypes == before.select(*cp.COLUMNS).dtypes
        if name == "language_id":
            said = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(before, language.fit(before)).collect()}
            assert {r.doc_id for r in docs.collect()} == {
                d for d, (x, p) in said.items() if x != "und" and p >= cp.MIN_SCORE}
            assert kept[name] >= 0.99 * len(said)
        elif name == "line_dedup":
            want = {r.doc_id: r.text for r in line_templates.drop_recurring_lines(before).collect()
                    if not r.n_dropped or r.text.strip()}
            assert {r.doc_id: r.text for r in docs.collect()} == want
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        elif name == "jaccard_join":
            want = {r.doc_id for r in jaccard_join.join_documents(before).collect() if r.doc_id == r.component_id}
            assert {r.doc_id for r in docs.collect()} == want and len(want) < before.count()
        elif name == "curriculum_mix":
            want = []
            for r in mixing.mix_documents(before).collect():
                want += [r.doc_id] * sum(r.size > 0 and 2 * t >= r.size for t in (r.first_taken, r.second_taken))
            assert sorted(r.doc_id for r in docs.collect()) == sorted(want)
        else:
            assert kept[name] == before.count() and docs.where("NOT round_trip").count() == 0
    folder = working_folder(spark)
    cp._steps.remove(spark)
    before = set(os.listdir(folder))
    assert cp.run(spark, FOLDER).count() == kept["sentencepiece"]
    assert len(set(os.listdir(folder)) - before) == 1  # of all tables the result is left


def test_odd_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row string, size int"
    text = "the of and that is with " * 3
    odd = [(i, f"{text} w{i}a {'x' * i} y{i}", "en", None if i % 2 else "s", 3, "c", 1) for i in range(30)]
    odd += [(1, odd[1][1], "en", None, 3, "c", 1), (None, text, None, None, None, None, None), (50, None, None, "s", 1, "c", 1),
            (51, "", "en", "s", 0, "c", 1), (52, "12 34", "en", "s", 5, "c", 1), (53, "of that " * 30_000, "en", "t", 1, "c", 1)]
    for data in (odd, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in cp.STAGES:
            docs = cp.cut_lineage(stage(spark, docs, FOLDER))
        assert (docs.count() > 0) == bool(data)
