import hashlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from procwarden.llm import fingerprint as fp


def expected(rows):
    rows = sorted(rows, key=lambda r: ((r[0] is not None, r[0]), r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        a, b, c = (fp.fingerprint(x)[0] for x in (text, edited, after))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b,
                    fp.likeness(a, b), fp.likeness(a, c), ",".join(map(str, fp.locate_edits(a, b)))))
    return out


ROWS = [(i * 3, t) for i, t in enumerate(
    ["one\ntwo\n\n# three\nfour", "", None, "é" * 700, "same text here", "same text here", "x" * 50_000,
     "a\U0001F600b " * 40, " \n \n", "At " * 900])] + [(None, "no id"), (27, "again"), (27, "again")]


def key(row):
    return (row[0] is not None, row[0], row[1:])


def test_against_brute_force(spark, monkeypatch):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in ROWS], "doc_id long, text string, bucket string, carry int")
    for size in (fp.RANGE_BYTES, 9_000):  # one range, and many
        monkeypatch.setattr(fp, "RANGE_BYTES", size)
        got = [tuple(r) for r in fp.fingerprint_documents(df.repartition(3)).collect()]
        assert sorted(got, key=key) == sorted(expected(ROWS), key=key)


def test_empty_and_single(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fp.fingerprint_documents(empty).collect() == []
    one = fp.fingerprint_documents(spark.createDataFrame([(5, "abcd")], empty.schema)).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"abab").hexdigest()


@settings(max_examples=60, deadline=None)
@given(st.text("ab\n# ", max_size=80), st.text("ab\n# ", max_size=80))
def test_roots_tell_texts_apart(a, b):
    assert (fp.fingerprint(a)[0] == fp.fingerprint(b)[0]) == (a == b)
    assert 0 <= fp.likeness(fp.fingerprint(a)[0], fp.fingerprint(b)[0]) <= 1


def test_edits_are_located():
    lines = [f"paragraph {i} with some words" for i in range(200)]
    changed = lines[:]
    changed[77] = "another line"
    changed.insert(150, "a new line")
    a, b = (fp.fingerprint("\n".join(x))[0] for x in (lines, changed))
    assert fp.locate_edits(a, b) == [77, 150]
    assert 0.9 < fp.likeness(a, b) < 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab #", max_size=30), max_size=12), st.lists(st.text("ab #", max_size=30), max_size=12))
def test_descent_against_all_paragraphs(a, b):
    """Nothing differs below equal nodes: the descent finds what all paragraphs at once tell."""
    left, right = (fp.fingerprint("\n".join(x)) for x in (a, b))
    near, places = fp.compare(left[0], right[0])
    texts = ["\n".join(x).split("\n") for x in (a, b)]
    assert sorted(texts[1][i] for i in places) == sorted((Counter(texts[1]) - Counter(texts[0])).elements())
    if left[0] != right[0]:
        assert (near, places) == fp.descend(left[1], right[1])


def test_null_and_equal_ids_are_split(spark, monkeypatch):
    rows = [(None, f"text {i:04d} " * 20) for i in range(300)] + [(7, f"{i:04d} text " * 20) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(fp, "RANGE_BYTES", 9_000)
    out = fp.fingerprint_documents(df)
    starts = fp._range_starts(df.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"),
                                        fp._order(F.col("doc_id"), F.col("text")).alias("_order")))
    assert len(starts) > 8
    assert sorted(map(tuple, out.collect()), key=key) == sorted(expected(rows), key=key)


def test_plan_does_not_grow_with_the_ranges(spark, monkeypatch):
    df = spark.createDataFrame([(i, "x" * 100) for i in range(2_000)], "doc_id long, text string")
    sizes = []
    for size in (100_000, 400):
        monkeypatch.setattr(fp, "RANGE_BYTES", size)
        sizes.append(len(fp.fingerprint_documents(df)._jdf.queryExecution().optimizedPlan().toString()))
    assert sizes[1] < sizes[0] + 200
