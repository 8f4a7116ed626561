import time

from check import compare, connect
from conftest import SMALL
from procwarden.llm import line_templates as lt

SCHEMA = "doc_id long, text string, row long, line string"


def run(spark, rows):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(3)
    return lt.drop_recurring_lines(df)


def test_recurring_lines_go(spark):
    note = "Posted by user {} on day {} in the public forum"
    rows = [(i, f"{'abcdefghij'[i]}aa {'abcdefghij'[i]}bb {'abcdefghij'[i]}cc stays\n{note.format('abcdefghij'[i] * 3, i)}\nAll rights reserved.\nok")
            for i in range(10)]
    got = {r.doc_id: r for r in run(spark, rows).collect()}
    assert got[0].text == rows[0][1] and got[0].n_dropped == 0  # the first document keeps them
    for i in range(1, 10):
        assert "All rights" not in got[i].text and "Posted" not in got[i].text
        assert got[i].text.endswith(" stays\nok") and got[i].row == 7 and got[i].line == "x"


def test_rare_and_short_lines_stay(spark):
    rows = [(1, "twice seen line here\nshort one"), (2, "twice seen line here\nshort one"), (3, "short one\nno match at all"),
            (4, "alpha beta gamma delta epsilon zeta"), (5, "alpha beta gamma one two three"), (6, "alpha beta gamma x y z")]
    assert all(r.n_dropped == 0 for r in run(spark, rows).collect())


def test_any_white_space_parts_tokens(spark):
    rows = [(i, f"one\ttwo  three\x0bfour 12{i}\r\nown{i} a{i * 'x'} b{i * 'y'}") for i in range(1, 4)]
    rows.append((9, " one two three four 7 "))
    assert [r.n_dropped for r in run(spark, rows).orderBy("doc_id").collect()] == [0, 1, 1, 1]


def test_odd_rows(spark):
    same = "a line that many have\nanother"
    rows = [(None, same), (9, same), (3, same), (3, same), (4, None), (5, ""), (6, "\n\n"), (7, same + "\n" + "w " * 50_000),
            (8, "a line that many have\n" * 3)]
    got = run(spark, rows).collect()
    assert len(got) == len(rows)
    assert [r.n_dropped for r in got if r.doc_id == 3] == [0, 0]
    by_id = {r.doc_id: r for r in got}
    assert by_id[9].text == "another" and by_id[None].text == "another" and by_id[8].text == "" and by_id[8].n_dropped == 3
    assert (by_id[4].text, by_id[4].n_lines) == (None, 0) and by_id[6].text == "\n\n"
    assert run(spark, []).collect() == []


def test_many_lines_take_linear_time(spark):
    shared = [f"line of the {'abcdefghij'[i % 10] * (1 + i % 7)} kind" for i in range(120_000)]
    rows = [(i, "\n".join([f"own{i} words here{i}", *shared, "last"])) for i in range(3)]
    started = time.time()
    got = {r.doc_id: r for r in run(spark, rows).select("doc_id", "text", "n_dropped").collect()}
    assert time.time() - started < 60
    assert got[0].text == rows[0][1]
    assert all(got[i].text == f"own{i} words here{i}\nlast" and got[i].n_dropped == 120_000 for i in (1, 2))


def test_clashing_columns(spark):
    df = spark.createDataFrame([(i, "a line that many have\nlast", "a", "b", "c", "d") for i in range(3)],
                               "doc_id long, text string, _row string, _dropped string, __row string, n_lines string")
    for r in lt.drop_recurring_lines(df).collect():
        assert (r._row, r._dropped, r["__row"], r.n_lines, r.n_dropped) == ("a", "b", "c", 2, int(r.doc_id > 0))


def test_against_sql(spark):
    folder = SMALL.replace("0.001", "0.01")
    assert compare(spark, connect(folder), "op5_line_templates", folder) == "ok"
