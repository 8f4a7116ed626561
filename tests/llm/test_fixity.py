import gzip
import hashlib

import pytest

from check import compare, connect
from conftest import SMALL
from procwarden.llm import fixity

SCHEMA = "file string, offset long, length long, digest string, node long, hash string"


def replica(spark, rows):
    return spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA).repartition(3)


def rows_of(n, file):
    return [(file, i * 100_000, 100_000, hashlib.sha256(f"{file}{i}".encode()).hexdigest()) for i in range(n)]


@pytest.fixture(scope="module")
def good():
    return rows_of(300, "a") + rows_of(3, "b") + rows_of(40, "c")


def found(spark, a, b):
    return sorted((r.file, r.offset, r.status) for r in fixity.audit(replica(spark, a), replica(spark, b)).collect())


def test_damage_is_located(spark, good):
    other = [r for r in good if r[:2] not in {("a", 7_700_000), ("c", 0)}]
    other = [(*r[:3], "0" * 64) if r[:2] == ("a", 100_000) else r for r in other] + [("b", 300_000, 5, "1" * 64)]
    assert found(spark, good, other) == [("a", 100_000, "changed"), ("a", 7_700_000, "missing"),
                                         ("b", 300_000, "extra"), ("c", 0, "missing")]
    assert found(spark, good, good) == [] and found(spark, [], []) == []


def test_trees_of_unlike_height(spark, good):
    longer = good + [("b", 90_000_000, 1, "2" * 64)]
    assert found(spark, good, longer) == [("b", 90_000_000, "extra")]
    assert found(spark, rows_of(2, "a"), good) == sorted(
        (r[0], r[1], "extra") for r in good if r not in rows_of(2, "a"))


def test_nulls_and_repeated_rows(spark, good):
    odd = good + [(None, None, None, None), ("a", None, 5, "z"), *([("r", 0, 4, "q")] * 50)]
    assert found(spark, odd, odd) == []
    assert found(spark, odd, odd[:-1]) == [("r", 0, "changed")]  # one copy fewer


def test_only_unlike_branches_are_read(spark, good):
    levels = fixity.tree(replica(spark, good))
    assert [x.count() for x in levels][-1] == 3 and levels[0].count() > 100


def test_reads_warc_files(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://x/é", "<p>é</p>"), (2, None, None), (3, "u", "x" * 5000)],
                                  "page_id long, url string, html string")
    laid = fixity.records_of_pages(pages).orderBy("offset").collect()
    raw = b""
    for r in pages.orderBy("page_id").select(fixity.record_text(pages.url, pages.html, pages.page_id).alias("t")).collect():
        raw += r.t.encode()
    (tmp_path / "a.warc").write_bytes(raw)
    (tmp_path / "b.warc.gz").write_bytes(gzip.compress(raw))
    got = fixity.read_warc(spark, f"{tmp_path}/*").orderBy("file", "offset").collect()
    assert [(r.offset, r.length, r.digest) for r in got] == [(r.offset, r.length, r.digest) for r in laid] * 2
    assert got[0].uri == "http://x/é"


def test_pages_with_odd_rows(spark):
    pages = spark.createDataFrame([(None, None, None), (None, "u", "x"), (7, "a", "b"), (7, "a", "b")],
                                  "page_id long, url string, html string")
    laid = fixity.records_of_pages(pages)
    assert laid.count() == 4 and fixity.audit(laid, laid).count() == 0


def test_against_sql(spark):
    assert compare(spark, connect(SMALL.replace("0.001", "0.01")), "op2_fixity_audit", SMALL.replace("0.001", "0.01")) == "ok"


def test_every_record_of_an_offset_is_compared(spark):
    one = [("a", 0, 4, "b"), ("a", 0, 4, "d"), (None, None, 4, "k"), (None, None, 4, "m")]
    two = [("a", 0, 4, "b"), ("a", 0, 4, "e"), (None, None, 4, "k"), (None, None, 4, "n")]
    got = fixity.audit(replica(spark, one), replica(spark, two)).collect()
    assert {(r.file, r.offset, r.status, r.first_digest, r.second_digest) for r in got} == {
        ("a", 0, "changed", "d", "e"), ("none", 0, "changed", "m", "n")}
