import numpy as np
import pytest
import sentencepiece

from conftest import SMALL
from procwarden.llm import sentencepiece_scan as sp
from procwarden.llm.common import table

SCHEMA = "doc_id long, text string, chunk int, row string"


@pytest.fixture(scope="module")
def vocabulary():
    return sp.load()


def plain(v, text):
    """Sequential best segmentation of the whole text: its score."""
    return v.forward(sp.SPACE + sp.shown(text))[0][-1] if text else 0.0


def score(v, ids):
    """Score of ids; bytes of one character cost one penalty."""
    out, held = 0.0, b""
    for i in ids:
        if i in v.byte_of:
            held += v.byte_of[i]
            try:
                held.decode()
            except UnicodeDecodeError:
                continue
            out, held = out + v.unknown, b""
        else:
            out += v.score_of[v.text_of[i]]
    return out


TEXTS = ["", None, " ", "plain words and more", "  two  spaces   and tab\tline\nend  ", "▁ mark ▁▁", "日本語のテキスト" * 40,
         "x" * 700, "a b " * 300, "\U0001F600 é ퟿" * 50, "antidisestablishmentarianism" * 30, " " * 333, "one"]


@pytest.mark.parametrize("chunk,fanin", [(8_192, 32), (40, 3), (17, 2)])
def test_against_the_sequential_scan(spark, monkeypatch, vocabulary, chunk, fanin):
    monkeypatch.setattr(sp, "CHUNK", chunk)
    monkeypatch.setattr(sp, "FANIN", fanin)
    rows = [(i, t, 1, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], None, None), (None, TEXTS[4], 1, "x")]
    got = sp.tokenize(spark.createDataFrame(rows, SCHEMA).repartition(3), vocabulary).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    for r in got:
        text = TEXTS[4 if r.doc_id is None else r.doc_id]
        assert vocabulary.decode(r.ids).decode() == (" " + text if text else "")
        assert r.n_tokens == len(r.ids) and score(vocabulary, r.ids) == pytest.approx(plain(vocabulary, text), rel=1e-12)


def test_against_the_library(vocabulary):
    """The library's own best path under the same scores, with the model file marked as one of that kind."""
    model = sentencepiece.SentencePieceProcessor(model_file=sp.MODEL).serialized_model_proto()
    mark = b"\x18\x02 \x80\xfa\x01"
    assert model.count(mark) == 1
    library = sentencepiece.SentencePieceProcessor(model_proto=model.replace(mark, b"\x18\x01 \x80\xfa\x01"))
    import duckdb
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM read_parquet('{SMALL}/documents.parquet') LIMIT 60").fetchall()]
    for text in texts:
        ours, theirs = vocabulary.encode(sp.SPACE + sp.shown(text)), library.encode(text)
        assert score(vocabulary, ours) >= score(vocabulary, theirs) - 1e-3 * len(text)
        assert library.decode(ours) == text
    for word in sorted({w for t in texts for w in t.split()})[:2_000]:  # ties may differ, scores not
        ours, theirs = vocabulary.encode(sp.SPACE + sp.shown(word)), library.encode(word)
        assert score(vocabulary, ours) == pytest.approx(score(vocabulary, theirs))


def test_transfer_matrices(vocabulary):
    v = vocabulary
    text = sp.SPACE + sp.shown("internationalisation of the 日本 words, and more of them again; representatives")
    states = v.longest
    for a in (20, 33, 50):
        left, right = sp.transfers(v, [(text[:a + states - 1], a), (text[a:], len(text) - a)])
        assert sp.product(left, right)[0, 0] == pytest.approx(v.forward(text)[0][-1])
    slow, v.words_apart = sp.transfers(v, [(text, len(text))])[0], False
    assert np.allclose(slow, sp.transfers(v, [(text, len(text))])[0])
    v.words_apart = True


def test_known_words_change_nothing(monkeypatch, vocabulary):
    texts = [sp.SPACE + sp.shown(t) for t in TEXTS if t]
    want = [vocabulary.encode(t) for t in texts]
    monkeypatch.setattr(sp, "KNOWN_WORDS", 3)
    flat, at, _ = vocabulary.encode_all(texts)
    assert [flat[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want


def test_whole_table(spark, vocabulary):
    docs = table(spark, SMALL, "documents")
    got = sp.tokenize(docs, vocabulary)
    assert got.count() == docs.count() and got.where("NOT round_trip").count() == 0
    back = sp.decode(got, vocabulary)
    assert back.exceptAll(docs.select("doc_id", "text")).count() == 0
    assert sp.tokenize(docs.where("false"), vocabulary).collect() == []
