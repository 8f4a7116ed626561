import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from conftest import SMALL
from procwarden.llm import queries
from procwarden.llm import token_counts as T
from procwarden.llm.common import table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, n_tokens int, n_bytes string, piece string, number int, over_limit string"


def whole(path, texts):
    """Counts by the library, every text in one piece."""
    if path.endswith(".model"):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(sp.encode(t)) for t in texts]
    model = Tokenizer.from_file(path)
    return [len(model.encode(t, add_special_tokens=False).ids) for t in texts]


def odd_texts(n=300, seed=3):
    """Random texts over characters that the rules treat differently."""
    rng = np.random.default_rng(seed)
    signs = list("abetionsTHE  \n\t.,<s>0159") + ["▁", " ", "é", "́", "日", "本", "‍", "😀", "\0", "ﬁ", "　", "▁▁", "the ", "ing"]
    return ["".join(rng.choice(signs, rng.integers(0, 120))) for _ in range(n)] + [
        "", " ", "  ", "a ", " a", "▁", "a" * 500, " " * 77 + "x", "日本" * 90, "<s> </s> <unk> <0x41>", "\n" * 50]


@pytest.mark.parametrize("path", [MODEL, BYTES])
@pytest.mark.parametrize("chars", [1, 3, 17])
def test_pieces_add_up(path, chars):
    encoder = T.load(path)
    count = encoder.counter()
    many = 0
    texts = odd_texts() if path == MODEL else odd_texts() + ["some plain words of a text " * 9 + "<|endoftext|> and more"]
    for text, want in zip(texts, whole(path, texts), strict=True):
        cut = T.pieces(text, encoder, chars)
        many += len(cut) > 1
        assert sum(n + extra for n, (_, extra) in zip(count([t for t, _ in cut]), cut, strict=True)) == want, text
    assert many > 100


def test_other_rules_are_encoded_whole():
    encoder = T.load(public_tokenizers.path("word_bpe_49k.json"))
    assert T.pieces("many words " * 50, encoder, 5) == [("many words " * 50, 0)]


@pytest.mark.parametrize("long_bytes, chars", [(T.LONG_BYTES, T.PIECE_CHARS), (60, 20)])
def test_counts(spark, long_bytes, chars):
    """Null, empty and long texts, equal rows, null ids, columns named like the operator's own."""
    texts = [*odd_texts(80), None, "word " * 40_000, "x" * 30_000]
    rows = [(i if i % 9 else None, t, 1, "x", "y", 2, "z") for i, t in enumerate(texts)]
    rows += [(7, "same row", 1, "x", "y", 2, "z")] * 2
    got = T.count_tokens(spark.createDataFrame(rows, DOCS).repartition(3), T.load(), 100, long_bytes, chars).collect()
    counts = whole(MODEL, [r[1] or "" for r in rows])
    want = [(r[0], len((r[1] or "").encode()), n, n > 100) for r, n in zip(rows, counts, strict=True)]
    order = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in got), key=order) == sorted(want, key=order)


def test_no_rows(spark):
    assert T.count_tokens(spark.createDataFrame([], DOCS), T.load()).collect() == []


def test_query(spark):
    docs = table(spark, SMALL, "documents").collect()
    want = {r.doc_id: n for r, n in zip(docs, whole(MODEL, [r.text or "" for r in docs]), strict=True)}
    got = queries.QUERIES["op11_token_counts"](spark, SMALL).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want and len(got) == len(docs)
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
