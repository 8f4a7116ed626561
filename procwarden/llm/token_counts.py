"""Token counts: batches are encoded inside Arrow functions, only lengths come back.

Texts are encoded by the vocabulary's own library, in calls of about ``SLICE_BYTES``.
A longer text is cut where no token can lie across: the counts of its pieces add up
to the count of the whole.  Texts beyond ``LONG_BYTES`` are cut in the task that reads
them, their pieces are dealt out anew and encoded by many tasks.

Where a text may be cut:

* a ``.model`` file (sentencepiece, merges of pairs).  Two neighbouring characters that
  stand side by side in no piece are never merged, and merges on either side do not
  see each other.  The library puts a space mark in front of each text it is given: a
  piece that begins with a space gives that space away for it, before any other
  character the mark stays a token by itself and is taken off again;
* a ``.json`` file (tokenizers) with byte-level merges: before a space that has an
  ASCII letter on either side, where its pattern always begins a new word.  Files with
  other rules are encoded whole.

A stretch in which no place qualifies is encoded as one piece, however long it is.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procwarden.llm.common import SLICE_BYTES, byte_slices
from procwarden.session import cut_lineage

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
LONG_BYTES = 8_000_000  # longer texts are encoded by several tasks
PIECE_CHARS = 250_000  # a text is cut at the first safe place after so many characters
_MARK = 0x2581  # the space mark
_SHIFT = 21  # bits of a code point


@dataclass
class Encoder:
    """A vocabulary file's bytes and what is known about safe places to cut."""

    kind: str  # "model" or "json"
    data: bytes
    joined: np.ndarray | None = None  # pairs of characters inside pieces: (left << 21) | right
    byte_level: bool = False

    def counter(self) -> Callable[[list[str]], list[int]]:
        """Counts of a list of texts, for use inside a task."""
        if self.kind == "model":
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_proto=self.data)
            return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        from tokenizers import Tokenizer

        model = Tokenizer.from_buffer(self.data)
        model.no_truncation()
        model.no_padding()
        return lambda texts: [len(e.ids) for e in model.encode_batch(texts, add_special_tokens=False)]


def load(path: str | None = None) -> Encoder:
    """Read a vocabulary file on the driver; its bytes go to the tasks."""
    path = path or public_tokenizers.path(MODEL)
    with open(path, "rb") as f:
        data = f.read()
    if path.endswith(".json"):
        kind = json.loads(data).get("pre_tokenizer") or {}
        return Encoder("json", data, byte_level=kind.get("type") == "ByteLevel" and not kind.get("add_prefix_space"))
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(data)
    norm, kinds = model.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
    plain = (norm.add_dummy_prefix and norm.escape_whitespaces and not norm.remove_extra_whitespaces
             and not norm.precompiled_charsmap and model.trainer_spec.byte_fallback
             and model.trainer_spec.model_type == model.trainer_spec.BPE)
    if not plain:  # characters may change or vanish before they are merged
        return Encoder("model", data)
    texts = [p.piece for p in model.pieces if p.type not in (kinds.CONTROL, kinds.UNKNOWN, kinds.BYTE)]
    pairs = {(ord(a) << _SHIFT) | ord(b) for t in texts for a, b in zip(t, t[1:], strict=False)}
    return Encoder("model", data, np.array(sorted(pairs), np.int64))


def safe_cuts(text: str, encoder: Encoder) -> tuple[np.ndarray, np.ndarray]:
    """Places before which ``text`` may be cut, and how the piece behind each is to be read.

    The second array holds 1 where the piece gives its space to the library's mark, 2
    where the mark has to be taken off the count and 0 where the library adds none.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    if encoder.joined is not None:
        codes[codes == 0x20] = _MARK
        apart = ~np.isin((codes[:-1] << _SHIFT) | codes[1:], encoder.joined)
        marked = codes[1:] == _MARK
        marked[-1:] = False  # a last space must keep a character behind it
        alone = (codes[1:] != _MARK) & ~np.isin((_MARK << _SHIFT) | codes[1:], encoder.joined)
        places = np.flatnonzero(apart & (marked | alone))
        return places + 1, np.where(marked[places], 1, 2)
    if encoder.byte_level:
        letter = ((codes | 32) >= 97) & ((codes | 32) <= 122)
        places = np.flatnonzero(letter[:-2] & (codes[1:-1] == 0x20) & letter[2:]) + 1
        return places, np.zeros(len(places), np.int64)
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def pieces(text: str, encoder: Encoder, chars: int = PIECE_CHARS) -> list[tuple[str, int]]:
    """The text in pieces of about ``chars`` characters, with what to add to the count of each."""
    if len(text) <= chars:
        return [(text, 0)]
    places, how = safe_cuts(text, encoder)
    out, start, kind = [], 0, 0
    while True:
        at = np.searchsorted(places, start + max(chars, 2))  # behind a space that is given away something stays
        end = int(places[at]) if at < len(places) else len(text)
        out.append((text[start + (kind == 1):end], -(kind == 2)))
        if end == len(text):
            return out
        start, kind = end, int(how[at])


def count_tokens(docs: DataFrame, encoder: Encoder, limit: int = LIMIT, long_bytes: int = LONG_BYTES,
                 chars: int = PIECE_CHARS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of ``docs``.

    Null texts count as empty: no bytes, no tokens.  Rows with null or repeated ids are
    counted each by itself.  Only ``doc_id`` and ``text`` are read, so other columns may
    have any names.  A table without rows gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(encoder)  # the file, at most a few MB

    def counts(texts: list[str], count: Callable[[list[str]], list[int]]) -> np.ndarray:
        cut = [pieces(t, shared.value, chars) for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
        parts = [p for c in cut for p in c]
        found = count([t for t, _ in parts])
        return np.bincount(owner, np.array(found) + [n for _, n in parts], len(texts)).astype(np.int64)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of texts of common length; of a longer one its pieces, with the text's own number."""
        count, place, numbered = shared.value.counter(), TaskContext.get().partitionId(), 0
        for batch in byte_slices(batches, "text", SLICE_BYTES):
            ids, sizes, texts = batch.column(0), batch.column(1).to_numpy(), batch.column(2)
            short = np.flatnonzero(sizes <= long_bytes)
            if len(short):
                yield _rows(ids.take(pa.array(short)), sizes[short],
                            counts(texts.take(pa.array(short)).to_pylist(), count), None, None)
            for i in np.flatnonzero(sizes > long_bytes):
                cut = pieces(texts[int(i)].as_py(), shared.value, chars)
                numbered += 1
                for k, (text, extra) in enumerate(cut):
                    yield _rows(ids.slice(int(i), 1), np.array([sizes[i] if k == 0 else 0]), np.array([extra]),
                                [f"{place}:{numbered}"], [text])

    def read_pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared.value.counter()
        for batch in byte_slices(batches, "piece", SLICE_BYTES):
            extra = batch.column(2).to_numpy() + count(batch.column(4).to_pylist())
            yield _rows(batch.column(0), batch.column(1).to_numpy(), extra, batch.column(3), None)

    schema = "doc_id long, n_bytes long, n_tokens long, number string, piece string"
    texts = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                        F.coalesce("text", F.lit("")).alias("text"))
    found = cut_lineage(texts.mapInArrow(read, schema))
    whole = found.where("number IS NULL").select("doc_id", "n_bytes", "n_tokens")
    split = found.where("number IS NOT NULL")
    if not split.isEmpty():  # written once, so a text's number stays what it is
        summed = split.repartition("number", "piece").mapInArrow(read_pieces, schema)
        whole = whole.unionByName(summed.groupBy("number").agg(
            F.max("doc_id").alias("doc_id"), F.sum("n_bytes").alias("n_bytes"), F.sum("n_tokens").alias("n_tokens"))
            .drop("number"))
    return whole.select("*", (F.col("n_tokens") > limit).alias("over_limit"))


def _rows(ids, sizes, counts, numbers, texts) -> pa.RecordBatch:
    none = pa.nulls(len(sizes), pa.string())
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()),
         none if numbers is None else pa.array(numbers, pa.string()) if isinstance(numbers, list) else numbers,
         none if texts is None else pa.array(texts, pa.string())],
        ["doc_id", "n_bytes", "n_tokens", "number", "piece"])
