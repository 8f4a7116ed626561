"""SentencePiece encoding and decoding as a parallel max-plus scan.

The vocabulary (pieces with scores) is read from a model file.  The encoding of a
text is its segmentation of greatest total score; a character without a piece
costs a penalty and is written as its UTF-8 bytes.  A text is a space in front and
then the text, with spaces shown as U+2581, as the library does it.

Giant texts are cut into chunks.  A piece may lie across a border, so a chunk has a
state at either end: how many characters beyond the border the piece across it
takes.  The best scores between all pairs of states form a matrix; matrices of
neighbouring chunks combine by the max-plus product, which is associative, so a
tree of groups of bounded size finds the best state at every border.  Each chunk is
then traced back by itself between its two states.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procwarden.llm.common import SpanHasher, span_hashes
from procwarden.session import cut_lineage

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 32_768  # characters of a chunk; shorter texts are encoded where they lie, once
FANIN = 32  # chunks, or groups of them, whose matrices one task multiplies
SLICE_CHARS = 1_000_000  # characters segmented at once
KNOWN_WORDS = 1_000_000  # segmented words that a task remembers, at most about so many
TABLE_BITS = 18  # slots of the table of piece beginnings: 2**TABLE_BITS
LONG_WORD = 48  # words of more characters are segmented one by one
SPACE = "▁"
_ESCAPE = "\udfff"  # stands for a U+2581 of the text itself; no text holds a lone surrogate
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")  # space marks and what follows up to the next one
PENALTY = 10.0  # a character without a piece scores so much below the worst piece
_NEVER = -np.inf


class Vocabulary:
    """Pieces with their ids and scores, and ids of the 256 bytes."""

    def __init__(self, pieces: list[tuple[str, int, float]], byte_ids: list[int]) -> None:
        self.id_of = {p: i for p, i, _ in pieces}
        self.score_of = {p: s for p, _, s in pieces}
        self.text_of = {i: p for p, i, _ in pieces}
        self.byte_ids = byte_ids
        self.byte_of = {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.longest = max(map(len, self.id_of))
        self.unknown = min(self.score_of.values()) - PENALTY
        # no piece has a space mark behind another character: a text falls apart before each one
        self.words_apart = not any(SPACE in p.lstrip(SPACE) for p in self.id_of)
        self.reach: dict[str, int] = {}  # longest piece that begins with two given characters
        for p in self.id_of:
            self.reach[p[:2]] = max(self.reach.get(p[:2], 0), len(p))
        # the bytes of all ids in a row, where each id's begin and how many they are
        bytes_of = {i: p.replace(SPACE, " ").encode() for i, p in self.text_of.items()} | self.byte_of
        self.byte_len = np.array([len(bytes_of.get(i, b"")) for i in range(max(bytes_of) + 1)], np.int64)
        self.byte_at = np.cumsum(self.byte_len) - self.byte_len
        self.byte_row = np.frombuffer(b"".join(bytes_of[i] for i in sorted(bytes_of)), np.uint8)
        # all beginnings of pieces by the hash of their characters, for many places at once
        heads = sorted({p[:k] for p in self.id_of for k in range(1, len(p) + 1)})
        ends = np.cumsum([len(p) for p in heads])
        hashes = span_hashes(_codes("".join(heads)), ends - [len(p) for p in heads], ends)
        order = np.argsort(hashes)
        self.head_hash = hashes[order]
        self.head_id = np.array([self.id_of.get(p, -1) for p in heads], np.int32)[order]
        self.head_score = np.array([self.score_of.get(p, _NEVER) for p in heads])[order]
        # the hash at a slot of a table by first bits; of heads that share a slot the others are searched for
        slot = (self.head_hash >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        self.table = np.full(1 << TABLE_BITS, -1, np.int32)
        self.table[slot] = np.arange(len(slot))
        self.crowded = np.zeros(1 << TABLE_BITS, bool)
        self.crowded[slot[1:][slot[1:] == slot[:-1]]] = True

        self._forget()

    def _forget(self) -> None:
        """Words by hash (sorted), with the places of their ids in a row and their scores."""
        self.known, self.known_at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.at = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.scores = np.zeros(0)

    def forward(self, text: str) -> tuple[list[float], list[int]]:
        """For every length of a beginning its best score and where its last piece begins."""
        n, scores, reach = len(text), self.score_of, self.reach
        best, back = [0.0] + [_NEVER] * n, [0] * (n + 1)
        for i in range(n):
            base = best[i]
            s = scores.get(text[i])
            s = base + (self.unknown if s is None else s)
            if s > best[i + 1]:
                best[i + 1], back[i + 1] = s, i
            for j in range(i + 2, min(n, i + reach.get(text[i:i + 2], 1)) + 1):
                s = scores.get(text[i:j])
                if s is not None and base + s > best[j]:
                    best[j], back[j] = base + s, i
        return best, back

    def segment(self, word: str) -> list[int]:
        """Ids of the best segmentation of one stretch."""
        _, back = self.forward(word)
        parts, j = [], len(word)
        while j:
            i = back[j]
            parts.append(self.ids(word[i:j]))
            j = i
        return [x for part in reversed(parts) for x in part]

    def encode(self, text: str) -> list[int]:
        """Ids of the best segmentation of one text."""
        return self.encode_all([text])[0].tolist()

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, where each text's begin, and the texts' scores."""
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        codes = _codes("".join(texts))
        mark = codes == ord(SPACE)
        begins = np.zeros(len(codes) + 1, bool)
        begins[(ends - sizes)[sizes > 0]] = True
        if self.words_apart:
            begins[1:-1] |= mark[1:] & ~mark[:-1]
        starts = np.flatnonzero(begins[:-1])
        stops = np.r_[starts[1:], len(codes)][:len(starts)]
        hashes, first, kind = np.unique(span_hashes(codes, starts, stops), return_index=True, return_inverse=True)
        place = self._places(hashes, codes, starts[first], stops[first])
        # the words' ids, word by word
        word = place[kind]
        n = self.at[word + 1] - self.at[word]
        upto = np.cumsum(n)
        flat = self.flat[np.arange(upto[-1] if len(n) else 0) - np.repeat(upto - n - self.at[word], n)]
        word_at = np.searchsorted(starts, np.r_[ends - sizes, len(codes)])
        ids_at = np.r_[0, upto][word_at]
        total = np.r_[0.0, np.cumsum(self.scores[word])][word_at]
        return flat, ids_at, np.diff(total)

    def _places(self, hashes: np.ndarray, codes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Places of words (hashes sorted, without repeats) among the known ones; new words are segmented."""
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        at = np.searchsorted(self.known, hashes)
        place = np.full(len(hashes), -1, np.int64)
        if len(self.known):
            near = np.minimum(at, len(self.known) - 1)
            hit = self.known[near] == hashes
            place[hit] = self.known_at[near[hit]]
        new = np.flatnonzero(place < 0)
        if len(new):
            ids, begins, score = self._segment_words(codes, starts[new], stops[new])
            place[new] = np.arange(len(self.scores), len(self.scores) + len(new))
            self.known = np.insert(self.known, at[new], hashes[new])
            self.known_at = np.insert(self.known_at, at[new], place[new])
            self.at = np.r_[self.at, begins[1:] + len(self.flat)]
            self.flat = np.concatenate([self.flat, ids])
            self.scores = np.r_[self.scores, score]
        return place

    def _segment_words(self, codes: np.ndarray, starts: np.ndarray, stops: np.ndarray,
                       ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words in a row, where each word's begin, and the words' scores; all words step by step together."""
        sizes = stops - starts
        base = np.cumsum(sizes) - sizes
        own = codes[np.arange(sizes.sum()) - np.repeat(base - starts, sizes)] if len(sizes) else codes[:0]
        place = np.arange(len(own)) - np.repeat(base, sizes)  # in the word
        left = np.repeat(sizes, sizes) - place  # characters from here to the word's end
        step_of = np.minimum(place, 255).astype(np.uint8)  # small numbers sort fast
        edges = self._edges(own, left)
        slow = sizes > LONG_WORD
        odd = edges[1] & (own >= 128)  # characters without a piece that are several bytes
        slow[np.repeat(np.arange(len(sizes)), sizes)[odd]] = True
        # one more slot per word, for its end
        slot = np.arange(len(own)) + np.repeat(np.arange(len(sizes)), sizes)
        head, end = base + np.arange(len(sizes)), base + np.arange(len(sizes)) + sizes
        best = np.full(len(own) + len(sizes), _NEVER)
        back, via = np.zeros(len(best), np.int64), np.zeros(len(best), np.int32)
        best[head] = 0.0
        fast = ~np.repeat(slow, sizes)
        by_place: dict[int, list] = {}
        for length, (at, piece, score) in edges[0].items():
            keep = fast[at]
            at, piece, score = at[keep], piece[keep], score[keep]
            order = np.argsort(step_of[at], kind="stable")
            at, piece, score = at[order], piece[order], score[order]
            cut = np.searchsorted(step_of[at], np.arange(LONG_WORD + 2))
            for k in np.flatnonzero(np.diff(cut)):
                part = slice(cut[k], cut[k + 1])
                by_place.setdefault(int(k), []).append((length, slot[at[part]], piece[part], score[part]))
        for k in sorted(by_place):
            for length, at, piece, score in by_place[k]:
                total, to = best[at] + score, at + length
                better = total > best[to]
                to = to[better]
                best[to], back[to], via[to] = total[better], at[better], piece[better]
        words, steps, found = [], [], []
        todo, now, step = np.flatnonzero(~slow), end[~slow], 0
        while len(todo):
            words.append(todo)
            steps.append(np.full(len(todo), -step))
            found.append(via[now])
            now, step = back[now], step + 1
            more = now != head[todo]
            todo, now = todo[more], now[more]
        totals = best[end]
        for w in np.flatnonzero(slow):
            text = own[base[w]:base[w] + sizes[w]].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            ids = self.segment(text)
            totals[w] = self.forward(text)[0][-1]
            words.append(np.full(len(ids), w))
            steps.append(np.arange(len(ids)))
            found.append(np.array(ids, np.int32))
        if not words:
            return np.zeros(0, np.int32), np.zeros(1, np.int64), totals
        words, steps, found = (np.concatenate(x) for x in (words, steps, found))
        order = np.lexsort((steps, words))
        return found[order].astype(np.int32), np.searchsorted(words[order], np.arange(len(sizes) + 1)), totals

    def _edges(self, own: np.ndarray, left: np.ndarray) -> tuple[dict, np.ndarray]:
        """By length, the places where a piece begins with its id and score; and where no single character is one."""
        at, out, unknown, hasher = np.arange(len(own)), {}, np.zeros(len(own), bool), SpanHasher(own)
        for length in range(1, self.longest + 1):
            at = at[left[at] >= length]
            if not len(at):
                break
            known = self._heads(hasher.of(at, at + length))
            piece = np.where(known >= 0, self.head_id[np.maximum(known, 0)], -1)
            if length == 1:
                none = piece < 0
                unknown[at[none]] = True
                ids = np.where(none, np.array(self.byte_ids, np.int32)[own[at] & 255], piece)
                scores = np.where(none, self.unknown, self.head_score[np.maximum(known, 0)])
                out[1] = (at, ids.astype(np.int32), scores)
            elif (piece >= 0).any():
                some = piece >= 0
                out[length] = (at[some], piece[some], self.head_score[known[some]])
            at = at[known >= 0]
        return out, unknown

    def _heads(self, hashes: np.ndarray) -> np.ndarray:
        """Index of every hash among the beginnings of pieces, -1 if it is none."""
        slot = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        out = self.table[slot]
        out[self.head_hash[out] != hashes] = -1
        more = np.flatnonzero((out < 0) & self.crowded[slot])
        if len(more):
            at = np.minimum(np.searchsorted(self.head_hash, hashes[more]), len(self.head_hash) - 1)
            out[more] = np.where(self.head_hash[at] == hashes[more], at, -1)
        return out

    def ids(self, piece: str) -> list[int]:
        known = self.id_of.get(piece)
        return [known] if known is not None else [self.byte_ids[b] for b in raw(piece).encode("utf-8", "surrogatepass")]

    def decode(self, ids: list[int] | np.ndarray) -> bytes:
        """The bytes that ids stand for; the space in front is still there.  Other ids raise."""
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return b""
        n = self.byte_len[ids]
        if ids.min() < 0 or not n.all():
            raise ValueError("ids that stand for no text")
        ends = np.cumsum(n)
        return self.byte_row[np.arange(ends[-1]) + np.repeat(self.byte_at[ids] - ends + n, n)].tobytes()


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def shown(text: str) -> str:
    """The text as the vocabulary sees it, one character for one."""
    return text.replace(SPACE, _ESCAPE).replace(" ", SPACE)


def raw(piece: str) -> str:
    """The text behind a piece that is no piece of the vocabulary."""
    return piece.replace(SPACE, " ").replace(_ESCAPE, SPACE)


def load(path: str = MODEL) -> Vocabulary:
    """The vocabulary of a model file; read on the driver, sent to the tasks with the function."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    odd = set(byte_ids) | {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
    pieces = [(model.id_to_piece(i), i, float(model.get_score(i))) for i in range(size) if i not in odd]
    return Vocabulary([p for p in pieces if _ESCAPE not in p[0]], byte_ids)


def word_borders(v: Vocabulary, text: str, size: int) -> tuple[int, int] | None:
    """First and last place in a chunk that no piece crosses, beyond the reach of the chunk before."""
    found = re.search(f"[^{SPACE}]{SPACE}", text[v.longest - 1:size + 1]) if v.words_apart else None
    if not found:
        return None
    first = last = v.longest + found.start()
    for i in range(size, first, -1):
        if text[i:i + 1] == SPACE and text[i - 1] != SPACE:
            last = i
            break
    return first, last


def transfers(v: Vocabulary, chunks: list[tuple[str, int]]) -> list[np.ndarray]:
    """Best scores from every state at a chunk's start to every state at its end, chunk by chunk.

    A chunk comes as its text, with what follows up to a piece's length less one, and its
    size.  Between the first and the last border of words the score is one number.
    """
    borders = [word_borders(v, text, size) for text, size in chunks]
    middle = v.encode_all([text[b[0]:b[1]] if b else "" for (text, _), b in zip(chunks, borders, strict=True)])[2]
    states, out = v.longest, []
    for (text, size), border, score in zip(chunks, borders, middle, strict=True):
        m = np.full((states, states), _NEVER)
        if border is None:
            for i in range(min(states, len(text) + 1)):
                scores = v.forward(text[i:])[0]
                for j in range(states):
                    if i <= size + j <= len(text):
                        m[i, j] = scores[size + j - i]
        else:
            first, last = border
            ahead = np.array([v.forward(text[i:first])[0][-1] for i in range(states)]) + score
            behind = v.forward(text[last:])[0]
            for j in range(states):
                if size + j <= len(text):
                    m[:, j] = ahead + behind[size + j - last]
        out.append(m)
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two matrices."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def _packed(m: np.ndarray) -> bytes:
    return m.astype(np.float64).tobytes()


def _matrix(b: bytes, states: int) -> np.ndarray:
    return np.frombuffer(b, np.float64).reshape(states, states)


def _encoded(v: Vocabulary, texts: list[str]) -> tuple[pa.Array, list[bool]]:
    """Lists of ids, and whether they stand for the texts again byte by byte."""
    flat, at, _ = v.encode_all(texts)
    back = v.decode(flat)
    same = [True] * len(texts)
    if back != raw("".join(texts)).encode("utf-8", "surrogatepass"):  # then one by one
        same = [v.decode(flat[a:b]) == raw(t).encode("utf-8", "surrogatepass")
                for t, a, b in zip(texts, at[:-1], at[1:], strict=True)]
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, pa.int32())), same


def _parts(batch: pa.RecordBatch, texts: list[str]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Rows of a batch in groups of about SLICE_CHARS characters."""
    group = np.cumsum([len(t) for t in texts]) // SLICE_CHARS
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else []
    for a, b in zip(starts, np.r_[starts[1:], len(texts)], strict=True):
        yield batch.slice(int(a), int(b - a)), texts[a:b]


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, row, chunk, chunks, ids, same): the pieces of every chunk of every text.

    The chunks of a text in order are its encoding; ``same`` says whether a chunk's ids
    decode to its text.  Texts of one chunk are encoded where they lie, others move chunk
    by chunk.  Null and empty texts have one chunk without ids.  Repeated rows and ids are
    texts of their own: chunks of a long text share ``row``.
    """
    v, states = vocabulary, vocabulary.longest
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [SPACE + shown(t) if t else "" for t in batch.column("text").to_pylist()]
            for part, some in _parts(batch, texts):
                ids, same = _encoded(v, some)
                n = part.num_rows
                yield _out(part.column("doc_id"), [0] * n, [0] * n, [1] * n, ids, same)

    short = rows.where(F.length("text") <= CHUNK).mapInArrow(whole, SCHEMA)
    long = rows.where(F.length("text") > CHUNK)
    # a text of its own number: the row's place among the long ones, fixed once it is written
    long = long.withColumn("row", F.monotonically_increasing_id())

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, row, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "text")), strict=True):
                n = -(-len(text) // CHUNK)
                parts = [text[i * CHUNK:(i + 1) * CHUNK + states] for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id] * n, pa.int64()), pa.array([row] * n, pa.int64()), pa.array([n - 1] * n, pa.int64()),
                     pa.array(range(n), pa.int64()), pa.array(parts, pa.string())],
                    ["doc_id", "row", "last", "chunk", "text"])

    chunks = cut_lineage(long.mapInArrow(cut, "doc_id long, row long, last long, chunk long, text string")
                         .repartition("row", "chunk"))

    def matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [_chunk_text(t, c, states) for t, c in zip(
                batch.column("text").to_pylist(), batch.column("chunk").to_pylist(), strict=True)]
            at = 0
            for part, texts in _parts(batch, [t for t, _ in seen]):
                out = [_packed(m) for m in transfers(v, seen[at:at + len(texts)])]
                at += len(texts)
                yield pa.RecordBatch.from_arrays([part.column("row"), part.column("chunk"), part.column("last"),
                                                  pa.array(out, pa.binary())], ["row", "chunk", "last", "m"])

    level = cut_lineage(chunks.select("row", "chunk", "last", "text").mapInArrow(
        matrices, "row long, chunk long, last long, m binary"))
    borders = _border_states(level, states)
    ended = chunks.join(borders, ["row", "chunk"]).select("doc_id", "row", "chunk", "last", "enters", "leaves", "text")

    def traced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            columns = (batch.column(c).to_pylist() for c in ("text", "chunk", "enters", "leaves"))
            for t, c, i, j in zip(*columns, strict=True):
                t, size = _chunk_text(t, c, states)
                texts.append(t[i:size + j])
            for part, some in _parts(batch, texts):
                ids, same = _encoded(v, some)
                yield _out(part.column("doc_id"), part.column("row"), part.column("chunk"),
                           [x + 1 for x in part.column("last").to_pylist()], ids, same)

    return short.unionByName(ended.mapInArrow(traced, SCHEMA))


SCHEMA = "doc_id long, row long, chunk long, chunks long, ids array<int>, same boolean"


def _out(doc_id: pa.Array, *columns) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.bool_())
    return pa.RecordBatch.from_arrays(
        [doc_id, *(c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
        ["doc_id", "row", "chunk", "chunks", "ids", "same"])


def _chunk_text(text: str, chunk: int, states: int) -> tuple[str, int]:
    """A chunk as the vocabulary sees it, with the characters that follow, and its size."""
    size = min(CHUNK, len(text))
    seen = shown(text[:size + states - 1])
    return (SPACE + seen, size + 1) if chunk == 0 else (seen, size)


def _border_states(level: DataFrame, states: int) -> DataFrame:
    """(row, chunk, enters, leaves): the states at both borders of every chunk on the best path.

    Upwards, groups of FANIN neighbours are multiplied until a text is one matrix; its path
    goes from state 0 to state 0.  Downwards, every group that knows its two end states
    finds the best states between its members.
    """
    def multiply(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        m = _matrix(group["m"].iloc[0], states)
        for b in group["m"].iloc[1:]:
            m = product(m, _matrix(b, states))
        return pd.DataFrame({"row": group["row"].iloc[:1], "chunk": group["chunk"].iloc[:1] // FANIN,
                             "last": group["last"].iloc[:1] // FANIN, "m": [_packed(m)]})

    def descend(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk").reset_index(drop=True)
        ms = [_matrix(b, states) for b in group["m"]]
        best, back = np.full(states, _NEVER), []
        best[group["enters"][0]] = 0.0
        for m in ms:
            scores = best[:, None] + m
            back.append(scores.argmax(axis=0))
            best = scores.max(axis=0)
        ends = [int(group["leaves"][0])]
        for b in reversed(back):
            ends.append(int(b[ends[-1]]))
        ends = ends[::-1]
        return pd.DataFrame({"row": group["row"], "chunk": group["chunk"], "enters": ends[:-1], "leaves": ends[1:]})

    levels = [level]
    while (levels[-1].agg(F.max("last").alias("m")).first()["m"] or 0) > 0:
        levels.append(cut_lineage(levels[-1].withColumn("up", F.floor(F.col("chunk") / FANIN)).groupBy("row", "up")
                                  .applyInPandas(multiply, "row long, chunk long, last long, m binary")))
    known = levels[-1].select("row", "chunk", F.lit(0).alias("enters"), F.lit(0).alias("leaves"))
    for below in reversed(levels[:-1]):
        named = known.withColumnRenamed("chunk", "up")
        known = cut_lineage(below.withColumn("up", F.floor(F.col("chunk") / FANIN)).join(named, ["row", "up"])
                            .groupBy("row", "up").applyInPandas(descend, "row long, chunk long, enters int, leaves int"))
    return known


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, text) of (doc_id, ids) rows that hold whole encodings; null ids give null."""
    v = vocabulary

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if ids is None else v.decode(ids)[1:].decode("utf-8", "replace")
                     for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def tokenize(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip), one row per row: whole encodings, checked by decoding."""
    done = encode(docs, vocabulary)
    single = done.where("chunks = 1").select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                                             F.col("same").alias("round_trip"))
    many = done.where("chunks > 1").groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"),
        F.min("same").alias("round_trip"))
    joined = many.select("doc_id", F.flatten(F.col("parts.ids")).alias("ids"), "round_trip")
    return single.unionByName(joined.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip"))

