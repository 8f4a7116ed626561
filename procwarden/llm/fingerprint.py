"""Merkle fingerprints of documents.

A text is a row of paragraphs (lines; blank ones count).  Paragraphs form
sections: a section ends behind a blank line, before a heading (``#``), and
behind a paragraph whose own hash says so, so that an insertion moves no later
border.  Nodes are hashes of the nodes below, the root is the hash of the
sections: equal roots mean equal texts.  Below a paragraph lie marks of short
pieces cut where its bytes say so.  Two trees are compared from the root down: what
lies below equal nodes is common, only differing sections are opened, and only
differing paragraphs in these; pieces common there count towards likeness too.

A fingerprint is ``root|section;section;...`` with ``paragraph,paragraph,...``
in a section and ``node.marks`` in a paragraph, all in hexadecimal.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procwarden.session import cut_lineage

MARK = 6  # hexadecimal digits of a piece's mark
PIECE_BITS = 4  # a piece has 2**PIECE_BITS bytes on average
SECTION = 8  # a section has about so many paragraphs
RANGE_BYTES = 12_000_000  # text in one range of ids, as long as there are no more than MAX_RANGES
MAX_RANGES = 50_000  # beyond, ranges have more text; rows of a range are streamed
DRAWN = 16  # rows drawn per range to place the borders
PREFIX = 32  # bytes of a text by which rows of one id are ordered, before the text's hash
_LOWEST = -(1 << 63)
_ORDER = f"S{PREFIX + 16}"

Tree = list[tuple[object, list[tuple[object, list]]]]  # sections: node, paragraphs: node, marks of pieces


def _cuts(raw: bytes) -> np.ndarray:
    """Ends of the pieces: after a newline, and where the last four bytes of one line hash low."""
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    low = np.zeros(len(b), bool)
    if len(b) > 4:
        h = (b[3:] * np.uint32(0x9E3779B1) + b[2:-1] * np.uint32(0x85EBCA77)
             + b[1:-2] * np.uint32(0xC2B2AE3D) + b[:-3] * np.uint32(0x27D4EB2F))
        low[3:] = (h >> np.uint32(32 - PIECE_BITS)) == 0
    breaks = b == 10
    for back in range(1, 4):
        low[back:] &= ~breaks[:-back]
    low |= breaks
    if len(b):
        low[-1] = True
    return np.flatnonzero(low) + 1


def fingerprint(text: str) -> tuple[str, Tree]:
    """The fingerprint of one text, and its tree."""
    raw = text.encode("utf-8", "surrogatepass")
    ends = _cuts(raw).tolist()
    marks = [zlib.crc32(raw[a:b]) & 0xFFFFFF for a, b in zip([0, *ends], ends)]
    digits = np.array(marks, ">u4").view(np.uint8).reshape(-1, 4)[:, 1:].tobytes().hex()
    sections: list[list[tuple[object, list]]] = [[]]
    shown: list[list[str]] = [[]]
    done = 0
    lines = raw.split(b"\n")
    of_line = np.searchsorted(ends, np.cumsum([len(x) + 1 for x in lines]), "right").tolist()
    for line, upto in zip(lines, of_line):
        if line.startswith(b"#") and sections[-1]:
            sections.append([])
            shown.append([])
        node = hashlib.blake2b(line, digest_size=16).digest()
        sections[-1].append((node, marks[done:upto]))
        shown[-1].append(f"{node[:8].hex()}.{digits[done * MARK:upto * MARK]}")
        done = upto
        if not line.strip() or node[-1] % SECTION == 0:
            sections.append([])
            shown.append([])
    if not sections[-1]:
        sections.pop()
        shown.pop()
    nodes = [hashlib.blake2b(b"".join(n for n, _ in s), digest_size=16, person=b"section").digest() for s in sections]
    root = hashlib.blake2b(b"".join(nodes), digest_size=16, person=b"root").hexdigest()
    return f"{root}|{';'.join(','.join(s) for s in shown)}", list(zip(nodes, sections, strict=True))


def _tree(print_: str) -> Tree:
    """The tree that a fingerprint tells of; a section's node is the row of its paragraphs' nodes."""
    out: Tree = []
    for section in print_.split("|", 1)[1].split(";"):
        parts = [p.split(".") for p in section.split(",")]
        out.append((tuple(n for n, _ in parts),
                    [(n, [m[i:i + MARK] for i in range(0, len(m), MARK)]) for n, m in parts]))
    return out


def _unmatched(nodes: Iterable, others: Iterable) -> list[int]:
    """Places of the nodes that have no partner among the others."""
    free, out = Counter(others), []
    for i, node in enumerate(nodes):
        if free[node] > 0:
            free[node] -= 1
        else:
            out.append(i)
    return out


def _opened(tree: Tree, other: Tree) -> list[tuple[int, object, list]]:
    """Paragraphs (place, node, marks) of the sections that the other tree has not."""
    starts = np.cumsum([0, *(len(s) for _, s in tree)]).tolist()
    return [(starts[i] + k, node, marks) for i in _unmatched((n for n, _ in tree), (n for n, _ in other))
            for k, (node, marks) in enumerate(tree[i][1])]


def descend(a: Tree, b: Tree) -> tuple[float, list[int]]:
    """Likeness of two trees with unlike roots, and the paragraphs of ``b`` (from 0) that ``a`` has not.

    Likeness is the share of both texts' pieces that lie below equal nodes or are common
    to the differing paragraphs.
    """
    left, right = _opened(a, b), _opened(b, a)
    ours, theirs = ([x[i] for i in _unmatched((n for _, n, _ in x), (n for _, n, _ in y))]
                    for x, y in ((left, right), (right, left)))
    total = sum(len(m) for t in (a, b) for _, s in t for _, m in s)
    apart = [[m for _, _, marks in x for m in marks] for x in (ours, theirs)]
    common = total - sum(map(len, apart)) + 2 * (Counter(apart[0]) & Counter(apart[1])).total()
    return common / total if common else 0.0, [place for place, _, _ in theirs]


def compare(a: str, b: str) -> tuple[float, list[int]]:
    """Likeness of two fingerprints, and the paragraphs of the second (from 0) that the first has not."""
    if a.split("|", 1)[0] == b.split("|", 1)[0]:
        return 1.0, []
    return descend(_tree(a), _tree(b))


def likeness(a: str, b: str) -> float:
    """Share of the pieces that two fingerprints have in common, 0 to 1; equal ones give 1."""
    return compare(a, b)[0]


def locate_edits(a: str, b: str) -> list[int]:
    """Paragraphs of ``b`` (from 0) that ``a`` has not, found below differing sections only."""
    return compare(a, b)[1]


SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double, edited_paragraphs string")


def _arrow_schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    return pa.schema([(n, kinds[t]) for n, t in (c.split() for c in SCHEMA.split(", "))])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document, from rows in id order that end with the next range's first."""
    held, out, size = None, [], 0
    for batch in batches:
        for bucket, carry, doc_id, text in zip(*(batch.column(i) for i in range(4)), strict=True):
            bucket, carry, doc_id, text = bucket.as_py(), carry.as_py(), doc_id.as_py(), text.as_py() or ""
            print_, tree = fingerprint(text)
            if held is not None and held[0] == bucket:
                _, old_id, old, old_print, old_tree = held
                half = len(old) // 2
                edited = old[:len(old) - half] + text[:half]
                new_print, new_tree = fingerprint(edited)
                near, places = (1.0, []) if new_print == old_print else descend(old_tree, new_tree)
                out.append((old_id, len(old), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                            old_print, new_print, near,
                            1.0 if print_ == old_print else descend(old_tree, tree)[0], ",".join(map(str, places))))
                size += len(old) + 100
            held = None if carry else (bucket, doc_id, text, print_, tree)
            if size > 4_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _arrow_schema())],
                                                 schema=_arrow_schema())
                out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _arrow_schema())],
                                         schema=_arrow_schema())


def _order(doc_id: Column, text: Column) -> Column:
    """Bytes that sort as (id, null first; first bytes of the text; hash of the text)."""
    def eight(x: Column) -> Column:
        return F.unhex(F.lpad(F.hex(x), 16, "0"))

    raw = F.coalesce(text, F.lit("")).cast("binary")
    low = F.coalesce(doc_id.cast("long"), F.lit(_LOWEST)).bitwiseXOR(F.lit(_LOWEST))  # signed to unsigned order
    return F.concat(eight(low), F.rpad(F.substring(raw, 1, PREFIX), PREFIX, F.lit(b"\0")), eight(F.xxhash64(raw)))


def _range_starts(rows: DataFrame) -> list[bytes]:
    """First keys of ranges that hold like amounts of text; every one is the key of a row.

    Rows are drawn by a hash, in proportion to their bytes: DRAWN of them per range reach
    the driver, MAX_RANGES * DRAWN at most.
    """
    sized = cut_lineage(rows.select("_order", (F.coalesce(F.octet_length("_text"), F.lit(0)) + 1).alias("_bytes")))
    told = sized.agg(F.sum("_bytes").alias("total"), F.min("_order").alias("first")).first()
    if told["total"] is None:
        return []
    n_ranges = min(-(-told["total"] // RANGE_BYTES), MAX_RANGES)
    first = bytes(told["first"])
    if n_ranges == 1:
        return [first]
    every = max(told["total"] // (n_ranges * DRAWN), 1)
    drawn = sized.where(F.pmod(F.xxhash64("_order"), F.lit(every)) < F.col("_bytes")).select("_order").distinct()
    keys = sorted(bytes(r["_order"]) for r in drawn.collect())
    return sorted({first, *keys[DRAWN - 1::DRAWN]})


def _dealer(starts: list[bytes]):
    """Of a row's key: its range, and whether it is the range's first."""
    bounds = np.array(starts, _ORDER)

    @F.pandas_udf("bucket int, first boolean")
    def deal(order: pd.Series) -> pd.DataFrame:
        keys = np.array(order.tolist(), _ORDER)
        bucket = np.searchsorted(bounds, keys, "right") - 1
        return pd.DataFrame({"bucket": bucket.astype(np.int32), "first": bounds[bucket] == keys})

    return deal


def fingerprint_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edited text replaces the last half of the code points by the first as
    many of the next document's, ids ascending; the last one's next is the first.
    ``edited_paragraphs`` are the places (from 0, comma-joined) of the paragraphs that the
    edit brought, found by descending both trees.
    Whole texts move once: rows are cut into ranges of like bytes, and the first
    document of a range is also sent to the range before.

    Null texts count as empty, null ids come first; equal ids are ordered by the first
    bytes and then the hash of their text, so they are split as well, but for rows equal in
    both; other columns are ignored.  An empty table gives no rows; a single document is
    its own next.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("_id"), F.col(text_column).alias("_text"),
                       _order(F.col(id_column), F.col(text_column)).alias("_order"))
    starts = _range_starts(rows)
    if not starts:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    n = len(starts)
    at = F.col("_at")
    own = F.struct(at["bucket"].alias("bucket"), F.lit(0).alias("carry"))
    before = F.struct(F.pmod(at["bucket"] - 1, F.lit(n)).alias("bucket"), F.lit(1).alias("carry"))
    dealt = (rows.withColumn("_at", _dealer(starts)("_order"))
             .withColumn("_to", F.explode(F.when(at["first"], F.array(own, before)).otherwise(F.array(own))))
             .select("_to.bucket", "_to.carry", "_id", "_text", "_order")
             .repartitionById(n, F.col("bucket"))
             .sortWithinPartitions("bucket", "carry", "_order")
             .select("bucket", "carry", "_id", "_text"))
    return dealt.mapInArrow(_rows, SCHEMA)
