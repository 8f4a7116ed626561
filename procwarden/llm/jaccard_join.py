"""Documents with like shingle sets: an exact Jaccard join and its components.

A document is the set of its distinct five-word shingles, as 64-bit hashes.  Two
documents link when their sets' intersection is at least 80 % of their union.
Links are found without comparing all pairs:

* equal sets are joined once, by one representative each;
* sets that link share a shingle among the first ``n - ceil(0.8 n) + 1`` of any
  common order of the shingles.  The order is by hash, with the shingles that are
  frequent in a sample of documents last; the sample changes the work only;
* documents that share a shingle of their first parts form a tile.  In each of a
  few rounds every tile has a leader, and its documents of other components are
  compared with it; that finds the groups of copies at a cost linear in the tiles;
* tiles that still hold several components are decided in full: documents outside
  the largest component against all others, in blocks of bounded size and of size
  bands that can link.

In either step the bit counts of hashed bitmaps bound the overlap from above, short
ones first, then longer ones; pairs that pass are decided by the exact intersection
of sorted arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from procwarden.llm.common import byte_slices, lowered, mix, span_hashes, text_bytes, words
from procwarden.llm.graph import components
from procwarden.session import cut_lineage, settle

WORDS = 5
SHARE = 80  # per cent
BITMAP_BITS = (9, 18)  # a signature has a bit or more per shingle, from 2**9 to 2**18 bits
FINE = 8  # times as many bits has the second signature
ROUNDS = 2  # rounds with leaders
#: Documents whose shingles are counted to put frequent ones last, about so many.
SAMPLE = 4_000
#: Frequent shingles known to every task, at most so many.
FREQUENT = 100_000
BLOCK = 256  # documents of a block
#: Ids (8 bytes each) that are broadcast to fetch their texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
_MULTIPLIERS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) | 1 for k in range(WORDS)], np.uint64)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts in a row (signed), and where each set begins."""
    data, offsets = text_bytes(texts)
    data = lowered(data)
    starts, ends, first = words(data, offsets)
    h = span_hashes(data, starts, ends)
    n_words = np.diff(first)
    owner = np.repeat(np.arange(len(texts)), n_words)
    whole = np.flatnonzero((n_words > 0) & (n_words < WORDS))
    if len(h) >= WORDS:
        n = len(h) - WORDS + 1
        sums = np.zeros(n, np.uint64)
        for k in range(WORDS):
            sums += h[k:k + n] * _MULTIPLIERS[k]
        inside = owner[:n] == owner[WORDS - 1:]
        found, who = mix(sums[inside]), owner[:n][inside]
    else:
        found, who = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = []
    for d in whole:  # the whole sequence as one, told apart by its length
        own = h[first[d]:first[d + 1]]
        with np.errstate(over="ignore"):
            short.append((own * _MULTIPLIERS[:len(own)]).sum(dtype=np.uint64) ^ np.uint64(len(own)))
    found = np.concatenate([found, mix(np.array(short, np.uint64))]).view(np.int64)
    who = np.concatenate([who, whole])
    order = np.lexsort((found, who))
    found, who = found[order], who[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (who[1:] != who[:-1])
    found, who = found[fresh], who[fresh]
    return found, np.searchsorted(who, np.arange(len(texts) + 1))


def _digest(shingles: bytes) -> bytes | None:
    return hashlib.blake2b(shingles, digest_size=16).digest() if shingles else None


def bitmap(shingles: np.ndarray, times: int = 1) -> bytes:
    """A bit set for every shingle; sizes are powers of two, so that longer ones fold to shorter ones."""
    size = times << min(max(BITMAP_BITS[0], (len(shingles) - 1).bit_length()), BITMAP_BITS[1])
    bits = np.zeros(size, bool)
    bits[shingles.view(np.uint64) & np.uint64(size - 1)] = True
    return np.packbits(bits).tobytes()


def needed(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Least intersection of linked sets of n and m: 100 i >= 80 (n + m - i)."""
    return -(-SHARE * (n + m) // (100 + SHARE))


def _frequent(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in byte_slices(batches, "text"):
        yield pa.RecordBatch.from_arrays([pa.array(shingle_sets(batch.column("text"))[0])], ["shingle"])


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles that occur in three documents of a sample or more, rarest first.

    ``SAMPLE`` documents of unlike text are drawn by hash, so that copies do not count.
    """
    total = docs.count()
    if not total:
        return np.zeros(0, np.int64)
    drawn = F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < min(1.0, SAMPLE / total) * 1_000_000
    sample = docs.select("text").where(drawn & F.col("text").isNotNull())
    sample = sample.groupBy(F.xxhash64("text").alias("k")).agg(F.first("text").alias("text")).select("text")
    counts = (sample.mapInArrow(_frequent, "shingle long").groupBy("shingle").count().where("count >= 3")
              .orderBy(F.desc("count"), "shingle").limit(FREQUENT))
    return np.array([r["shingle"] for r in counts.collect()][::-1], np.int64)


def _profile(late: np.ndarray):
    """Per document: size, digest and the first part of its set in the common order."""
    by_value = np.argsort(late, kind="stable")
    values = late[by_value]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in byte_slices(batches, "text"):
            found, at = shingle_sets(batch.column("text"))
            rank = np.full(len(found), -1, np.int64)
            if len(values) and len(found):
                where = np.minimum(np.searchsorted(values, found), len(values) - 1)
                hit = values[where] == found
                rank[hit] = by_value[where[hit]]
            digests, parts, marks = [], [], []
            for a, b in zip(at[:-1], at[1:], strict=True):
                own = found[a:b]
                digests.append(_digest(own.tobytes()))
                n_first = (b - a) - (-(-SHARE * (b - a) // 100)) + 1 if b > a else 0
                parts.append(own[np.argsort(rank[a:b], kind="stable")[:n_first]])
                marks.append(bitmap(own) if b > a else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(at)), pa.array(digests, pa.binary()),
                 pa.array(parts, pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                ["doc_id", "n", "digest", "part", "bits"])
    return run


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in byte_slices(batches, "text"):
        found, at = shingle_sets(batch.column("text"))
        sets = [found[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(np.diff(at)), pa.array([bitmap(x, FINE) for x in sets], pa.binary()),
             pa.array([x.tobytes() for x in sets], pa.binary())], ["id", "n", "bits", "shingles"])


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays without repeats."""
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum()) if len(a) and len(b) else 0


def _linked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs that link, of rows with both sets."""
    for batch in batches:
        keep = []
        for a, b in zip(batch.column("set_a"), batch.column("set_b"), strict=True):  # one pair in memory at a time
            a, b = (np.frombuffer(x.as_buffer(), np.int64) for x in (a, b))
            keep.append(overlap(a, b) >= needed(len(a), len(b)))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _folded(mark: bytes, size: int) -> int:
    """A signature as a number of ``size`` bytes."""
    bits = int.from_bytes(mark, "big")
    while (length := len(mark)) > size:
        half = length * 4
        bits = (bits >> half) | (bits & ((1 << half) - 1))
        mark = mark[:length // 2]
    return bits


def may_link(n: int, m: int, a: bytes, b: bytes) -> bool:
    """Whether sets of n and m shingles with these signatures can link at all."""
    least = needed(n, m)
    if least > min(n, m):
        return False
    size = min(len(a), len(b))
    x, y = _folded(a, size), _folded(b, size)
    # a bit that only one signature has stands for one shingle or more that only one set has
    return n - (x & ~y).bit_count() >= least and m - (y & ~x).bit_count() >= least


def _promising(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [may_link(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("n", "m", "bits", "bits_to")),
                                              strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


_KEY = ["tile", "l_band", "l_at", "r_band", "r_at"]


def _runs(batches: Iterable[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple, list[list]]]:
    """Rows of sorted batches by block pair: the key and the values of every column."""
    key, held = None, [[] for _ in columns]
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in _KEY], axis=1)
        starts = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, len(keys)]
        values = [batch.column(c).to_pylist() for c in columns]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            if key != (now := tuple(keys[a].tolist())):
                if key is not None:
                    yield key, held
                key, held = now, [[] for _ in columns]
            for old, new in zip(held, values, strict=True):
                old += new[a:b]
    if key is not None:
        yield key, held


def _pairs(left: list[bool], right: list[bool], comp: list[int], n: list[int], bits: list[bytes],
           lower: list[list[int]]) -> Iterator[tuple[int, int]]:
    """Left against right rows of unlike components that may link and share no lower tile.

    Of two rows that are both left and right one order is enough.
    """
    rights = [j for j, x in enumerate(right) if x]
    sets = [frozenset(x) for x in lower]
    for i in (i for i, x in enumerate(left) if x):
        for j in rights:
            if left[j] and right[i] and j <= i:
                continue
            if comp[i] != comp[j] and sets[i].isdisjoint(sets[j]) and may_link(n[i], n[j], bits[i], bits[j]):
                yield i, j


_ROW = ["left", "right", "id", "comp", "n", "bits", "lower"]


def _open(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Promising pairs of every block pair."""
    for _, (left, right, ids, *rest) in _runs(batches, _ROW):
        pairs = sorted({(min(ids[i], ids[j]), max(ids[i], ids[j])) for i, j in _pairs(left, right, *rest)})
        if pairs:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*pairs, strict=True)], ["a", "b"])


def join_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for (doc_id, text), one row per row.

    Null and empty texts, and texts without words, have size 0 and are linked with
    nothing; so are rows without an id, whose component is null.  Unlike texts under one id
    are documents of their own: their rows are numbered, joined by number, and named by
    the smallest id of their component.  An empty table gives no rows; other columns
    are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return settle(docs.sparkSession, lambda: _joined(docs))


def _joined(docs: DataFrame) -> DataFrame:
    late = frequent_shingles(docs)
    profile = _profiles(docs, late)
    there = profile.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    unlike = there.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high")).where("low < high")
    if unlike.isEmpty():
        component = _components(docs, there)
        return (profile.select("doc_id", F.col("n").alias("n_shingles"),
                               F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
                .join(component, "digest", "left")
                .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))
    numbered = cut_lineage(docs.withColumn("id", F.monotonically_increasing_id()))
    known = numbered.where("doc_id IS NOT NULL").select(F.col("id").alias("doc_id"), "text")
    profile = _profiles(known, late)
    component = _components(known, profile.where("n > 0"))
    rows = cut_lineage(
        numbered.select("id", "doc_id").join(profile.select(F.col("doc_id").alias("id"), "n", "digest"), "id", "left")
        .join(component, "digest", "left").select("doc_id", "n", "component_id", "id"))
    least = rows.where("component_id IS NOT NULL").groupBy("component_id").agg(F.min("doc_id").alias("least"))
    unnamed = _profiles(docs.where("doc_id IS NULL"), late).select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return rows.where("doc_id IS NOT NULL").join(least, "component_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id")).unionByName(unnamed)


def _profiles(docs: DataFrame, late: np.ndarray) -> DataFrame:
    return cut_lineage(docs.mapInArrow(
        _profile(late), "doc_id long, n long, digest binary, part array<long>, bits binary"))


def _components(docs: DataFrame, there: DataFrame) -> DataFrame:
    """(digest, component_id) of every set; an id has one set here."""
    groups = cut_lineage(there.groupBy("digest").agg(F.min("doc_id").alias("id")))
    reps = _representatives(there, groups)
    shared = cut_lineage(reps.select(F.explode("part").alias("tile")).groupBy("tile").count()
                         .where("count > 1").select("tile"))
    first = reps.select("id", "n", F.explode("part").alias("tile"))
    members = cut_lineage(first.hint("merge").join(shared, "tile").withColumn("comp", F.col("id")))
    links = docs.sparkSession.createDataFrame([], "a long, b long")
    for lowest in ([True, False] * ROUNDS)[:ROUNDS]:
        pairs = _leader_pairs(reps, members, lowest)
        if pairs.isEmpty():
            break
        links = cut_lineage(links.union(_linked_pairs(docs, pairs)))
        members = _renamed(members, links)
    pairs = _tile_pairs(reps, members, 2 if ROUNDS else 1)
    links = links.union(_linked_pairs(docs, pairs))
    return groups.join(components(links).withColumnRenamed("node", "id"), "id", "left").select(
        "digest", F.coalesce("component", "id").alias("component_id"))


def few_ids(ids: DataFrame) -> DataFrame:
    """Ids for a join with wide rows: broadcast if they are counted few enough."""
    ids = cut_lineage(ids.distinct())
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def _representatives(there: DataFrame, groups: DataFrame) -> DataFrame:
    """(id, n, part, bits) of one document for every set, the one of the smallest id; only ids move."""
    copies = there.select("digest", "doc_id").join(groups, "digest").where("doc_id != id").select("doc_id")
    reps = there.join(few_ids(copies), "doc_id", "left_anti").withColumnRenamed("doc_id", "id")
    repeated = few_ids(reps.groupBy("id").count().where("count > 1").select("id"))
    if not repeated.isEmpty():  # equal rows: the id and the set are the same
        reps = reps.join(repeated, "id", "left_anti").unionByName(
            reps.join(repeated, "id", "left_semi").dropDuplicates(["id"]).select(*reps.columns))
    return reps


def _renamed(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members with the components that the links make."""
    def build() -> DataFrame:
        named = components(links).withColumnsRenamed({"node": "id", "component": "_comp"})
        return members.join(named, "id", "left").withColumn("comp", F.coalesce("_comp", "id")).drop("_comp")

    return settle(members.sparkSession, build)


def _linked_pairs(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose documents link; their sets are computed from the texts again and then go."""
    return settle(docs.sparkSession, lambda: _found_links(docs, pairs))


def _found_links(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    ids = few_ids(pairs.select(F.col("a").alias("id")).union(pairs.select("b")))
    sets = cut_lineage(docs.withColumnRenamed("doc_id", "id").join(ids, "id", "left_semi").select("id", "text")
                       .mapInArrow(_sets, "id long, n long, bits binary, shingles binary").dropDuplicates(["id"]))
    pairs = cut_lineage(_promising_pairs(pairs, sets))
    both = (pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b")), "b"))
    return both.mapInArrow(_linked, "a long, b long")


def _promising_pairs(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs that may link by their sizes and signatures."""
    marks = signed.select("id", "n", "bits")
    return (pairs.join(marks.withColumnsRenamed({"id": "a"}), "a")
            .join(marks.withColumnsRenamed({"id": "b", "n": "m", "bits": "bits_to"}), "b")
            .select("a", "b", "n", "m", "bits", "bits_to").mapInArrow(_promising, "a long, b long"))


def _leader_pairs(reps: DataFrame, members: DataFrame, lowest: bool) -> DataFrame:
    """Promising pairs of a document and the lowest or highest one of a tile, over components."""
    pick = F.min if lowest else F.max
    leader = (members.groupBy("tile").agg(pick(F.struct("id", "comp")).alias("to"), F.min("comp").alias("low"),
                                          F.max("comp").alias("high"))
              .where("low < high").select("tile", "to.*").withColumnsRenamed({"id": "a", "comp": "to_comp"}))
    pairs = members.join(leader, "tile").where("comp != to_comp").select("a", F.col("id").alias("b")).distinct()
    return cut_lineage(_promising_pairs(pairs, reps))


def _tile_pairs(reps: DataFrame, members: DataFrame, decided: int) -> DataFrame:
    """Promising pairs over the components of a tile; tiles of ``decided`` documents or fewer are done.

    A tile of up to ``BLOCK`` documents is one block, each of its documents comes to it once.
    Larger ones are cut into size bands and those into blocks.
    """
    return settle(reps.sparkSession, lambda: _block_pairs(reps, members, decided))


def _block_pairs(reps: DataFrame, members: DataFrame, decided: int) -> DataFrame:
    per_comp = members.groupBy("tile", "comp").agg(F.count("*").alias("k"))
    mixed = per_comp.groupBy("tile").agg(F.max_by("comp", F.struct("k", "comp")).alias("major"),
                                         F.count("*").alias("comps"), F.sum("k").alias("k")).where(
        (F.col("comps") > 1) & (F.col("k") > decided))
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(float(np.log(100 / SHARE))))
    rows = cut_lineage(members.join(mixed.select("tile", "major", "k"), "tile").select(
        "tile", "id", "comp", "n", band.alias("band"), (F.col("comp") != F.col("major")).alias("minor"),
        (F.col("k") <= BLOCK).alias("whole")))
    # sizes that link differ by a factor of 1.25 at most: a band meets itself and its neighbours
    large = rows.where("NOT whole")
    sizes = large.groupBy("tile", "band").agg(F.ceil(F.count("*") / BLOCK).alias("all"),
                                             F.ceil(F.sum(F.col("minor").cast("int")) / BLOCK).alias("minor"))
    near = sizes.select("tile", "all", "minor", F.col("band").alias("of"),
                        F.explode(F.array(*[F.col("band") + d for d in (-1, 0, 1)])).alias("band"))
    shape = near.groupBy("tile", "band").agg(*[
        F.coalesce(F.max(F.when(F.col("of") == F.col("band") + d, F.col(c))), F.lit(0)).alias(f"{c}_{d + 1}")
        for c in ("all", "minor") for d in (-1, 0, 1)])
    dealt = large.join(shape, ["tile", "band"])

    def at(parts: str):
        return F.pmod(F.xxhash64("id"), F.greatest(F.col(parts), F.lit(1)))

    def upto(parts: str):
        return F.slice(F.sequence(F.lit(0), F.col(parts)), F.lit(1), F.col(parts).cast("int"))

    def block(l_band, l_at, r_band, r_at, left: bool):
        return F.struct(l_band.cast("long").alias("l_band"), l_at.cast("long").alias("l_at"),
                        r_band.cast("long").alias("r_band"), r_at.cast("long").alias("r_at"), F.lit(left).alias("left"))

    def to_rights(d: int):
        return F.when(F.col("minor"), F.transform(upto(f"all_{d + 1}"), lambda x: block(
            F.col("band"), at("minor_1"), F.col("band") + d, x, True)))

    def to_lefts(d: int):
        return F.transform(upto(f"minor_{d + 1}"), lambda x: block(F.col("band") + d, x, F.col("band"), at("all_1"), False))

    to = [f(d) for d in (-1, 0, 1) for f in (to_rights, to_lefts)]
    none = F.array().cast("array<struct<l_band:bigint,l_at:bigint,r_band:bigint,r_at:bigint,left:boolean>>")
    placed = dealt.withColumn("to", F.explode(F.concat(*[F.coalesce(x, none) for x in to]))).select(
        "tile", "to.*", "id", "comp", "n")
    one = [F.lit(0).cast("long").alias(c) for c in _KEY[1:]]
    placed = placed.withColumn("right", ~F.col("left")).unionByName(rows.where("whole").select(
        "tile", *one, F.col("minor").alias("left"), "id", "comp", "n", F.lit(True).alias("right")))
    # a pair is looked at in the lowest tile that both documents are in
    own = rows.groupBy("id").agg(F.collect_list("tile").alias("tiles"))
    placed = placed.join(reps.select("id", "bits").join(own, "id"), "id").withColumn(
        "lower", F.filter("tiles", lambda t: t < F.col("tile"))).select(*_KEY, *_ROW)
    return placed.repartition(*_KEY).sortWithinPartitions(*_KEY).mapInArrow(_open, "a long, b long").distinct()
