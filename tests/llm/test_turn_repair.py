import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SMALL
from procwarden.llm import queries
from procwarden.llm import turn_repair as T
from procwarden.llm.common import table

ROWS = "conv_id long, turn long, role string, text string, here string, fault string, id long, cost long, audit long"
EMPTY = hashlib.sha256(b"").hexdigest()


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        row = (conv, turn, "user" if kind == 4 else role, {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text))
        out += [row] * {0: 0, 3: 2}.get(kind, 1)
    return out


def cheapest(rows):
    """All ways, place by place, with their whole edits and turns; the least (cost, edits)."""
    def fits(initials):
        return re.fullmatch("(s?(ua)+)?", initials) is not None

    def begun(initials):
        return re.fullmatch("s?(ua)*u?", initials) is not None

    ways = {"": (0, "", [])}  # initials (their last two tell the rest) -> way

    def keep(ways, initials, way):
        if begun(initials):
            key = initials if len(initials) < 4 else initials[:len(initials) % 2 + 2] if initials[0] != "s" else initials[:3 + (len(initials) + 1) % 2]
            if key not in ways or way[:2] < ways[key][:2]:
                ways[key] = way

    def with_inserts(ways):
        out = dict(ways)
        for _ in range(3):
            for initials, (cost, edits, turns) in list(out.items()):
                for role in ("user", "assistant"):
                    keep(out, initials + role[0], (cost + 3, edits + "I", [*turns, (role, "")]))
        return out

    for fault, role, text in rows:
        after = {}
        for initials, (cost, edits, turns) in with_inserts(ways).items():
            keep(after, initials, (cost + 4, edits + "D", turns))
            if fault in (1, 2):
                continue
            more = 3 if fault == 3 else 0
            if role:
                keep(after, initials + role[0], (cost + more, edits + "K", [*turns, (role, text)]))
            for new in ("user", "assistant"):
                keep(after, initials + new[0], (cost + 3 + more, edits + "R", [*turns, (new, text)]))
        ways = after
    return min((w for i, w in with_inserts(ways).items() if fits(i)), key=lambda w: w[:2])


def brute(rows, all_ids):
    out = {}
    for conv in all_ids:
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, judged = set(), []
        for _, role, text in own:
            shown = text.strip(" \t\n\x0b\x0c\r")
            fault = 1 if not shown else 2 if (role, text) in seen else 3 if shown[-1] not in ".!?" else 0
            seen.add((role, text))
            judged.append((fault, role, text))
        cost, edits, turns = cheapest(judged)
        known = [t for t, *_ in own if t is not None]
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:], strict=False)]
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0,
                     *(sum(f == k for f, *_ in judged) for k in (1, 2, 3)), sum(p not in ("su", "ua", "au") for p in pairs),
                     cost, edits, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest())
    return out


def sample(n=120, seed=2):
    rng = np.random.default_rng(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "ärger"]
    texts = ["Hello.", "Yes!", "Why?", "cut off", "Done. \n", " ", "", None, "…", "a\x85", "Fine.\x0b", "no end ", "?x"]
    rows = []
    for conv in [*range(n), None]:
        for k in range(int(rng.integers(1, 11))):
            turn = None if rng.random() < 0.05 else int(k + rng.integers(0, 3) - 1)
            pick = rng.integers(len(roles)) if rng.random() < 0.4 else k % 2
            text = texts[rng.integers(len(texts))] if rng.random() < 0.5 else f"Text {k}."
            rows.append((conv, turn, roles[pick], text))
    return rows


def frame(spark, rows, parts=4):
    return spark.createDataFrame([(*r, "x", "y", 3, 4, 5) for r in rows], ROWS).repartition(parts)


def found(df):
    got = df.collect()
    out = {r.conv_id: tuple(r[c] for c in ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"])
           for r in got}
    assert len(out) == len(got)
    return out


@pytest.mark.parametrize("spill, batch", [(T.SPILL_BYTES, 10_000), (8, 3)])
def test_against_all_ways(spark, spill, batch):
    """Conversations that go over several batches, and ways that are written out."""
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in sample()]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert found(T.repair(frame(spark, sample()), spill_bytes=spill)) == brute(rows, {r[0] for r in rows})
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_damage(spark):
    rows = sample(200, 5)
    rows += [(5000 + i, 0, "user", "Only one.") for i in range(60)]  # some lose their only row
    df = T.damaged(frame(spark, rows))
    got = found(T.repair(df, F.col("present")))
    assert got == brute(damage(rows), {r[0] for r in rows})
    assert (0, 0, 0, 0, 0, 0, "", EMPTY) in got.values()
    here = sorted(str(tuple(r)[:4]) for r in df.where("present").collect())
    assert here == sorted(map(str, damage(rows)))


def test_repaired_turns(spark):
    """The turns that the edits give have the hash that the first stream gave."""
    df = frame(spark, sample(80, 7))
    repairs = T.repair(df)
    turns = {}
    for r in sorted(T.repaired_turns(df, repairs).collect(), key=lambda r: r.position):
        turns.setdefault(r.conv_id, []).append(r)
    for r in repairs.collect():
        own = turns.get(r.conv_id, [])
        assert [t.position for t in own] == list(range(len(own)))
        assert "".join(t.edit for t in own) == r.audit.replace("D", "")
        assert re.fullmatch("(s?(ua)+)?", "".join(t.role[0] for t in own))
        assert hashlib.sha256("\n".join(f"{t.role}:{t.text}" for t in own).encode()).hexdigest() == r.repaired_sha256


def test_one_giant_conversation(spark):
    """A third of all rows in one conversation, with a very long text."""
    n = 30_000
    rows = [(1, i, ("user", "assistant")[i % 2], f"Turn {i}.") for i in range(n)]
    rows[7] = (1, 7, "assistant", "long " * 200_000 + ".")
    rows += [(2 + i // 2, i % 2, ("user", "assistant")[i % 2], "Yes.") for i in range(2 * n)]
    got = {r.conv_id: r for r in T.repair(frame(spark, rows), spill_bytes=1000).collect()}
    whole = "\n".join(f"{r}:{t}" for c, _, r, t in rows if c == 1)
    assert got[1].audit == "K" * n and got[1].repaired_sha256 == hashlib.sha256(whole.encode()).hexdigest()
    assert len(got) == n + 1 and all(r.cost == 0 for r in got.values())


def test_no_rows(spark):
    assert T.repair(frame(spark, [])).collect() == []


def test_query(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.QUERIES["op12_conversation_repair"](spark, SMALL)) == brute(damage(rows), {r[0] for r in rows})
