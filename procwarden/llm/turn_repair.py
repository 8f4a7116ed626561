"""Repair of conversations: a secondary-sorted stream that carries the state of a dynamic programme.

Rows are dealt out by conversation and sorted by turn inside each partition; one Python
function reads them in order, across Arrow batches.  The roles of a sound conversation
begin with an optional system turn, then user and assistant take turns and the
assistant ends: ``(s?(ua)+)?`` over their initials.  After every row there is one
cheapest way to each of the four places in that pattern; among equally cheap ways the
one whose edits come first in ASCII order.

What the stream holds per place is a cost, the rank of the way among the four, and a
running hash of the repaired text, so no text is kept.  The way itself is four bytes a
row, written to a temporary file of the task beyond ``SPILL_BYTES`` and read from its end
when the conversation is over; like Spark's own spill files, it is made again by
whichever task replaces a lost one.  The relative costs, the ranks and the kind of
a row decide a step, so steps are looked up after they were worked out once.

A conversation is read by one task, however long it is: its hash runs over all its
text in order.  That task's memory does not grow with it, and nothing of it is collected.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SPILL_BYTES = 16_000_000
KEEP, REROLE, DELETE, INSERT = "KRDI"
RELABEL_COST, DELETE_COST, INSERT_COST, CUT_COST = 3, 4, 3, 3
CLEAN, BLANK, DUPLICATE, TRUNCATED = range(4)
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
# Places in the pattern: nothing yet, behind the system turn, behind a user's, behind an assistant's.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = {_START: _USER, _SYSTEM: _USER, _USER: _ASSISTANT, _ASSISTANT: _USER}  # where an inserted or renamed turn leads
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
_INITIAL = {"u": _USER, "a": _ASSISTANT}
_LEGAL = {"su", "ua", "au"}
_NO_WAY = 1 << 40
_NONE = 255
SCHEMA = ("conv_id long, unnamed boolean, gaps long, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string, repaired_sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """The rows after the damage that a hash of conversation and turn decides.

    (conv_id, turn, role, text, present): a dropped row stays with ``present`` false, so that
    its conversation is known.  Null roles and texts are one space, as are nulls in the hash.
    """
    def named(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(named("conv_id"), F.lit(":"), named("turn"))) % 20
    role, text = named("role"), named("text")
    marked = rows.select("conv_id", "turn", kind.alias("kind"), role.alias("role"), text.alias("text"))
    return marked.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind").isin(0, 1), "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(
            F.col("text")).alias("text"),
        (F.col("kind") != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1)))).drop("col")


def in_turn_order(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """Rows with initial and first fault, dealt out by conversation and sorted inside it.

    One shuffle: the duplicates are found in the same partitions, by a window inside a
    conversation.  Order: turn (nulls first), role, text.
    """
    here = F.lit(True) if present is None else present
    staged = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                         F.coalesce("text", F.lit(" ")).alias("text"), here.alias("here")).repartition("conv_id")
    same = W.partitionBy("conv_id", "here", "role", "text").orderBy(F.asc_nulls_first("turn"))
    last = F.right(F.rtrim("text", F.lit(_SPACES)), F.lit(1))
    fault = (F.when(last == "", BLANK).when(F.row_number().over(same) > 1, DUPLICATE)
             .when(last.isin(".", "!", "?"), CLEAN).otherwise(TRUNCATED))
    return staged.withColumns({"initial": F.substring("role", 1, 1), "fault": fault}).sortWithinPartitions(
        F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text")


class _Steps:
    """Steps of the programme, each worked out once.

    A state is (costs above the least, ranks) of the four places.  A step gives the added
    cost, the next state and for every place (from, inserted, edit) or None.
    """

    def __init__(self) -> None:
        self.known: dict = {}

    def __call__(self, state, initial: str, fault: int):
        key = state, initial, fault
        if key not in self.known:
            self.known[key] = self._work_out(*key)
        return self.known[key]

    @staticmethod
    def _work_out(state, initial: str, fault: int):
        costs, ranks = state
        best: list = [None] * 4

        def offer(to: int, cost: int, rank: int, edits: str, move) -> None:
            if best[to] is None or (cost, rank, edits) < best[to][:3]:
                best[to] = (cost, rank, edits, move)

        extra = CUT_COST if fault == TRUNCATED else 0
        for place in range(4):
            if costs[place] >= _NO_WAY:
                continue
            offer(place, costs[place] + DELETE_COST, ranks[place], DELETE, (place, 0, DELETE))
            if fault in (BLANK, DUPLICATE):
                continue
            for inserted in (0, 1):  # a second inserted turn leads to no cheaper or earlier way
                at = _NEXT[place] if inserted else place
                cost, edits = costs[place] + INSERT_COST * inserted + extra, INSERT * inserted
                if initial == "s" and at == _START:
                    offer(_SYSTEM, cost, ranks[place], edits + KEEP, (place, inserted, KEEP))
                if _INITIAL.get(initial) == _NEXT[at]:
                    offer(_NEXT[at], cost, ranks[place], edits + KEEP, (place, inserted, KEEP))
                offer(_NEXT[at], cost + RELABEL_COST, ranks[place], edits + REROLE, (place, inserted, REROLE))
        least = min(b[0] for b in best if b)
        order = sorted({b[1:3] for b in best if b})
        after = (tuple(b[0] - least if b else _NO_WAY for b in best), tuple(order.index(b[1:3]) if b else 0 for b in best))
        moves = [b and b[3] for b in best]
        packed = bytes(m[0] | m[1] << 2 | "KRD".index(m[2]) << 3 if m else _NONE for m in moves)
        return least, after, moves, packed


class _Conversation:
    """What is known of the conversation that is being read."""

    def __init__(self, conv_id: int, unnamed: bool, spill_bytes: int) -> None:
        self.name = (conv_id, unnamed)
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.rows = 0
        self.turns, self.first_turn, self.turn = 0, None, None
        self.state = ((0, _NO_WAY, _NO_WAY, _NO_WAY), (0, 0, 0, 0))
        self.hashes: list = [hashlib.sha256(), None, None, None]
        self.initial: str | None = None
        self.ways = tempfile.SpooledTemporaryFile(max_size=spill_bytes)

    def add(self, steps: _Steps, turn: int | None, initial: str, fault: int, role: str, text: str) -> None:
        self.blank += fault == BLANK
        self.duplicate += fault == DUPLICATE
        self.truncated += fault == TRUNCATED
        if self.initial is not None and self.initial + initial not in _LEGAL:
            self.illegal += 1
        self.initial = initial
        if turn is not None and turn != self.turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turn = turn
        least, self.state, moves, packed = steps(self.state, initial, fault)
        self.cost += least
        self.rows += 1
        self.ways.write(packed)
        hashes: list = [None] * 4
        for to, move in enumerate(moves):
            if move is None:
                continue
            place, inserted, edit = move
            if edit == DELETE:
                hashes[to] = self.hashes[place]
                continue
            hashes[to] = self.hashes[place].copy()
            hashes[to].update(_inserted(place, inserted).encode())
            kept_as = role if edit == KEEP else _ROLE[to]
            hashes[to].update(f"{'' if place == _START and not inserted else chr(10)}{kept_as}:{text}".encode())
        self.hashes = hashes

    def end(self) -> tuple:
        """The row of the conversation: the cheapest way to a place where it may end."""
        costs, ranks = self.state
        ends = [(costs[p] + INSERT_COST * n, ranks[p], INSERT * n, p, n)
                for p, n in ((_START, 0), (_SYSTEM, 2), (_USER, 1), (_ASSISTANT, 0)) if costs[p] < _NO_WAY]
        cost, _, _, place, inserted = min(ends)
        digest = self.hashes[place].copy()
        digest.update(_inserted(place, inserted).encode())
        audit = self._trace(place) + INSERT * inserted
        gaps = self.turn - self.first_turn + 1 - self.turns if self.turns else 0
        return (*self.name, gaps, self.blank, self.duplicate, self.truncated, self.illegal,
                self.cost + cost, audit, digest.hexdigest())

    def _trace(self, place: int) -> str:
        """The edits up to the last row, read from the end of the written ways."""
        edits, block = bytearray(), 250_000
        for first in reversed(range(0, self.rows, block)):
            self.ways.seek(first * 4)
            part = self.ways.read(min(block, self.rows - first) * 4)
            for at in range(len(part) - 4, -1, -4):
                move = part[at + place]
                edits += ("KRD"[move >> 3] + INSERT * (move >> 2 & 1)).encode()
                place = move & 3
        self.ways.close()
        edits.reverse()
        return edits.decode()


def _inserted(place: int, n: int) -> str:
    """The text of ``n`` empty turns behind a place, with the line ends between turns."""
    out = ""
    for _ in range(n):
        out += ("" if place == _START else "\n") + _ROLE[_NEXT[place]] + ":"
        place = _NEXT[place]
    return out


def repair(rows: DataFrame, present: Column | None = None, spill_bytes: int = SPILL_BYTES) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits and the hash of the result.

    ``rows``: conv_id, turn, role, text, of which any may be null; other columns are not
    read, whatever they are called.  Null roles and texts are one space.  Rows without a
    conv_id are one conversation, rows without a turn come first.  Rows of one turn are
    ordered by role and text; equal ones are duplicates.  A role without a first
    character fits nowhere.  Where ``present`` is false a row only names its conversation; a
    conversation without present rows has zeros, no edits and the hash of the empty text.
    A table without rows gives none.
    """
    columns = ["id", "unnamed", "here", "turn", "timeless", "initial", "fault", "role", "text"]
    ordered = in_turn_order(rows, present).select(
        F.coalesce("conv_id", F.lit(0)).cast("long").alias("id"), F.col("conv_id").isNull().alias("unnamed"), "here",
        F.coalesce("turn", F.lit(0)).cast("long").alias("turn"), F.col("turn").isNull().alias("timeless"),
        "initial", "fault", "role", "text")
    names = [c.split()[0] for c in SCHEMA.split(", ")]

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps, now = _Steps(), None
        for pdf in batches:
            done = []
            for conv, unnamed, here, turn, timeless, initial, fault, role, text in zip(
                    *(pdf[c].tolist() for c in columns), strict=True):
                if now is None or now.name != (conv, unnamed):
                    if now is not None:
                        done.append(now.end())
                    now = _Conversation(conv, unnamed, spill_bytes)
                if here:
                    now.add(steps, None if timeless else turn, initial, fault, role, text)
            if done:
                yield pd.DataFrame(done, columns=names)
        if now is not None:
            yield pd.DataFrame([now.end()], columns=names)

    found = ordered.mapInPandas(run, SCHEMA)
    return found.withColumn("conv_id", F.when(~F.col("unnamed"), F.col("conv_id"))).drop("unnamed")


def repaired_turns(rows: DataFrame, repairs: DataFrame, present: Column | None = None) -> DataFrame:
    """(conv_id, position, edit, role, text): the turns of the repaired conversations.

    ``repairs`` is what ``repair`` gives for the same rows.  Each conversation's edits
    are sorted in front of its rows and the same kind of stream carries them out.
    """
    kept = in_turn_order(rows, present).where("here").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "initial")
    heads = repairs.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"),
                           F.lit("").alias("role"), F.col("audit").alias("text"), F.lit("").alias("initial"))
    both = kept.unionByName(heads).repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), "kind", F.asc_nulls_first("turn"), "role", "text")
    numbered = both.select(F.coalesce("conv_id", F.lit(0)).cast("long").alias("id"),
                           F.col("conv_id").isNull().alias("unnamed"), "kind", "role", "text", "initial")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        audit, at, place, position, out = "", 0, _START, 0, []

        def put(name, edit, role, text) -> None:
            nonlocal position
            out.append((*name, position, edit, role, text))
            position += 1

        def insert(name) -> None:
            nonlocal at, place
            while at < len(audit) and audit[at] == INSERT:
                place, at = _NEXT[place], at + 1
                put(name, INSERT, _ROLE[place], "")

        for pdf in batches:
            for conv, unnamed, kind, role, text, initial in zip(*(pdf[c].tolist() for c in pdf.columns), strict=True):
                name = conv, unnamed
                if kind == 0:
                    audit, at, place, position = text, 0, _START, 0
                else:
                    edit, at = audit[at], at + 1
                    if edit != DELETE:
                        place = _SYSTEM if edit == KEEP and initial == "s" else _NEXT[place]
                        put(name, edit, role if edit == KEEP else _ROLE[place], text)
                insert(name)
            yield pd.DataFrame(out, columns=["conv_id", "unnamed", "position", "edit", "role", "text"])
            out.clear()

    found = numbered.mapInPandas(run, "conv_id long, unnamed boolean, position long, edit string, role string, text string")
    return found.withColumn("conv_id", F.when(~F.col("unnamed"), F.col("conv_id"))).drop("unnamed")
