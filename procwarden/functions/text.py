"""SQL expressions over paths and command lines.

The functions take and give Spark SQL text, so that an expression with dozens
of constants is handed to Spark in one piece.  ``col`` turns it into a column.  The
entropy and the figures of arguments are columns: no built-in function counts characters
in one pass, and splitting every line to count its parts costs most of a row's time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from procwarden.fixed_values import SUSPICIOUS_FLAGS, WHITESPACE

HISTOGRAM_BYTES = 1_000_000  # of texts whose characters are counted at once
HISTOGRAM_TEXTS = 1_024
LONG_BYTES = 400  # texts of this size on average are counted one by one, which takes no array of places


def col(sql: str) -> Column:
    return F.expr(sql)


def quoted(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(value: float) -> str:
    """A double literal with all digits."""
    return f"({float(value)!r}D)"


def name_list(values: list[str]) -> str:
    return "(" + ", ".join(quoted(v) for v in values) + ")"


def filled(c: str) -> str:
    """Null becomes the empty string."""
    return f"coalesce(cast({c} AS string), '')"


def basename(c: str, lower: bool = True) -> str:
    """Last segment of a Windows path; empty or null gives ``unknown``."""
    last = f"substring_index(substring_index({c}, '/', -1), '\\\\', -1)"
    return (f"CASE WHEN {c} IS NULL OR {c} = '' THEN 'unknown' "
            f"ELSE {f'lower({last})' if lower else last} END")


def contains_any(c: str, needles: list[str]) -> str:
    return "(" + " OR ".join(f"contains({c}, {quoted(n)})" for n in needles) + ")"


def flag(condition: str) -> str:
    """Boolean to 0/1; null counts as 0."""
    return f"cast(coalesce({condition}, false) AS int)"


def half_even(c: Column | str, digits: int) -> Column | str:
    """Round half to even with the same floating-point steps in every engine."""
    scale = float(10 ** digits)
    if isinstance(c, str):
        return f"(rint(({c}) * {number(scale)}) / {number(scale)})"
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def let(name: str, value: str, body: str) -> str:
    """Evaluate ``value`` once and use it as ``name`` in ``body``."""
    return f"transform(array({value}), {name} -> {body})[0]"


def stretches(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, raw, ends) of stretches of about ``HISTOGRAM_BYTES``, which bound what a task holds.

    ``raw`` are the bytes of texts ``first`` to ``last``; a text's bytes lie between two of ``ends``.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(ends, ends[first] + HISTOGRAM_BYTES, "right")) - 1
        last = min(max(last, first + 1), first + HISTOGRAM_TEXTS, len(texts))
        yield first, last, data[ends[first]:ends[last]], ends[first:last + 1] - ends[first]
        first = last


def byte_counts(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How often each byte stands in each text of a stretch: a row of counts per text."""
    n, width = len(ends) - 1, 256 if len(raw) and raw.max() >= 128 else 128
    if len(raw) >= LONG_BYTES * n:
        return np.array([np.bincount(raw[a:b], minlength=width) for a, b in zip(ends[:-1], ends[1:])])
    owner = np.repeat(np.arange(n) * width, np.diff(ends))
    return np.bincount(owner + raw, minlength=n * width).reshape(n, width)


def wide_counts(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and number of every different character beyond ASCII, by text and code point.

    Only the bytes of such characters are decoded; without the others they are text as well.
    """
    begun = np.flatnonzero(raw >= 0xC0)
    wide = np.frombuffer(raw[raw >= 0x80].tobytes().decode().encode("utf-32-le"), np.uint32)
    owner = np.searchsorted(ends, begun, "right") - 1
    found, counts = np.unique((owner << 21) + wide, return_counts=True)
    return found >> 21, counts


def entropies(texts: pa.Array) -> np.ndarray:
    """Bits per character of every text, 4 decimals; empty and null texts give 0.

    A character of one byte is counted as that byte, others as what they are decoded to.
    """
    out = np.zeros(len(texts))
    for first, last, raw, ends in stretches(texts):
        counts = byte_counts(raw, ends)
        sizes = np.diff(ends) - counts[:, 0x80:0xC0].sum(axis=1)  # bytes that begin a character
        narrow = counts[:, :0x80].ravel()
        held = np.flatnonzero(narrow)  # few of all characters stand in a text
        text, number = held >> 7, narrow[held]
        if counts[:, 0x80:].any():
            beyond = wide_counts(raw, ends)
            text, number = np.r_[text, beyond[0]], np.r_[number, beyond[1]]
        share = number / sizes[text]
        bits = -np.bincount(text, share * np.log2(share), minlength=last - first)
        out[first:last] = np.rint(bits * 1e4) / 1e4 + 0.0
    return out


def shannon_entropy(c: str) -> Column:
    """Bits per character of a text column, in one pass over its characters."""
    @F.arrow_udf("double")
    def entropy(texts: pa.Array) -> pa.Array:
        return pa.array(entropies(texts))

    return entropy(F.col(c))


def blank_bytes(raw: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 texts belong to white space."""
    wide = [c.encode() for c in WHITESPACE if not c.isascii()]
    kinds = np.zeros(256, np.uint8)
    kinds[[ord(c) for c in WHITESPACE if c.isascii()]] = 1
    kinds[[w[0] for w in wide]] = 2  # may begin a wide one
    kind = np.frombuffer(raw.tobytes().translate(kinds.tobytes()), np.uint8)
    space, at = kind == 1, np.flatnonzero(kind == 2)
    padded = np.append(raw, np.zeros(2, np.uint8))
    for size in {len(w) for w in wide if len(at)}:
        told = sum(padded[at + i].astype(np.int64) << 8 * (size - 1 - i) for i in range(size))
        found = at[np.isin(told, [int.from_bytes(w) for w in wide if len(w) == size])]
        for i in range(size):
            space[found + i] = True
    return space


def argument_counts(texts: pa.Array) -> np.ndarray:
    """White-space separated arguments of every text; null counts as empty."""
    out = np.zeros(len(texts), np.int32)
    for first, last, raw, ends in stretches(texts):
        space = blank_bytes(raw)
        before = np.r_[True, space[:-1]] if len(space) else space
        before[ends[:-1][np.diff(ends) > 0]] = True  # a text's first byte follows none
        begun = np.flatnonzero(before & ~space)
        out[first:last] = np.diff(np.searchsorted(begun, ends))
    return out


def argument_count(c: str) -> Column:
    """White-space separated arguments of a text column."""
    @F.arrow_udf("int")
    def arguments(texts: pa.Array) -> pa.Array:
        return pa.array(argument_counts(texts))

    return arguments(F.col(c))


def flagged_shares(texts: pa.Array) -> np.ndarray:
    """Share of every text's arguments that hold a suspicious flag, 4 decimals; none without arguments.

    A match begins with a flag and takes the rest of its argument, so that there is one for
    each argument with a flag.  No argument holds a flag with white space inside.
    """
    flags = [re.escape(f) for f in SUSPICIOUS_FLAGS if not any(c in WHITESPACE for c in f)]
    found = pc.count_substring_regex(texts, f"(?:{'|'.join(flags)})[^{WHITESPACE}]*").fill_null(0)
    hits = found.to_numpy(zero_copy_only=False)
    out, some = np.zeros(len(texts)), np.flatnonzero(hits)
    sizes = argument_counts(texts.take(pa.array(some)))
    out[some] = np.rint(hits[some] / sizes * 1e4) / 1e4
    return out


def flagged_share(c_lower: str) -> Column:
    """Share of the arguments of a lower-case text column that hold a suspicious flag."""
    @F.arrow_udf("double")
    def share(texts: pa.Array) -> pa.Array:
        return pa.array(flagged_shares(texts))

    return share(F.col(c_lower))


def any_of(needles: list[str]) -> str:
    """A pattern for texts that hold one of some strings."""
    return "|".join(map(re.escape, needles))


def matched(c: str, pattern: str) -> Column:
    """1 where a text matches, else 0, by an automaton that reads every byte once and never goes back.

    For patterns that mean the same in all engines: bytes, classes of ASCII characters, no case folding.
    """
    @F.arrow_udf("int")
    def match(texts: pa.Array) -> pa.Array:
        return pc.match_substring_regex(texts, pattern).fill_null(False).cast(pa.int32())

    return match(F.col(c))


def ip_address(c: str, pattern: str) -> Column:
    """1 where a text matches a pattern of four short parts with dots between, else 0.

    Only texts with three dots so near to each other are searched from every place.
    """
    near = matched(c, r"\.[^.]{1,3}\.[^.]{1,3}\.")
    return F.when((near == 1) & F.rlike(F.col(c), F.lit(pattern)), 1).otherwise(0)
