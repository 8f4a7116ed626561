"""Personal data: fixed patterns, and further secrets found by weak supervision.

The base kinds (email, ip, card, phone) are what their patterns and digit rules
say.  Beyond them, candidates for secrets and identifiers (passwords, tokens, access
keys, account and national numbers, hardware addresses) are runs of letters and digits
that hold a digit, whatever stands behind the name of a secret, and numbers in groups.
Labelers vote on every candidate: forms and check digits, a list of names, the words in
front, and the shape.  Expectation maximisation over the counts of vote patterns
estimates how reliable each labeler is; its posteriors train a logistic span
classifier, which sees the forms as well and decides.

All work on rows is DataFrame functions.  What reaches the driver are counts by
vote and feature pattern, whose number is bounded by the labelers and features.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procwarden.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
# The first of each pair tells cheaply that a text cannot match.  Repeats are
# possessive, and an address begins where a run of its characters begins or the
# last match ended: the same matches, in linear time however long a run is.
PATTERNS = {
    "email": ("@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": (r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"),
    "card": ("[0-9]", r"[0-9](?:[\x20-]?[0-9])++"),
    "phone": (r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
# Behind a name, a run up to white space or a quote, without the marks that end a
# sentence; then addresses and account numbers in groups; then runs that hold a digit.
_INNER, _MARKS = r"[^\x00-\x20\"'<>,;.!?)\]:]++", r"[.!?)\]:]++"
CANDIDATE = (
    "[0-9]|(?i:passw|pwd|passphrase|secret|token)",
    r"(?<=(?i:password|passwd|pwd|passphrase|secret|token)(?:\x20is|\x20?[=:])\x20?[\"']?)(?<![=:]{2})"
    rf"(?![=:]){_INNER}(?:{_MARKS}{_INNER})*+"
    r"|(?<![0-9A-Za-z:-])[0-9A-Fa-f]{2}(?:[:-][0-9A-Fa-f]{2}){5}(?![0-9A-Za-z:-])"
    r"|(?<![A-Za-z0-9_+/-])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[0-9]{1,3})?(?![A-Za-z0-9_+/-])"
    r"|(?<![A-Za-z0-9_+/-])[A-Za-z_+/-]*+[0-9][A-Za-z0-9_+/-]*+")
#: Forms that tell by themselves: access keys, prefixed tokens, hardware addresses, national
#: numbers in groups of three, two and four digits; and numbers of accounts, by their check digits.
FORMS = (r"^(AKIA|ASIA)[A-Z0-9]{16}$|^(ghp_|gho_|sk-|xox[abp]-)(?=.*[0-9])[A-Za-z0-9-]{10,}$"
         r"|^[0-9A-Fa-f]{2}([:-][0-9A-Fa-f]{2}){5}$|^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")
ACCOUNT = r"^[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]{4}){2,7}(\x20?[0-9]{1,3})?$"
CANDIDATE_CHARS = 8  # shorter runs are no candidates
CONTEXT = 32  # characters in front of a candidate that labelers see
NAMES = ("password", "passwd", "pwd", "passphrase", "secret", "token", "api key", "api_key", "apikey", "access key",
         "access_key", "private key", "credential", "login", "bearer", "authorization")
HARMLESS = ("version", "license", "chapter", "page", "section", "figure", "table", "isbn", "doi", "year", "article")
EM_ROUNDS, FIT_ROUNDS = 50, 40
SHRINK = 0.002  # weight of the penalty, as a share of the rows


def _running_sums(values: Column) -> Column:
    """Inclusive running sums of an array, in passes that double their stride."""
    steps = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.log2(F.size(values) + 1)).cast("int"))),
                        lambda i: F.pow(F.lit(2), i).cast("int"))

    def add(sums: Column, step: Column) -> Column:
        n = F.size(sums)
        moved = F.concat(F.array_repeat(F.lit(0), F.least(step, n)),
                         F.slice(sums, F.lit(1), F.greatest(F.lit(0), n - step)))
        return F.zip_with(sums, moved, lambda a, b: a + b)

    return F.aggregate(steps, values, add)


def _located(matches: Column, between: Column) -> Column:
    """Matches with start, end (code points) and the text between them and the match before."""
    before = F.slice(between, 1, F.size(matches))
    ends = _running_sums(F.zip_with(before, matches, lambda b, m: F.length(b) + F.length(m)))
    return F.transform(F.arrays_zip(ends.alias("e"), matches.alias("m"), before.alias("b")), lambda x: F.struct(
        (x["e"] - F.length(x["m"])).alias("start"), x["e"].alias("end"), x["m"].alias("found"),
        F.substring(x["b"], -CONTEXT, CONTEXT).alias("before")))


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda x: F.lit(True),
    "ip": lambda x: F.forall(F.split(x, r"\."), lambda p: F.coalesce(p.try_cast("bigint") <= 255, F.lit(False))),
    "card": lambda x: F.when(F.length(_digits(x)).between(13, 19), _luhn(_digits(x))).otherwise(False),
    "phone": lambda x: F.length(_digits(x)).between(9, 15),
}


def _account(found: Column) -> Column:
    """A number of the form of an international account whose check digits hold (1 modulo 97)."""
    plain = F.replace(found, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 34), F.substring(plain, 1, 4))

    def add(rest: Column, sign: Column) -> Column:
        code = F.ascii(sign)
        return F.when(code < 65, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.when(found.rlike(ACCOUNT), F.aggregate(F.split(turned, ""), F.lit(0), add) == 1).otherwise(False)


def _certain(found: Column) -> Column:
    return found.rlike(FORMS) | _account(found)


def _candidate(found: Column) -> Column:
    """Long enough, no plain word, no date, and no group of signs that only looks like an account's number."""
    return (F.length(found) >= CANDIDATE_CHARS) & ~found.rlike(
        "^[A-Z]?[a-z]+$|^[0-9]{4}-[0-9]{2}-[0-9]{2}([T_].*)?$") & (
        ~found.contains(" ") | _account(found))


def _named(before: Column, names: tuple[str, ...]) -> Column:
    """One of the names stands right in front, ``is`` or signs at most between."""
    return before.rlike("(" + "|".join(names) + r")([^a-z]{0,6}|\x20is:?\x20[\"']?)$")


def _holds(valid: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda x: valid(x["found"])


def _line(kind: str) -> Callable[[Column], Column]:
    return lambda x: F.concat_ws(":", F.lit(kind), x["start"], x["end"])


def _votes(x: Column) -> Column:
    """One vote per labeler: 1 private, -1 not, 0 no opinion."""
    found, before = x["found"], F.lower(x["before"])
    runs = F.regexp_count(found, F.lit("[0-9]+"))

    def vote(yes: Column, no: Column) -> Column:
        return F.when(yes, 1).when(no, -1).otherwise(0)

    return F.array(
        vote(_certain(found) | found.rlike("^[0-9a-f]{16,}$") & ~found.rlike("^[0-9]+$"), found.rlike("^[0-9+/_-]+$")),
        vote(_named(before, NAMES), _named(before, HARMLESS)),
        vote(before.rlike(r"[=:]\s{0,2}[\"']?$"), before.rlike(r"^$|[.!?,]\s*$")),
        vote(runs >= 3, runs <= 1),
        vote(F.length(found) >= 16, F.length(found) < 12))


LABELERS = 5


def _features(x: Column) -> Column:
    """What the final classifier sees of a candidate: nine numbers, 0 or 1; the last one is whether its form is certain."""
    found, before = x["found"], F.lower(x["before"])
    flags = [F.length(found) >= 12, F.length(found) >= 16, F.length(found) >= 24, found.rlike("[a-z]"),
             found.rlike("[A-Z]"), F.regexp_count(found, F.lit("[0-9]+")) >= 3, before.rlike(r"[=:]\s{0,2}[\"']?$"),
             _named(before, NAMES), _certain(found)]
    return F.array(*[f.cast("int") for f in flags])


def reliabilities(counts: list[tuple[tuple[int, ...], int]], certain: dict[tuple[int, ...], int] | None = None,
                  ) -> tuple[float, list[dict[bool, dict[int, float]]]]:
    """Share of private candidates and P(vote | truth) of each labeler, by expectation maximisation.

    ``certain`` counts, by votes, the candidates among them that are known to be private.
    """
    share, total = 0.5, sum(n for _, n in counts)
    # at first a vote is more often right than wrong
    tables = [{True: {1: 0.6, 0: 0.3, -1: 0.1}, False: {1: 0.1, 0: 0.3, -1: 0.6}} for _ in range(LABELERS)]
    for _ in range(EM_ROUNDS if total else 0):
        sums = [{t: dict.fromkeys((1, 0, -1), 0.1) for t in (True, False)} for _ in range(LABELERS)]
        private = 0.0
        for votes, n in counts:
            known = (certain or {}).get(votes, 0)
            yes = known + (n - known) * posterior(votes, share, tables)
            private += yes
            for k, v in enumerate(votes):
                sums[k][True][v] += yes
                sums[k][False][v] += n - yes
        share = min(max(private / total, 1e-6), 1 - 1e-6)
        tables = [{t: {v: s / sum(by[t].values()) for v, s in by[t].items()} for t in by} for by in sums]
    return share, tables


def posterior(votes: tuple[int, ...], share: float, tables: list[dict[bool, dict[int, float]]]) -> float:
    """Probability that a candidate with these votes is private."""
    odds = math.log(share / (1 - share)) + sum(
        math.log(t[True][v] / t[False][v]) for t, v in zip(tables, votes, strict=True))
    return 1 / (1 + math.exp(-max(-60.0, min(60.0, odds))))


def span_classifier(rows: list[tuple[tuple[int, ...], float, float]]) -> list[float]:
    """Logistic weights (bias last) for (features, rows, private rows), by Newton's steps.

    Weights are shrunk in proportion to the rows; that of a certain form (the last feature) is
    not, as such candidates are known to be private however few they are.
    """
    size = len(rows[0][0]) + 1 if rows else 1
    weights = np.zeros(size)
    x = np.array([(*features, 1) for features, _, _ in rows], float).reshape(-1, size)
    n, private = (np.array([r[i] for r in rows], float) for i in (1, 2))
    shrink = np.full(size, SHRINK * n.sum())
    shrink[-2:-1] = 0.01
    for _ in range(FIT_ROUNDS if n.sum() else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -60, 60)))
        slope = x.T @ (n * p - private) + shrink * weights
        bend = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag(shrink)
        step = np.linalg.solve(bend, slope)
        weights = weights - step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
    return [float(w) for w in weights]


def locate(docs: DataFrame) -> DataFrame:
    """(doc_id, email, ip, card, phone, candidates): spans as arrays, in one pass over whole texts."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    text, none = F.col("_text"), F.array().cast("array<string>")
    patterns = PATTERNS | {"candidates": CANDIDATE}
    rows = rows.withColumns({f"_m_{k}": F.when(text.rlike(hint), F.regexp_extract_all(text, F.lit(p), F.lit(0)))
                             .otherwise(none) for k, (hint, p) in patterns.items()})
    rows = rows.withColumns({f"_s_{k}": F.when(F.size(f"_m_{k}") > 0, F.split(text, p, -1)).otherwise(none)
                             for k, (_, p) in patterns.items()})
    rows = rows.select("doc_id", *[_located(F.col(f"_m_{k}"), F.col(f"_s_{k}")).alias(k) for k in patterns])
    rows = rows.withColumns({k: F.filter(F.col(k), _holds(VALID[k])) for k in KINDS})
    rows = rows.withColumn("candidates", F.filter("candidates", lambda x: _candidate(x["found"])))
    apart = [F.transform(k, lambda x: F.struct(x["start"], x["end"])) for k in KINDS]
    return rows.select("doc_id", *[a.alias(k) for a, k in zip(apart, KINDS, strict=True)], F.transform(
        "candidates", lambda x: F.struct(x["start"], x["end"], _votes(x).alias("votes"), _features(x).alias("features")))
        .alias("candidates"))


def fit(located: DataFrame) -> list[float]:
    """The span classifier, from all candidates of all documents."""
    found = located.select(F.explode("candidates").alias("c")).groupBy("c.votes", "c.features").count().collect()
    by_votes: dict[tuple[int, ...], int] = {}
    certain: dict[tuple[int, ...], int] = {}
    for r in found:  # at most 3**labelers times 2**features
        votes = tuple(r["votes"])
        by_votes[votes] = by_votes.get(votes, 0) + r["count"]
        certain[votes] = certain.get(votes, 0) + r["count"] * r["features"][-1]
    share, tables = reliabilities(sorted(by_votes.items()), certain)
    soft: dict[tuple[int, ...], list[float]] = {}
    for r in found:
        n = soft.setdefault(tuple(r["features"]), [0.0, 0.0])
        n[0] += r["count"]
        n[1] += r["count"] * (1.0 if r["features"][-1] else posterior(tuple(r["votes"]), share, tables))
    return span_classifier([(k, n, p) for k, (n, p) in sorted(soft.items())])


def find_personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, n_secret, n_spans, base_sha256, spans), one row per row.

    Counts and ``base_sha256`` are of the base kinds; ``spans`` lists these and the
    secrets that the classifier found outside them, as ``kind:start:end``, ``n_spans`` counts them.  Null texts
    count as empty and have no spans; equal texts have equal results; other columns are
    ignored; without any candidate nothing is learned and only base spans are found.
    """
    located = cut_lineage(locate(docs))
    weights = fit(located)

    def private(x: Column) -> Column:
        terms = [F.get(x["features"], F.lit(i)) * F.lit(w) for i, w in enumerate(weights[:-1])]
        return sum(terms, F.lit(weights[-1])) > 0 if terms else F.lit(False)

    def clear(x: Column) -> Column:
        """Outside all base spans of the document."""
        return ~F.exists(F.concat(*KINDS), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))

    secret = F.filter("candidates", lambda x: private(x) & clear(x))
    found = located.withColumn("secret", secret)
    lines = {k: F.transform(k, _line(k))
             for k in (*KINDS, "secret")}
    base = F.concat(*[lines[k] for k in KINDS])
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in (*KINDS, "secret")],
        sum((F.size(k) for k in KINDS), F.size("secret")).cast("long").alias("n_spans"),
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, lines["secret"]), ",").alias("spans"))
