"""Line dedup by log templates, with DataFrame functions only.

Lines go down a tree of fixed depth: number of tokens, then the leading tokens,
tokens with digits counting as a variable.  In a leaf that several documents
reach, a token is constant if it recurs at its place and a variable if not; a line
with enough constants has the template of its constants.  Lines whose template
recurs across documents are dropped, but for the first document that holds it;
the words of a variable place in the others are lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from procwarden.llm.common import small_or_shuffled
from procwarden.session import cut_lineage

NUMBERED = "[^ ]*[0-9][^ ]*"  # a token with a digit
VARIABLE = "<*>"
DEPTH = 3  # leading tokens that lead to a leaf
MIN_TOKENS = 3  # shorter lines are never dropped
MIN_DOCS = 3  # documents that make a template recur, and rows that make a token constant
CONSTANT = 0.7  # share of a template's tokens that must be constant


def _lines(docs: DataFrame) -> DataFrame:
    """(row, doc_id, pos, line, leaf) of the lines that are long enough, one space between tokens.

    The way down the tree needs the number of spaces and the leading tokens only.
    """
    line = F.col("line")
    spaced = F.when(line.rlike(r"[\x09-\x0D]|  |^ | $"), F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))).otherwise(line)
    lines = (docs.select("row", "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
             .select("row", "doc_id", "pos", spaced.alias("line")))
    n_tokens = F.length("line") - F.length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    lead = F.regexp_replace(F.substring_index("line", " ", DEPTH), NUMBERED, VARIABLE)
    return lines.where(n_tokens >= MIN_TOKENS).withColumn("leaf", F.xxhash64(n_tokens, lead))


def _recurring(named: DataFrame, name: str) -> DataFrame:
    """(name, first) of the values that MIN_DOCS documents hold; ``first`` is the first of these."""
    held = named.select(name, "doc_id", "row").distinct()
    return held.groupBy(name).agg(F.count("*").alias("_n"), F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")).where(
        F.col("_n") >= MIN_DOCS).select(name, F.col("first.row").alias("first"))


def recurring_lines(docs: DataFrame) -> DataFrame:
    """(row, dropped): places (from 0) of the lines to drop, of (row, doc_id, text) rows."""
    lines = cut_lineage(_lines(docs))  # written once, read by column
    leaves = cut_lineage(_recurring(lines, "leaf").select("leaf"))
    tokens = F.split(F.regexp_replace("line", NUMBERED, VARIABLE), " ")
    lines = lines.join(small_or_shuffled(leaves), "leaf").select("row", "doc_id", "pos", "leaf", tokens.alias("tokens"))
    lines = cut_lineage(lines.withColumn("line", F.xxhash64("leaf", "tokens")))
    # equal lines are generalised once
    kinds = cut_lineage(lines.groupBy("leaf", "line").agg(F.first("tokens").alias("tokens"), F.count("*").alias("n")))
    placed = kinds.select("leaf", "line", "n", F.posexplode("tokens").alias("at", "token"))
    constant = placed.where(F.col("token") != VARIABLE).groupBy("leaf", "at", "token").agg(F.sum("n").alias("rows")).where(
        F.col("rows") >= MIN_DOCS).select("leaf", "at", "token")
    marked = placed.join(constant.withColumn("fixed", F.lit(True)), ["leaf", "at", "token"], "left").groupBy(
        "leaf", "line").agg(F.sort_array(F.collect_list(F.struct("at", F.when(F.col("fixed"), F.col("token"))
                                                                 .otherwise(F.lit(VARIABLE)).alias("token")))).alias("t"),
                            F.count("fixed").alias("fixed"), F.count("*").alias("size"))
    templates = cut_lineage(marked.where((F.col("fixed") >= F.col("size") * CONSTANT) & (F.col("fixed") > 0)).select(
        "leaf", "line", F.xxhash64("leaf", "t.token").alias("template")))
    named = cut_lineage(lines.select("row", "doc_id", "pos", "leaf", "line").join(templates, ["leaf", "line"]).select(
        "row", "doc_id", "pos", "template"))
    recurring = small_or_shuffled(cut_lineage(_recurring(named, "template")))
    found = named.join(recurring, "template").where(F.col("row") != F.col("first"))
    return found.groupBy("row").agg(F.collect_set("pos").alias("dropped"))


def _flags(places: Column) -> Column:
    """Booleans by place, up to the last of ``places``: true where it is one; linear in their number."""
    ordered = F.sort_array(places)
    before = F.concat(F.array(F.lit(-1)), F.slice(ordered, F.lit(1), F.size(ordered) - 1))
    gaps = F.zip_with(ordered, before, lambda place, last: place - last - 1)
    return F.flatten(F.transform(gaps, lambda n: F.concat(F.array_repeat(F.lit(False), n), F.array(F.lit(True)))))


def drop_recurring_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with recurring lines taken out of ``text``, and ``n_lines``, ``n_dropped`` added.

    A document is a row; rows with equal id and text count as one and keep or lose the same
    lines.  The first document of a template is that of the smallest id, null ids last.
    Lines are what newlines part; null and empty texts stay as they are (null: 0 lines).
    Columns ``n_lines`` and ``n_dropped`` are replaced, all others are kept.  An empty table
    gives no rows.
    """
    row = F.xxhash64("doc_id", "text")
    found = recurring_lines(docs.where(F.col("text").isNotNull()).select(row.alias("row"), "doc_id", "text"))
    own_row, own_places = _free("_row", docs), _free("_dropped", docs)
    found = found.withColumnsRenamed({"row": own_row, "dropped": own_places})
    lines, places = F.split("text", "\n"), F.col(own_places)
    # places beyond the last flag have none and stay; joining leaves nulls out
    kept = F.zip_with(lines, _flags(places), lambda line, gone: F.when(~F.coalesce(gone, F.lit(False)), line))
    out = docs.withColumn(own_row, row).join(found, own_row, "left")
    return out.withColumns({
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long"),
        "n_dropped": F.when(places.isNull(), 0).otherwise(F.size(places)).cast("long"),
        "text": F.when(places.isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")),
    }).drop(own_row, own_places)


def _free(name: str, docs: DataFrame) -> str:
    """``name``, with underscores before it until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name = "_" + name
    return name


ORACLE = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
lines AS (
  SELECT doc_id, text, unnest(generate_series(0, len(l) - 1)) AS pos, unnest(l) AS line
  FROM (SELECT DISTINCT doc_id, text, string_split(text, chr(10)) AS l FROM docs WHERE text IS NOT NULL)
), tokens AS (
  SELECT doc_id, text, pos, regexp_extract_all(
    regexp_replace(line, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), '[^\x20\x09-\x0D]+') AS t FROM lines
), leafed AS (
  SELECT *, {'n': len(t), 'lead': t[1:3]} AS leaf FROM tokens WHERE len(t) >= 3
), leaves AS (
  SELECT leaf FROM (SELECT DISTINCT leaf, doc_id, text FROM leafed) GROUP BY leaf HAVING count(*) >= 3
), cand AS (SELECT l.* FROM leafed l JOIN leaves USING (leaf)
), kinds AS (SELECT leaf, t, count(*) AS n FROM cand GROUP BY leaf, t
), placed AS (SELECT leaf, t, n, unnest(generate_series(1, len(t))) AS spot, unnest(t) AS token FROM kinds
), fixed AS (
  SELECT leaf, spot, token FROM placed WHERE token <> '<*>' GROUP BY leaf, spot, token HAVING sum(n) >= 3
), marked AS (
  SELECT p.leaf, p.t, list(CASE WHEN f.spot IS NULL THEN '<*>' ELSE p.token END ORDER BY p.spot) AS template,
         count(f.spot) AS fixed FROM placed p LEFT JOIN fixed f USING (leaf, spot, token) GROUP BY p.leaf, p.t
), named AS (
  SELECT c.doc_id, c.text, c.pos, {'leaf': c.leaf, 'template': m.template} AS name
  FROM cand c JOIN marked m USING (leaf, t) WHERE m.fixed >= 0.7::DOUBLE * len(m.t) AND m.fixed > 0
), held AS (
  SELECT *, row_number() OVER (PARTITION BY name ORDER BY doc_id NULLS LAST) AS k, count(*) OVER (PARTITION BY name) AS n
  FROM (SELECT DISTINCT name, doc_id, text FROM named)
), gone AS (
  SELECT n.doc_id, n.text, list(n.pos) AS places FROM named n JOIN held h
  ON n.name = h.name AND n.doc_id IS NOT DISTINCT FROM h.doc_id AND n.text = h.text
  WHERE h.n >= 3 AND h.k > 1 GROUP BY n.doc_id, n.text
)
SELECT d.doc_id, CASE WHEN g.places IS NULL THEN d.text ELSE array_to_string(
         [string_split(d.text, chr(10))[i + 1] FOR i IN generate_series(0, len(string_split(d.text, chr(10))) - 1)
          IF NOT list_contains(g.places, i)], chr(10)) END AS text,
       coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(len(g.places), 0)::BIGINT AS n_dropped
FROM docs d LEFT JOIN gone g ON d.doc_id IS NOT DISTINCT FROM g.doc_id AND d.text = g.text
"""
