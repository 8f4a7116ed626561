"""From documents to token ids: five stages, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet to the shared folder and reads it again as the next stage's ``docs``.
All but the last return the columns of ``documents``.

The tables that a stage writes on its way live until its output is written: they go when
the next stage begins, or when ``run`` has written the output.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procwarden.llm import jaccard_join, language, line_templates, mixing, sentencepiece_scan
from procwarden.llm.common import table
from procwarden.session import StepTables, apply_settings, cut_lineage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document whose language is less sure than this is rejected.
MIN_SCORE = 0.35

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_steps = StepTables()  # of the last stage


def _stage(fn: Stage) -> Stage:
    """A stage under the library's settings, in whatever session.

    It first drops the tables of the stages before, but for those that its input still reads.
    """
    @wraps(fn)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        apply_settings(spark)
        _steps.remove(spark, but=docs)
        with _steps:
            return fn(spark, docs, sf_dir)

    return call


@_stage
def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with some confidence; a null language is filled in.

    Texts that are null or have no letter are rejected.  Without a labelled document
    nothing can be learned, and only these go.
    """
    found = language.add_language(docs.select(*COLUMNS), language.fit(docs))
    sure = F.col("lang_pred") != language.UNKNOWN
    kept = found.where(F.col("has_letters") & (~sure | (F.col("score") >= MIN_SCORE)))
    return kept.withColumn("lang", F.coalesce("lang", F.when(sure, F.col("lang_pred")))).select(*COLUMNS)


@_stage
def drop_line_templates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without recurring lines; documents that consisted of such lines only go."""
    found = line_templates.drop_recurring_lines(docs.select(*COLUMNS))
    kept = found.where((F.col("n_dropped") == 0) | (F.trim(F.translate("text", "\n\t\r", "   ")) != ""))
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") == 0, F.col("n_chars")).otherwise(
        F.length("text").cast("long"))).select(*COLUMNS)


@_stage
def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by like shingle sets the one of the smallest id; of repeated rows one."""
    joined = jaccard_join.join_documents(docs)
    others = joined.where("doc_id != component_id").select("doc_id")
    kept = docs.select(*COLUMNS).join(jaccard_join.few_ids(others), "doc_id", "left_anti")
    repeated = jaccard_join.few_ids(docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
                                    .select("doc_id"))
    if not repeated.isEmpty():
        kept = kept.join(repeated, "doc_id", "left_anti").unionByName(
            kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]))
    return kept.select(*COLUMNS)


@_stage
def mix_to_curriculum(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, once for each copy, in the order of their training positions.

    The document at which a source's target is reached stays if half of it is taken.
    Documents without words are in no mix.
    """
    rows = cut_lineage(docs.select(*COLUMNS).withColumn("_row", F.monotonically_increasing_id()))
    sized = rows.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"),
                        F.xxhash64("text").alias("_text"), "_row")
    copies = [F.when((F.col(f"{c}_taken") * 2 >= F.col("size")) & (F.col("size") > 0), F.col(f"{c}_position"))
              for c in ("first", "second")]
    taken = cut_lineage(mixing.mix_sources(sized, keep=["_text", "_row"]).select("_row", F.array_compact(F.array(*copies)).alias("at"))
                        .where(F.size("at") > 0))
    few = F.broadcast(taken) if taken.count() <= jaccard_join.BROADCAST_IDS else taken
    placed = rows.join(few, "_row").select(*COLUMNS, F.explode("at").alias("_at"))
    return placed.orderBy("_at", "doc_id").select(*COLUMNS)


@_stage
def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of every text."""
    return sentencepiece_scan.tokenize(docs, sentencepiece_scan.load())


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_line_templates),
    ("jaccard_join", keep_one_of_each_group),
    ("curriculum_mix", mix_to_curriculum),
    ("sentencepiece", encode_pieces),
]
#: SQL cannot express trained models and segmentations; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one, of all tables the one that is left."""
    docs, before = table(spark, sf_dir, "documents"), StepTables()
    for _, stage in STAGES:
        now = StepTables()
        with now:
            docs = cut_lineage(stage(spark, docs, sf_dir))
        for done in (before, _steps):
            done.remove(spark)
        before = now
    return docs
