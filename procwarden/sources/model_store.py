"""Baselines, encoders and models as parquet tables, in versions.

A version is written to a folder of its own and then published by creating one empty
file, whose name holds a running number and the version.  A reader takes the version
of the highest number: it sees the old artefact or the new one, never parts of both,
and it needs no rename, which object stores do not do in one step.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from procwarden.operators.baseline import Baseline, baseline_stats
from procwarden.operators.boundary import Boundary
from procwarden.operators.encoders import Encoder
from procwarden.operators.ensemble import Model, fit_model, options_text
from procwarden.operators.forest import Forest
from procwarden.operators.neighbours import OutlierModel
from procwarden.operators.scaling import FeatureStats, fit_stats, same_stats, stats_table
from procwarden.plans.detection import Artefacts, detect_facts, event_facts, fit_facts
from procwarden.session import cut_lineage, file_system


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def versions(spark: SparkSession, root: str) -> list[str]:
    """Names of the published versions, oldest first: ``number-version``."""
    fs, where = file_system(spark, f"{root}/published")
    if not fs.exists(where):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(where))


def _folder(root: str, name: str) -> str:
    return f"{root}/versions/{name.split('-', 1)[1]}"


def current(spark: SparkSession, root: str) -> str | None:
    """The folder of the version that readers take now."""
    names = versions(spark, root)
    return _folder(root, names[-1]) if names else None


def _found(spark: SparkSession, root: str) -> str:
    folder = current(spark, root)
    if folder is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    return folder


def publish(spark: SparkSession, root: str, write: Callable[[str], None]) -> str:
    """Write a new version with ``write(folder)`` and make it the current one."""
    version = uuid.uuid4().hex
    write(f"{root}/versions/{version}")
    names = versions(spark, root)
    number = int(names[-1].split("-")[0]) + 1 if names else 0
    fs, pointer = file_system(spark, f"{root}/published/{number:012d}-{version}")
    fs.createNewFile(pointer)
    return f"{root}/versions/{version}"


def remove_old(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete all but the newest versions, the pointer before its tables; readers of those need their time."""
    for name in versions(spark, root)[:-keep]:
        for path in (f"{root}/published/{name}", _folder(root, name)):
            fs, where = file_system(spark, path)
            fs.delete(where, True)


def save_baseline(spark: SparkSession, b: Baseline, path: str,
                  encoders: dict[str, Encoder] | None = None) -> None:
    publish(spark, path, lambda folder: _write_baseline(spark, b, folder, encoders))


def _write_baseline(spark: SparkSession, b: Baseline, path: str, encoders: dict[str, Encoder] | None) -> None:
    _write(baseline_stats(spark, b), f"{path}/stats")
    if b.pairs is not None:
        _write(b.pairs, f"{path}/pairs")
    for name, e in (encoders or {}).items():
        _write(e.codes, f"{path}/encoder_{name}")


def load_baseline(spark: SparkSession, path: str) -> Baseline:
    return _read_baseline(spark, _found(spark, path))


def _read_baseline(spark: SparkSession, path: str) -> Baseline:
    row = spark.read.parquet(f"{path}/stats").first()
    pairs = spark.read.parquet(f"{path}/pairs") if row["n_pairs"] else None
    return Baseline(pairs=pairs, **row.asDict())


def load_encoder(spark: SparkSession, path: str, name: str) -> Encoder:
    return _read_encoder(spark, _found(spark, path), name)


def _read_encoder(spark: SparkSession, path: str, name: str) -> Encoder:
    codes = spark.read.parquet(f"{path}/encoder_{name}")
    return Encoder(codes, codes.count())


def save_model(spark: SparkSession, m: Model, path: str) -> None:
    publish(spark, path, lambda folder: _write_model(spark, m, folder))


def _write_model(spark: SparkSession, m: Model, path: str) -> None:
    _write(stats_table(spark, m.stats), f"{path}/features")
    ranges = [F.struct(F.lit(p).alias("part"), F.lit(float(lo)).alias("low"),
                       F.lit(float(hi)).alias("high")) for p, (lo, hi) in m.ranges.items()]
    _write(spark.range(0, 1, 1, 1).select(F.inline(F.array(*ranges))), f"{path}/ranges")
    if m.forest is not None:
        _write(m.forest.nodes, f"{path}/forest")
    if m.lof is not None:
        _write(m.lof.refs, f"{path}/density")
    if m.boundary is not None:
        b = m.boundary
        _write(spark.createDataFrame(
            [(i, b.directions[:, i].tolist(), float(b.phases[i]), float(b.weights[i]))
             for i in range(len(b.phases))],
            "position int, direction array<double>, phase double, weight double"),
            f"{path}/boundary")
    _write(spark.range(0, 1, 1, 1).select(
        F.lit(m.fingerprint).alias("fingerprint"), F.lit(m.stats.rows).cast("long").alias("rows"),
        F.lit(",".join(m.parts)).alias("parts"),
        F.lit(m.forest.trees if m.forest else 0).alias("trees"),
        F.lit(m.forest.sample if m.forest else 0).cast("long").alias("sample"),
        F.lit(m.lof.k if m.lof else 0).alias("k"),
        F.lit(m.digits).cast("int").alias("digits"), F.lit(m.options).alias("options")), f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> Model:
    return _read_model(spark, _found(spark, path))


def _read_model(spark: SparkSession, path: str) -> Model:
    meta = spark.read.parquet(f"{path}/meta").first()
    rows = spark.read.parquet(f"{path}/features").orderBy("position").collect()  # one per feature
    stats = FeatureStats([r["feature"] for r in rows], [r["mean"] for r in rows],
                         [r["raw_std"] for r in rows], [r["min"] for r in rows],
                         [r["max"] for r in rows], meta["rows"])
    model = Model(stats, {r["part"]: (r["low"], r["high"])
                          for r in spark.read.parquet(f"{path}/ranges").collect()},
                  fingerprint=meta["fingerprint"], digits=meta["digits"], options=meta["options"])
    parts = meta["parts"].split(",")
    if "forest" in parts:
        model.forest = Forest(spark.read.parquet(f"{path}/forest"), meta["trees"], meta["sample"])
    if "lof" in parts:
        refs = spark.read.parquet(f"{path}/density")
        model.lof = OutlierModel(refs, refs.count(), meta["k"], len(stats.columns))
    if "boundary" in parts:
        table = spark.read.parquet(f"{path}/boundary").orderBy("position").collect()  # one per direction
        model.boundary = Boundary(np.array([r["direction"] for r in table]).T,
                                  np.array([r["phase"] for r in table]),
                                  np.array([r["weight"] for r in table]))
    return model


def load_or_fit(benign: DataFrame, path: str, **options) -> Model:
    """The stored model when there is one, else a new one, which is stored.

    A model that was fitted on another baseline or with other options is refused;
    options that are not given have the defaults of ``fit_model``.
    """
    spark = benign.sparkSession
    if current(spark, path) is None:
        model = fit_model(benign, **options)
        save_model(spark, model, path)
        return model
    model = load_model(spark, path)
    if not same_stats(model.stats, fit_stats(benign)):
        raise ValueError(f"the model in {path} was fitted on another baseline")
    if model.options != (asked := options_text(**options)):
        raise ValueError(f"the model in {path} was fitted with {model.options}, not {asked}")
    return model


def save_artefacts(spark: SparkSession, artefacts: Artefacts, path: str) -> None:
    """Baseline, model and encoders as one version."""
    def write(folder: str) -> None:
        encoders = artefacts.encoders or {}
        _write_baseline(spark, artefacts.baseline, f"{folder}/baseline", encoders)
        _write_model(spark, artefacts.model, f"{folder}/model")
        _write(spark.createDataFrame([(n,) for n in encoders], "name string"), f"{folder}/encoders")

    publish(spark, path, write)


def load_artefacts(spark: SparkSession, path: str) -> Artefacts:
    """The current version; all its parts belong together."""
    folder = _found(spark, path)
    names = [r["name"] for r in spark.read.parquet(f"{folder}/encoders").collect()]  # one row per encoder
    encoders = {n: _read_encoder(spark, f"{folder}/baseline", n) for n in names}
    return Artefacts(_read_baseline(spark, f"{folder}/baseline"), _read_model(spark, f"{folder}/model"), encoders or None)


def run_with_store(events: DataFrame, path: str, keep: list[str] | None = None, codes: bool = True, **options) -> DataFrame:
    """Detect with the stored artefacts if there are any; else fit on the benign rows and store.

    Artefacts that were fitted with other options than the given ones are refused.
    Values that stored encoders do not know get null codes.
    """
    spark = events.sparkSession
    kept = events.columns if keep is None else list(dict.fromkeys([*keep, "label"]))
    facts = cut_lineage(event_facts(events, keep=kept))
    if current(spark, path) is None:
        save_artefacts(spark, fit_facts(facts, codes=codes, **options), path)
    artefacts = load_artefacts(spark, path)
    if artefacts.model.options != (asked := options_text(**options)):
        raise ValueError(f"the artefacts in {path} were fitted with {artefacts.model.options}, not {asked}")
    return detect_facts(facts, artefacts)
