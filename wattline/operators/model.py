"""Forecasts of boosted trees and their versioned runs."""

from __future__ import annotations

import hashlib
import json
import re
import time
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.config import ForecastConfig
from wattline.operators import boosting
from wattline.operators.boosting import BoostedTrees
from wattline.operators.evaluation import scored
from wattline.sources.tables import create, exists, folders, rename


def predict(model: BoostedTrees, df: DataFrame, target: str | None = None, lo: float = 0, hi: float = 100) -> DataFrame:
    """Predictions clipped to the level's range; with `target`, also the error."""
    out = boosting.predict(model, df)
    if target is None:
        return out.withColumn("pred", F.least(F.greatest("pred", F.lit(float(lo))), F.lit(float(hi))))
    return scored(out, target, "pred", lo, hi)


# ---- versioned runs

RUN_NAME = re.compile(r"^v(\d+)__(.+)__([0-9a-f]{8})$")


def run_versions(spark: SparkSession, root: str, task: str) -> list[tuple[int, str]]:
    found = [(RUN_NAME.match(name), name) for name in folders(spark, f"{root}/{task}")]
    return sorted((int(m.group(1)), name) for m, name in found if m)


def next_run_id(spark: SparkSession, root: str, task: str, last_day: str) -> str:
    """An id with a number of its own: trainers that start together claim it by making a file, which only one can."""
    versions = run_versions(spark, root, task)
    number = versions[-1][0] + 1 if versions else 1
    while not create(spark, f"{root}/{task}/_claimed/{number}"):
        number += 1
    digest = hashlib.sha256(f"{task}|{last_day}|{time.time_ns()}".encode()).hexdigest()[:8]
    return f"v{number}__{last_day}__{digest}"


@dataclass
class Run:
    run_id: str
    path: str
    model: BoostedTrees
    features: list[str]
    target: str


def save_run(
    spark: SparkSession,
    root: str,
    run_id: str,
    model: BoostedTrees,
    config: ForecastConfig,
    fingerprint: dict,
    file_hashes: DataFrame,
    reports: dict[str, DataFrame],
    baseline: DataFrame,
) -> str:
    """Write a run beside its place and move it there when it is complete."""
    final = f"{root}/{config.task}/{run_id}"
    if exists(spark, final):
        raise FileExistsError(final)
    draft = f"{root}/{config.task}/_draft_{run_id}"
    model.save(spark, f"{draft}/model")
    _write_object(
        spark,
        {"task": config.task, "target": config.target, "features": list(config.features), "n_features": len(config.features)},
        f"{draft}/feature_set",
    )
    stamp = {"task": config.task, "run_id": run_id, "trained_at": datetime.now(timezone.utc).isoformat()}
    stamp["rounds"] = len(model.trees)
    _write_object(spark, {**stamp, **fingerprint}, f"{draft}/data_fingerprint")
    _write_object(spark, asdict(config), f"{draft}/config")
    file_hashes.write.mode("overwrite").json(f"{draft}/file_hashes")
    for name, report in reports.items():
        report.write.mode("overwrite").json(f"{draft}/eval_report/{name}")
    baseline.write.mode("overwrite").parquet(f"{draft}/drift_baseline")
    rename(spark, draft, final)
    return final


def _write_object(spark: SparkSession, value: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(value, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_object(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def load_run(spark: SparkSession, root: str, task: str, run_id: str | None = None) -> Run:
    """The named run, or the one with the highest version."""
    if run_id is None:
        versions = run_versions(spark, root, task)
        if not versions:
            raise FileNotFoundError(f"no runs of {task} under {root}")
        run_id = versions[-1][1]
    path = f"{root}/{task}/{run_id}"
    if not exists(spark, path):
        raise FileNotFoundError(path)
    features = read_object(spark, f"{path}/feature_set")
    return Run(run_id, path, BoostedTrees.load(spark, f"{path}/model"), features["features"], features["target"])


def run_baseline(spark: SparkSession, run: Run) -> DataFrame:
    return spark.read.parquet(f"{run.path}/drift_baseline")
