"""Runs that appear as a whole: output and manifest.

A run is written to a staging folder beside the others: its output as CSV, its
manifest (parameters, weights, scores, layout) as one JSON record. Then the
folder is renamed to its final name, one step of the file system. A run
without its manifest's success marker, or still in staging, does not count, so
a rerun after a lost driver finds either a whole run or none. (On stores whose
rename copies, the marker is written last and decides alike.)
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from demandflow.sources.files import write_csv

#: parameters and scores by model, blend weights by model, columns of the output in order
MANIFEST_SCHEMA = ("variant string, params map<string, struct<maxIter: int, maxDepth: int, stepSize: double, subsamplingRate: double, "
                   "minInstancesPerNode: int, minInfoGain: double>>, scores map<string, struct<rmse: double, r2: double>>, "
                   "weights map<string, double>, layout array<string>")


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def commit_run(spark: SparkSession, folder: str, output: DataFrame, manifest: DataFrame) -> str:
    """Writes ``output`` and the one-row ``manifest`` under ``folder`` and makes them visible together; the run's path."""
    name = uuid.uuid4().hex
    staging, final = f"{folder}/.staging-{name}", f"{folder}/run-{name}"
    write_csv(output, f"{staging}/output")
    manifest.write.json(f"{staging}/manifest")
    jvm, fs, source = _folder(spark, staging)
    if not fs.rename(source, jvm.org.apache.hadoop.fs.Path(final)):
        raise OSError(f"cannot rename {staging} to {final}")
    return final


def latest_run(spark: SparkSession, folder: str) -> str | None:
    """The newest whole run under ``folder``."""
    jvm, fs, p = _folder(spark, folder)
    if not fs.exists(p):
        return None
    found = [(s.getModificationTime(), s.getPath().toString()) for s in fs.listStatus(p) if s.getPath().getName().startswith("run-")]
    whole = [x for x in sorted(found) if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{x[1]}/manifest/_SUCCESS"))]
    return whole[-1][1] if whole else None


def read_manifest(spark: SparkSession, run: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{run}/manifest")


def resume_or(spark: SparkSession, folder: str, tune: Callable[[], DataFrame]) -> DataFrame:
    """The manifest of the newest whole run under ``folder``; without one, what ``tune`` finds."""
    run = latest_run(spark, folder)
    return read_manifest(spark, run) if run else tune()
