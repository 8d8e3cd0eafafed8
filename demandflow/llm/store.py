"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from demandflow.session import ship_code  # noqa: F401


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a fresh temporary folder only on a local master that names none (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="llm-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends here, lost executors lose nothing."""
    path = f"{shared_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Jobs inside give back the disk of their shuffles when they end, as what they write is all that is read again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
