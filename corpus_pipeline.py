"""The corpus pipeline: quality rules, near-duplicates, benchmark decontamination, personal data, mixing.

Each stage takes (spark, docs, sf_dir), works on all documents it is given and
returns a DataFrame; all but the last return the columns of ``documents``. The
tables that a stage needs besides its documents are read from ``sf_dir``.
Empty input gives empty output. Rows are told apart by a number of their own, not
by doc_id: rows with a null or a repeated doc_id are documents that are judged by
their own text. Texts without words under one doc_id count as copies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandflow.llm.decontaminate import decontaminate
from demandflow.llm.mixing import mix
from demandflow.llm.near_dups import near_duplicates
from demandflow.llm.pii import redact
from demandflow.llm.quality import calibrate, features, judge
from demandflow.llm.store import materialise


_ROW = "__row"


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a row number, stored so that each reading gives the same."""
    return materialise(docs.withColumn(_ROW, F.monotonically_increasing_id()))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    measured = materialise(features(docs))
    cutoffs = calibrate(measured, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(measured, cutoffs).where("q_kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each group (null last)."""
    rows = _numbered(docs)
    found = near_duplicates(rows, id_col=_ROW).join(rows.select(_ROW, "doc_id"), _ROW)
    no_words = F.col("n_shingles") == 0
    group = [F.when(~no_words | F.col("doc_id").isNull(), F.col("component_id")).alias("group"), F.when(no_words, F.col("doc_id")).alias("group_id")]
    kept = found.groupBy(*group).agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", _ROW)).alias("first")).select(F.col(f"first.{_ROW}").alias(_ROW))
    return rows.join(kept, _ROW, "left_semi").select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    rows = _numbered(docs)
    found = decontaminate(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=_ROW)
    return rows.join(found.where("size(items) > 0").select(_ROW), _ROW, "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, spans of personal data replaced by their kind; n_chars follows the text."""
    clean = redact(_numbered(docs), id_col=_ROW).select(*docs.columns)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time a document is taken, with its copy, output shard and place in the shard's order."""
    mixed = mix(docs)
    return mixed.select(*docs.columns, F.col("mix_size"), F.explode("mix_places").alias("__place")).select(*docs.columns, "mix_size", "__place.copy", "__place.shard", "__place.position")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
]

#: SQL expresses neither the learned cutoffs nor the trees nor the hashed draws
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = materialise(docs)
    return docs
