"""Registered queries: the observations view and CSV sources."""

from __future__ import annotations

from demandflow.plans import inputs as I
from demandflow.plans.registry import query
from demandflow.sources import files
from demandflow.sources.files import (FUTURE_SCHEMA, HISTORY_SCHEMA, SUBMISSION_SCHEMA, read_csv,
                                      write_csv)
from demandflow.sources.observations import oracle


@query("obs_view", oracle("select * from observations"))
def obs_view(spark, sf):
    return I.obs(spark, sf)


def _roundtrip(spark, df, schema, name):
    path = I.scratch(spark, name)
    write_csv(df, path)
    return read_csv(spark, path, schema)


@query("s1_history_csv_scan", oracle("select * from history"))
def s1_history_csv_scan(spark, sf):
    """History written as header CSV and scanned back with a declared schema."""
    return _roundtrip(spark, I.history(spark, sf), HISTORY_SCHEMA, "history.csv")


@query("s2_future_csv_scan", oracle("select * from future"))
def s2_future_csv_scan(spark, sf):
    """The future side (no demand) through CSV."""
    return _roundtrip(spark, I.future(spark, sf), FUTURE_SCHEMA, "future.csv")


@query("s3_sample_layout_scan", oracle("select * from truth"))
def s3_sample_layout_scan(spark, sf):
    """S3: an (Index, demand) layout file scanned with the submission schema."""
    return _roundtrip(spark, I.truth(spark, sf), SUBMISSION_SCHEMA, "layout.csv")


@query("s3_layout_check", oracle("select * from (values (0, 'Index', 'Index', true, true), (1, 'demand', 'demand', true, true)) t(position, expected, found, readable, same)"))
def s3_layout_check(spark, sf):
    """S3: the layout file's header and values against the output's schema."""
    path = I.scratch(spark, "sample.csv")
    files.write_csv(I.truth(spark, sf), path)
    return files.compare_layout(spark, path, SUBMISSION_SCHEMA)
