"""All catalogue queries of the core and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardmill.plans import core_problems, pipeline_queries, reference_queries

_PARTS = (core_problems, reference_queries, pipeline_queries)
QUERIES = {k: v for p in _PARTS for k, v in p.QUERIES.items()}
SQL = {k: v for p in _PARTS for k, v in p.SQL.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["precision_spans"](spark, sf_dir)
