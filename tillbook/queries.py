"""Registered queries: one callable per model / operator, ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillbook import extra_queries
from tillbook.plans.graph import MODEL_NAMES, Project

Query = Callable[[SparkSession, str], DataFrame]


def _model_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Project.from_dir(spark, sf_dir).table(name)

    run.__name__ = name
    return run


def registered() -> dict[str, Query]:
    return {**{name: _model_query(name) for name in MODEL_NAMES}, **extra_queries.registered()}
