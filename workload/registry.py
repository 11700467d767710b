"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tripkit.session import apply_settings

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(function: Run) -> Run:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(apply_settings(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(run, sql)
        return run

    return register
