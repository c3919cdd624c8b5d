"""Registered queries: a Spark plan and, where SQL can express it, its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one data folder, read lazily: ``t.orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, text: str, *names: str) -> DataFrame:
        """``text`` over the named tables, as ``{name}`` in it."""
        return self.spark.sql(text, **{n: getattr(self, n) for n in names})


def query(sql: str | None = None):
    """Registers ``f(tables) -> DataFrame`` under its own name."""

    def register(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def load() -> None:
    from . import lifecycle, relational, storage, streams  # noqa: F401
