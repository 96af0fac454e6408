"""Every query of the engine by name, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(oracle: str | None = None):
    """Register a function (table reader, spark) -> DataFrame under its name, with its SQL twin if there is one."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: table(spark, sf_dir, name), spark)
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


from inkloom.plans import documents, fulltext, ingestion, relations, vectors  # noqa: E402, F401
