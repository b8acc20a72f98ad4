"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables as attributes, scanned when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


def query(sql: str, name: str | None = None):
    """Register a function of :class:`Tables` under ``name``, or its own name."""

    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__
        QUERIES[key] = lambda spark, folder: build(Tables(spark, folder))
        ORACLES[key] = sql
        return build

    return register
