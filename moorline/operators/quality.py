"""Checks on tables and on the rows of a stage."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moorline.operators.project import json_record
from moorline.session import counted, observed


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and nulls per column in one pass: a single row, one column each."""
    columns = df.columns if columns is None else columns
    counts = [F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns]
    return df.agg(F.count(F.lit(1)).alias("row_count"), *counts)


def validate_non_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: its nulls, and whether it passes."""
    profile = null_profile(df, columns)
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_nulls").alias("null_count")) for c in columns])
    return profile.select(F.inline(rows)).withColumn("passed", F.col("null_count") == 0)


REPORT = "table_name STRING, row_count BIGINT, table_schema STRING, sample ARRAY<STRING>, error STRING"


def verify_tables(
    spark: SparkSession,
    tables: Mapping[str, Callable[[], DataFrame]],
    sample: int = 5,
    order_by: Mapping[str, Sequence[str]] | None = None,
    at_once: int = 4,
) -> DataFrame:
    """Row count, schema and the first ``sample`` rows as JSON of each table.

    One job a table reads all of it, picks the sample and counts the rows as they pass;
    ``at_once`` tables are read at the same time, so a small one doesn't wait for a large one to
    end. Jobs keep the caller's job group and scheduler pool. Whatever goes wrong with a table,
    when it is opened or when it is read, is its ``error`` and leaves the others alone. Name
    columns in ``order_by`` for a table whose sample must be the same each time.
    """

    def check(name: str, load: Callable[[], DataFrame]) -> tuple:
        try:
            table = load()
            rows, counter = counted(table)
            # A limit without an order, or in one that the rows have already, would stop before every
            # row is counted; Spark knows no frame to be sorted by a struct.
            order = F.struct(*((order_by or {}).get(name) or [F.monotonically_increasing_id()]))
            first = json_record(rows.orderBy(order).limit(sample)).collect()
            return name, observed(counter).get("rows", 0), table.schema.simpleString(), [row[0] for row in first], None
        except Exception as error:
            cause = (error.getCondition() if isinstance(error, PySparkException) else None) or type(error).__name__
            return name, None, None, None, cause

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        # A target takes over the properties that its maker has at that time.
        waiting = [pool.submit(inheritable_thread_target(spark)(check), name, load) for name, load in tables.items()]
        return spark.createDataFrame([found.result() for found in waiting], REPORT)


def table_sample(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows; give an order where the same rows must come out each time."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
