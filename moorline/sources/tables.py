"""Table scans: keyed control tables, JDBC key/value settings, literal rows, catalog tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from moorline.operators.project import equal_to


def read_control_table(
    spark: SparkSession,
    location: str | None = None,
    fmt: str = "parquet",
    schema: StructType | None = None,
    options: Mapping | None = None,
    filters: Mapping | None = None,
) -> DataFrame:
    """Scan a control table of any Spark format; equality filters go down to the source."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    table = reader.load(location) if location else reader.load()
    return table.where(equal_to(filters)) if filters else table


def read_key_values(
    spark: SparkSession,
    filters: Mapping,
    options: Mapping | None = None,
    fmt: str = "jdbc",
    location: str | None = None,
    key: str = "param_key",
    value: str = "param_value",
) -> DataFrame:
    """Settings rows ``(param_key, param_value)`` of one parameter registry.

    For ``jdbc`` the options name ``url``, ``dbtable``, ``user`` and ``password``; the
    filters become the WHERE clause the database runs.
    """
    rows = read_control_table(spark, location, fmt, options=options, filters=filters)
    return rows.select(F.col(key).alias("param_key"), F.col(value).alias("param_value"))


def look_up(spark: SparkSession, path: str, schema: StructType | str, key: str, values: Sequence, fmt: str = "orc") -> DataFrame:
    """Rows with one of the ``values``, for a set of keys that a caller names.

    The keys go down to the files, which skip what can't have them; see
    :func:`moorline.sinks.write_indexed`. Keys that are a table themselves are a join.
    """
    return spark.read.schema(schema).format(fmt).load(path).where(F.col(key).isin(list(values)))


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str) -> DataFrame:
    """Typed in-memory rows."""
    return spark.createDataFrame(list(rows), schema)


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    """Scan a catalog table by name."""
    return spark.table(name)
