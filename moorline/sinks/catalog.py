"""Catalog objects over landing datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from moorline.sinks.write import Written, partition_columns, write_partitions

# Partitions that one statement names.
STATEMENT_PARTITIONS = 500


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a temp view and hand it on."""
    df.createOrReplaceTempView(name)
    return df


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)}")


def external_table_ddl(
    name: str, schema: StructType, location: str, partitionBy: str | Sequence[str], hive: bool = True
) -> str:
    """DDL of an external ORC table over ``location``, partition columns last.

    Without a Hive catalog the same table is declared through the ORC data source.
    """
    columns = partition_columns(partitionBy)
    declared = {f.name: f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields}
    body = ", ".join(text for column, text in declared.items() if column not in columns)
    parts = ", ".join(declared[c] for c in columns)
    where = location.replace("\\", "\\\\").replace("'", "\\'")
    if hive:
        return (
            f"CREATE EXTERNAL TABLE IF NOT EXISTS {_quoted(name)} ({body}) PARTITIONED BY ({parts}) "
            f"STORED AS ORC LOCATION '{where}' TBLPROPERTIES ('orc.compress'='SNAPPY')"
        )
    both = ", ".join(filter(None, (body, parts)))
    return (
        f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({both}) USING ORC OPTIONS ('compression'='snappy') "
        f"PARTITIONED BY ({', '.join(map(_quoted, columns))}) LOCATION '{where}'"
    )


def create_external_table(
    spark: SparkSession, name: str, schema: StructType, location: str, partitionBy: str | Sequence[str]
) -> None:
    """Declare the table; it shows rows once :func:`repair_table` has found its partitions."""
    hive = spark.conf.get("spark.sql.catalogImplementation") == "hive"
    spark.sql(external_table_ddl(name, schema, location, partitionBy, hive))


def repair_table(spark: SparkSession, name: str) -> None:
    """Add every partition folder under the table's location to the catalog."""
    spark.sql(f"MSCK REPAIR TABLE {_quoted(name)}")


def show_partitions(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {_quoted(name)}")


def published_partitions(spark: SparkSession, name: str, partitionBy: str | Sequence[str]) -> DataFrame:
    """Catalog partitions as typed columns: a metadata read, no data file is opened."""
    types = {f.name: f.dataType for f in spark.table(name).schema.fields}
    steps = F.split("partition", "/")

    def value(i: int, column: str):
        raw = F.regexp_replace(F.substring_index(F.get(steps, i), "=", -1), r"\+", "%2B")
        text = F.url_decode(raw)
        return F.when(text != "__HIVE_DEFAULT_PARTITION__", text).cast(types[column]).alias(column)

    return show_partitions(spark, name).select(*[value(i, c) for i, c in enumerate(partition_columns(partitionBy))])


def partition_counts(spark: SparkSession, name: str, partitionBy: str | Sequence[str]) -> DataFrame:
    """Rows per partition of a catalog table."""
    return spark.table(name).groupBy(*partition_columns(partitionBy)).agg(F.count(F.lit(1)).alias("row_count"))


def _literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(columns: Sequence[str], values: Sequence[str | None]) -> str:
    return "PARTITION (" + ", ".join(f"{_quoted(c)}={_literal(v)}" for c, v in zip(columns, values)) + ")"


def add_partitions(
    spark: SparkSession, name: str, partitionBy: str | Sequence[str], partitions: Sequence[Sequence[str | None]],
    folders: Sequence[str] | None = None,
) -> None:
    """Register partitions by value, where they aren't yet; ``folders`` says where each one lies."""
    columns = partition_columns(partitionBy)
    places = [f" LOCATION {_literal(f)}" for f in folders] if folders is not None else [""] * len(partitions)
    specs = [_spec(columns, values) + place for values, place in zip(partitions, places)]
    for low in range(0, len(specs), STATEMENT_PARTITIONS):
        spark.sql(f"ALTER TABLE {_quoted(name)} ADD IF NOT EXISTS " + " ".join(specs[low:low + STATEMENT_PARTITIONS]))


def drop_partitions(
    spark: SparkSession, name: str, partitionBy: str | Sequence[str], partitions: Sequence[Sequence[str | None]]
) -> None:
    """Take partitions out of the catalog; the files of an external table stay."""
    columns = partition_columns(partitionBy)
    specs = [_spec(columns, values) for values in partitions]
    for low in range(0, len(specs), STATEMENT_PARTITIONS):
        spark.sql(f"ALTER TABLE {_quoted(name)} DROP IF EXISTS " + ", ".join(specs[low:low + STATEMENT_PARTITIONS]))


def write_registered(
    df: DataFrame, name: str, path: str, partitionBy: str | Sequence[str], emptied: Sequence[Sequence[str | None]] = (),
    fmt: str = "orc", opts: Mapping | None = None, rebalance: bool = True,
) -> Written:
    """Replace the partitions that ``df`` brings in the table over ``path``, and register just those.

    The write tells which they are, so no folder is listed, however many partitions the table has.
    ``emptied`` are partitions that a job knows to have lost all rows; they leave the catalog.
    A partition that ``df`` brings is never one of them.
    """
    written = write_partitions(df, path, partitionBy, mode="overwrite", fmt=fmt, opts=opts, rebalance=rebalance)
    spark, brought = df.sparkSession, set(written.partitions)
    add_partitions(spark, name, partitionBy, written.partitions)
    drop_partitions(spark, name, partitionBy, [p for p in map(tuple, emptied) if p not in brought])
    spark.catalog.refreshTable(name)
    return written
