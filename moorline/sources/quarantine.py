"""Malformed-row capture for text formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from moorline.sinks.write import write_orc
from moorline.sources.files import BAD_RECORD, read_csv, read_json

IS_BAD = "is_bad"


def read_quarantined(spark: SparkSession, path, schema: StructType | str, fmt: str = "csv", opts=None) -> DataFrame:
    """Permissive scan that carries the raw text of malformed rows in ``_bad_record``.

    A text reader converts only the fields a query selects, so by itself it would call a
    row good or bad depending on a later projection. Here ``_bad_record`` reads every
    field, and CSV column pruning is off so that short and long rows are seen too.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = [f for f in declared.fieldNames() if f != BAD_RECORD]
    declared = StructType([declared[f] for f in fields]).add(BAD_RECORD, StringType())
    if fmt == "csv":
        rows = read_csv(spark, path, declared, {"columnPruning": "false", **(opts or {})})
    elif fmt == "json":
        rows = read_json(spark, path, declared, opts)
    else:
        raise ValueError(f"no malformed-row capture for format {fmt!r}")
    # True for every row, but not known to be until all fields are read.
    whole = F.xxhash64(*[F.col(f"`{f}`").isNull() for f in fields]) >= F.lit(-(2**63))
    return rows.withColumn(BAD_RECORD, F.when(whole, F.col(BAD_RECORD)))


def split_bad_records(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the raw-text column, and bad rows with it."""
    good = df.where(F.col(BAD_RECORD).isNull()).drop(BAD_RECORD)
    return good, df.where(F.col(BAD_RECORD).isNotNull())


def write_with_quarantine(df: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Land good and bad rows in one pass, as two partitions of one ORC dataset.

    Splitting the scan itself parses the text once per side; here the text is parsed
    once and both sides are then read from ORC.
    """
    marked = df.withColumn(IS_BAD, F.col(BAD_RECORD).isNotNull())
    whole = {"partitionOverwriteMode": "static"}
    write_orc(marked, path, mode="overwrite", partitionBy=[IS_BAD], opts=whole, rebalance=False)
    landed = df.sparkSession.read.schema(marked.schema).orc(path)
    good = landed.where(~F.col(IS_BAD)).drop(IS_BAD, BAD_RECORD)
    return good, landed.where(F.col(IS_BAD)).drop(IS_BAD)
