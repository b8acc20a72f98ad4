"""Dataset writers."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from moorline.session import counted, observed

# Default partition columns of a landing dataset.
LANDING_PARTITIONS = "biz_dt,biz_status"

# A task that joins two buckets sorts them; so many rows of a few columns take some 70 MB.
ROWS_PER_BUCKET = 500_000


def partition_columns(value: str | Sequence[str] | None = LANDING_PARTITIONS) -> list[str]:
    """Partition columns from a comma list or a sequence."""
    names = value.split(",") if isinstance(value, str) else value or []
    return [name.strip() for name in names if name.strip()]


def write_df(
    df: DataFrame,
    path: str,
    mode: str = "append",
    fmt: str = "parquet",
    partitionBy: str | Sequence[str] | None = None,
    opts: Mapping | None = None,
    rebalance: bool = True,
) -> None:
    """Write ``df``; a partitioned overwrite replaces only the partitions it brings.

    Ask for ``partitionOverwriteMode=static`` in ``opts`` to replace the whole folder. ORC
    is compressed with snappy unless ``opts`` says otherwise.
    Partitioned writes are rebalanced on the partition columns, so the file count does
    not grow as tasks times partitions; adaptive execution splits a partition that holds
    most of the rows over many tasks. Turn it off when a load has only a few partitions.
    """
    columns = partition_columns(partitionBy)
    defaults = ({"partitionOverwriteMode": "dynamic"} if columns else {}) | ({"compression": "snappy"} if fmt == "orc" else {})
    options = {**defaults, **(opts or {})}
    if columns and rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in columns])
    writer = df.write.mode(mode).format(fmt).options(**options)
    (writer.partitionBy(*columns) if columns else writer).save(path)


def write_orc(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partitionBy: str | Sequence[str] | None = None,
    opts: Mapping | None = None,
    rebalance: bool = True,
) -> None:
    """ORC with snappy compression unless ``opts`` says otherwise."""
    write_df(df, path, mode, "orc", partitionBy, opts, rebalance)


def write_counted(df: DataFrame, path: str, **write_args) -> int:
    """Write and return the number of rows written, counted by the write itself."""
    rows, counter = counted(df)
    write_df(rows, path, **write_args)
    return observed(counter).get("rows", 0)


def write_indexed(df: DataFrame, path: str, keys: Sequence[str], filters: Sequence[str] = (), mode: str = "overwrite", opts: Mapping | None = None) -> None:
    """ORC files that hold ranges of ``keys``, sorted, so a look-up by key reads a few thousand rows.

    Files, stripes and row groups carry the least and greatest key, and Bloom filters over the
    keys and the columns in ``filters``, which need not be sorted. Ranges are cut by sampling, so a
    key with very many rows may fill several files.
    """
    columns = ",".join(dict.fromkeys([*keys, *filters]))
    options = {"compression": "snappy", "orc.bloom.filter.columns": columns, "orc.bloom.filter.fpp": "0.01", **(opts or {})}
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode(mode).format("orc").options(**options).save(path)


def bucket_count(rows: int, least: int = 1) -> int:
    """Buckets for tables of up to ``rows`` rows: as many as it takes for a bucket not to grow with its table."""
    return max(least, math.ceil(rows / ROWS_PER_BUCKET))


def write_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None, mode: str = "overwrite", fmt: str = "parquet"
) -> None:
    """A catalog table dealt out and sorted by ``keys``; two with the same buckets join and group on them without a shuffle.

    One task writes a bucket, so a bucket is one sorted file. Choose ``buckets`` for the larger
    table, as :func:`bucket_count` does. A key with a large share of the rows makes one large bucket, which a join can't split;
    land such a table with :func:`write_df`, where adaptive execution does.
    """
    writer = df.repartition(buckets, *keys).write.mode(mode).format(fmt).bucketBy(buckets, *keys).sortBy(*keys)
    (writer.option("path", path) if path else writer).saveAsTable(name)


@dataclass(frozen=True)
class Written:
    """What a write brought: its rows, and the values of its partitions as text, null for none."""

    rows: int
    partitions: list[tuple[str | None, ...]]


def write_partitions(df: DataFrame, path: str, partitionBy: str | Sequence[str], **write_args) -> Written:
    """Write a partitioned dataset; rows and partitions are told by the write itself.

    Nothing is listed or counted afterwards. One short text per partition of this write comes to
    the driver. An empty text is stored as no value, as Spark's writers do.
    """
    columns, seen = partition_columns(partitionBy), Observation()
    values = F.struct(*[F.nullif(F.col(c).cast("string"), F.lit("")).alias(f"p{i}") for i, c in enumerate(columns)])
    told = df.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(values).alias("partitions"))
    write_df(told, path, partitionBy=columns, **write_args)
    found = {"rows": 0, "partitions": []} | observed(seen)
    order = lambda values: [(v is not None, v or "") for v in values]
    return Written(found["rows"], sorted((tuple(p) for p in found["partitions"]), key=order))


def partition_folder(spark: SparkSession, path: str, columns: Sequence[str], values: Sequence[str | None]) -> str:
    """The folder under ``path`` that Spark's writers use for these partition values."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join([path.rstrip("/"), *[names.getPartitionPathString(c, v) for c, v in zip(columns, values)]])
