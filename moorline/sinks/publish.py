"""Publishing a dataset: staged swap, skip what is there, keyed upsert in place."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moorline.operators.changes import upsert
from moorline.operators.keys import with_partner, without_partner
from moorline.session import drop_tables, hadoop_path, materialize
from moorline.sinks.write import partition_columns, write_counted, write_df


def _swap_in(fs, staged, final, overwrite: bool, fs_path) -> None:
    """Move ``staged`` to ``final``; what was there comes back if the move fails."""
    fs.mkdirs(final.getParent())
    aside = None
    if fs.exists(final):
        if not overwrite:
            raise FileExistsError(f"{final} already exists")
        aside = fs_path(final.getParent(), f"_previous_{uuid.uuid4().hex}")
        if not fs.rename(final, aside):
            raise RuntimeError(f"publish failed: cannot move {final} aside; it is unchanged")
    try:
        moved = fs.rename(staged, final)
    except Exception as error:
        moved, cause = False, error
    else:
        cause = None
    if not moved:
        if aside is not None and not fs.rename(aside, final):
            raise RuntimeError(f"publish failed and {final} could not be restored; its data is in {aside}") from cause
        raise RuntimeError(f"publish failed: cannot move {staged} to {final}; the old data is in place") from cause
    if aside is not None:
        fs.delete(aside, True)


def atomic_publish(
    df: DataFrame,
    final_path: str,
    tmp_path: str | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partitionBy: str | Sequence[str] | None = None,
    opts: Mapping | None = None,
    spark: SparkSession | None = None,
) -> int:
    """Write beside the target, then rename into place; returns the rows published.

    The old data is renamed aside, never deleted first, and restored when the rename
    fails. Any mode but ``overwrite`` refuses an existing target. A folder rename is
    atomic on HDFS-like file systems only; on an object store publish a new partition
    or folder and repoint the table instead.
    """
    spark = spark or df.sparkSession
    final_path = final_path.rstrip("/")
    fs, final = hadoop_path(spark, final_path)
    if mode != "overwrite" and fs.exists(final):
        raise FileExistsError(f"{final_path} already exists")
    if tmp_path is None:
        tmp_path = f"{final_path.rsplit('/', 1)[0]}/_staging_{uuid.uuid4().hex}"
    static = {**(opts or {}), "partitionOverwriteMode": "static"}
    rows = write_counted(df, tmp_path, mode="overwrite", fmt=fmt, partitionBy=partitionBy, opts=static)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    _swap_in(fs, hadoop(tmp_path), final, mode == "overwrite", hadoop)
    fs.create(hadoop(final_path, "_SUCCESS"), True).close()
    return rows


def skip_published(requested: DataFrame, published: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows of ``requested`` whose partition is not published yet."""
    return without_partner(requested, published, partitions)


PENDING = "_upsert"


def upsert_into(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: Sequence[str],
    partitionBy: str | Sequence[str],
    schema,
    order_by: Sequence[str] | None = None,
    fmt: str = "orc",
    opts: Mapping | None = None,
) -> int:
    """Upsert into a partitioned dataset, reading and rewriting only the partitions it touches.

    Touched are the partitions of the updates and, unless the partition columns belong
    to the key, those where an updated key lives now. Their whole new content is staged in the
    dataset's own ``_upsert`` folder, which scans pass over, and then written in place. A run
    that stops on the way is finished by the next call, or by :func:`finish_upsert`, from what
    is staged; one that stops before that has changed nothing. Returns the rows rewritten.
    """
    path, columns = path.rstrip("/"), partition_columns(partitionBy)
    finish_upsert(spark, path, columns, schema, fmt, opts)
    base = spark.read.schema(schema).format(fmt).load(path)
    touched = updates.select(*columns).distinct()
    if not set(columns) <= set(keys):
        touched = touched.union(with_partner(base, updates, keys).select(*columns)).distinct()
    touched, _ = materialize(touched, "touched")
    # Equal values prune the base at run time; a null partition value needs its own comparison.
    whole = reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
    affected = base.join(touched.where(whole), columns, "left_semi").select(*base.columns)
    affected = affected.union(with_partner(base.where(~whole), touched.where(~whole), columns).select(*base.columns))
    rows = write_counted(upsert(affected, updates, keys, order_by), f"{path}/{PENDING}/rows", mode="overwrite")
    staged = spark.read.schema(base.schema).parquet(f"{path}/{PENDING}/rows")
    write_df(without_partner(touched, staged, columns), f"{path}/{PENDING}/emptied", mode="overwrite")
    drop_tables(touched)
    fs, ready = hadoop_path(spark, f"{path}/{PENDING}/_READY")
    fs.create(ready, True).close()
    finish_upsert(spark, path, columns, schema, fmt, opts)
    return rows


def finish_upsert(spark: SparkSession, path: str, partitionBy, schema, fmt: str = "orc", opts: Mapping | None = None) -> bool:
    """Bring a staged upsert into place, however often it was begun; drop one that isn't fully staged.

    The staged rows are the whole content of their partitions, so writing them again gives the
    same dataset. Partitions that all rows have left are removed one by one as their names
    stream in. Returns whether there was a staged upsert.
    """
    path, columns = path.rstrip("/"), partition_columns(partitionBy)
    fs, pending = hadoop_path(spark, f"{path}/{PENDING}")
    _, ready = hadoop_path(spark, f"{path}/{PENDING}/_READY")
    found = fs.exists(ready)
    if found:
        declared = spark.read.schema(schema).format(fmt).load(path).schema
        staged = spark.read.schema(declared).parquet(f"{path}/{PENDING}/rows")
        write_df(staged, path, mode="overwrite", fmt=fmt, partitionBy=columns, opts=opts)
        emptied = spark.read.parquet(f"{path}/{PENDING}/emptied")
        names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        for row in emptied.select(*[F.col(c).cast("string") for c in columns]).toLocalIterator():
            _, folder = hadoop_path(spark, "/".join([path, *[names.getPartitionPathString(c, row[c]) for c in columns]]))
            fs.delete(folder, True)
    fs.delete(pending, True)
    return found
