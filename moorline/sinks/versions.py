"""Versions of a published dataset, and the one catalog entry that tells readers which is current.

A version is a table of its own over folders that are never written again. What readers name is
a view over the current version, replaced by a single catalog operation: nothing is renamed or
overwritten, so this is safe on object stores, and a reader sees one whole version or another,
never parts of two. A frame that was planned before goes on reading the version it was planned
on. A run that stops before the view is replaced has changed nothing.

An upsert writes the partitions it touches to new folders; the new version takes the others over
where they lie. A bitmap of hashed keys per partition tells where a key may be, so partitions
without any updated key are not opened.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from moorline.operators.changes import upsert
from moorline.operators.keys import with_partner
from moorline.session import hadoop_path
from moorline.sinks.catalog import _quoted, add_partitions, external_table_ddl
from moorline.sinks.write import Written, partition_folder, write_df, write_partitions

# The property of the view that names its version.
VERSION = "moorline.version"
INDEX_SCHEMA = "bucket BIGINT, bits BINARY"
MANIFEST = "partition ARRAY<STRING>, folder STRING, index_folder STRING"


@dataclass(frozen=True)
class Published:
    """A dataset behind one catalog name.

    ``keys`` are indexed for :func:`upsert_version`; ``index_bits`` is the length of a partition's
    bitmap and stays the same for the life of the dataset. A partition of n keys is opened for
    a key it doesn't have with a chance of n / ``index_bits``; the result is exact all the same.
    """

    name: str
    root: str
    schema: StructType
    partitionBy: tuple[str, ...]
    keys: tuple[str, ...] = ()
    index_bits: int = 1 << 26
    fmt: str = "orc"

    def table(self, version: int, part: str = "") -> str:
        return f"{self.name}__v{version:06d}{part}"

    def manifest(self, version: int) -> str:
        return f"{self.root.rstrip('/')}/manifest/{version:06d}"


def current_version(spark: SparkSession, to: Published) -> int:
    """The version that readers see; 0 before the first."""
    if not spark.catalog.tableExists(to.name):
        return 0
    rows = spark.sql(f"SHOW TBLPROPERTIES {_quoted(to.name)}").where(F.col("key") == VERSION).collect()
    return int(rows[0]["value"])


def read_version(spark: SparkSession, to: Published, version: int | None = None) -> DataFrame:
    """The current version, or an earlier one that is still kept."""
    return spark.table(to.table(version) if version else to.name)


def _versions(spark: SparkSession, to: Published) -> list[int]:
    """Versions with a table, among them those that were never switched to."""
    database, _, name = to.name.rpartition(".")
    inside = f" IN {_quoted(database)}" if database else ""
    tables = spark.sql(f"SHOW TABLES{inside} LIKE '{name}__v*'").collect()
    found = (row["tableName"].removeprefix(f"{name}__v".lower()) for row in tables)
    return sorted({int(text) for text in found if text.isdigit()})


def _create(spark: SparkSession, to: Published, name: str, schema: StructType, parts: Sequence, folders: Sequence[str]) -> None:
    """A table over just these partitions, each where it lies."""
    if spark.catalog.tableExists(name):
        raise FileExistsError(f"{name} already exists")
    hive = spark.conf.get("spark.sql.catalogImplementation") == "hive"
    spark.sql(external_table_ddl(name, schema, f"{to.root.rstrip('/')}/none", to.partitionBy, hive))
    add_partitions(spark, name, to.partitionBy, parts, folders)


def _index_schema(to: Published) -> StructType:
    return StructType([*StructType.fromDDL(INDEX_SCHEMA).fields, *[to.schema[c] for c in to.partitionBy]])


def _hashed(to: Published) -> dict:
    number = F.pmod(F.xxhash64(*to.keys), F.lit(to.index_bits))
    return {"bucket": F.bitmap_bucket_number(number), "position": F.bitmap_bit_position(number)}


def key_index(rows: DataFrame, to: Published) -> DataFrame:
    """Bitmaps of the hashed keys, per partition and run of 32,768 bits that has any."""
    hashed = rows.select(*to.partitionBy, *[c.alias(n) for n, c in _hashed(to).items()])
    return hashed.groupBy(*to.partitionBy, "bucket").agg(F.bitmap_construct_agg("position").alias("bits"))


def partitions_with(index: DataFrame, updates: DataFrame, to: Published) -> DataFrame:
    """Partitions that may hold a key of ``updates``, by the index alone.

    Two bitmaps share a bit if both together have fewer than each by itself. There is one row per
    partition and run of bits, however many updates there are.
    """
    wanted = updates.select(*[c.alias(n) for n, c in _hashed(to).items()]).groupBy("bucket").agg(
        F.bitmap_construct_agg("position").alias("wanted")
    )
    both = index.join(wanted, "bucket").select(*to.partitionBy, "bucket", F.explode(F.array("bits", "wanted")).alias("bits"))
    merged = both.groupBy(*to.partitionBy, "bucket").agg(
        F.bitmap_or_agg("bits").alias("either"), F.sum(F.bitmap_count("bits")).alias("each")
    )
    return merged.where(F.bitmap_count("either") < F.col("each")).select(*to.partitionBy).distinct()


def _texts(rows: DataFrame, to: Published) -> set[tuple]:
    """Partition values as text; one row per partition comes to the driver, which has to name it to the catalog."""
    values = [F.nullif(F.col(c).cast("string"), F.lit("")).alias(f"p{i}") for i, c in enumerate(to.partitionBy)]
    return {tuple(row) for row in rows.select(*values).distinct().collect()}


def _written(spark: SparkSession, df: DataFrame, to: Published, version: int, opts: Mapping | None) -> tuple[Written, list[tuple]]:
    """Rows in new folders, their key index beside them, and the manifest rows of both."""
    root, mark = to.root.rstrip("/"), f"{version:06d}-{uuid.uuid4().hex}"
    data, index = f"{root}/data/{mark}", f"{root}/index/{mark}"
    written = write_partitions(df.select(*to.schema.names), data, to.partitionBy, mode="overwrite", fmt=to.fmt, opts=opts)
    folders = [partition_folder(spark, data, to.partitionBy, p) for p in written.partitions]
    if not to.keys:
        return written, [(list(p), f, None) for p, f in zip(written.partitions, folders)]
    # Keys alone are read back; the index is of what was written.
    rows = spark.read.schema(to.schema).format(to.fmt).load(data) if written.partitions else df.limit(0)
    write_df(key_index(rows, to), index, mode="overwrite", fmt="orc", partitionBy=to.partitionBy)
    places = [partition_folder(spark, index, to.partitionBy, p) for p in written.partitions]
    return written, [(list(p), f, i) for p, f, i in zip(written.partitions, folders, places)]


def _switch(spark: SparkSession, to: Published, base: int, version: int, manifest: list[tuple]) -> None:
    """Register a version and point readers at it, unless they were pointed elsewhere meanwhile."""
    rows = spark.createDataFrame(manifest, MANIFEST).coalesce(1)
    write_df(rows, to.manifest(version), mode="overwrite")
    _create(spark, to, to.table(version), to.schema, [m[0] for m in manifest], [m[1] for m in manifest])
    if to.keys:
        _create(spark, to, to.table(version, "_index"), _index_schema(to), [m[0] for m in manifest], [m[2] for m in manifest])
    if (now := current_version(spark, to)) != base:
        raise RuntimeError(f"{to.name} went from version {base} to {now} meanwhile; version {version} is not published")
    point_at(spark, to, version)


def point_at(spark: SparkSession, to: Published, version: int) -> None:
    """Make a kept version current: one catalog operation, also to go back to an earlier one."""
    if not spark.catalog.tableExists(to.table(version)):
        raise ValueError(f"{to.name} has no version {version}")
    columns = ", ".join(_quoted(c) for c in to.schema.names)
    spark.sql(
        f"CREATE OR REPLACE VIEW {_quoted(to.name)} TBLPROPERTIES ('{VERSION}'='{version}') "
        f"AS SELECT {columns} FROM {_quoted(to.table(version))}"
    )


def _next(spark: SparkSession, to: Published) -> tuple[int, int]:
    base = current_version(spark, to)
    return base, max([base, *_versions(spark, to)]) + 1


def publish_version(df: DataFrame, to: Published, opts: Mapping | None = None) -> Written:
    """Publish ``df`` as a new version that holds its rows and no others."""
    spark = df.sparkSession
    base, version = _next(spark, to)
    written, manifest = _written(spark, df, to, version, opts)
    _switch(spark, to, base, version, manifest)
    return written


def upsert_version(updates: DataFrame, to: Published, order_by: Sequence[str] | None = None, opts: Mapping | None = None) -> Written:
    """Insert or replace rows by key in a new version; only partitions that have such a key are read and rewritten.

    Touched are the partitions of the updates and those where an updated key lives now. The index
    leaves few to look into, and of these only the keys are read to be sure. A partition that all
    rows leave is not in the new version. Returns what was rewritten.
    """
    spark = updates.sparkSession
    if not to.keys:
        raise ValueError(f"{to.name} has no indexed keys")
    base, version = _next(spark, to)
    if not base:
        return publish_version(upsert(updates.limit(0), updates, to.keys, order_by), to, opts)
    parts = {tuple(m["partition"]): (m["folder"], m["index_folder"]) for m in spark.read.schema(MANIFEST).parquet(to.manifest(base)).collect()}
    touched, made = _texts(updates, to), []

    def over(kind: str, chosen: set[tuple]) -> DataFrame:
        """A passing table over some partitions of the base version; others are not even listed."""
        name = to.table(version, f"_{kind}_{uuid.uuid4().hex[:8]}")
        known = [p for p in chosen if p in parts]
        _create(spark, to, name, to.schema, known, [parts[p][0] for p in known])
        made.append(name)
        return spark.table(name)

    try:
        if not set(to.partitionBy) <= set(to.keys):
            hits = _texts(partitions_with(spark.table(to.table(base, "_index")), updates, to), to) - touched
            touched |= _texts(with_partner(over("hits", hits), updates, to.keys), to)
        rows = upsert(over("touched", touched).select(*to.schema.names), updates.select(*to.schema.names, *_others(order_by, to)), to.keys, order_by)
        written, manifest = _written(spark, rows, to, version, opts)
    finally:
        for name in made:
            spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")
    kept = [(list(p), *folders) for p, folders in parts.items() if p not in touched]
    _switch(spark, to, base, version, kept + manifest)
    return written


def _others(order_by: Sequence[str] | None, to: Published) -> list[str]:
    return [c for c in order_by or () if c not in to.schema.names]


def drop_versions(spark: SparkSession, to: Published, keep: int = 2) -> list[int]:
    """Drop all but the current version and the ``keep - 1`` before it, with the folders that none of these uses.

    Versions that were never switched to go too. Run it when no frame of an older version is
    still being read and no other run is publishing.
    """
    now, known = current_version(spark, to), _versions(spark, to)
    stays = set([v for v in known if v <= now][-keep:])

    def folders(version: int) -> set[str]:
        rows = spark.read.schema(MANIFEST).parquet(to.manifest(version)).collect()
        return {f for row in rows for f in (row["folder"], row["index_folder"]) if f}

    used = set().union(*map(folders, stays))
    gone = [v for v in known if v not in stays]
    for version in gone:
        fs, manifest = hadoop_path(spark, to.manifest(version))
        for folder in folders(version) - used if fs.exists(manifest) else ():
            fs.delete(hadoop_path(spark, folder)[1], True)
        for part in ("", "_index"):
            spark.sql(f"DROP TABLE IF EXISTS {_quoted(to.table(version, part))}")
        fs.delete(manifest, True)
    return gone
