"""Sink, publishing and catalog queries, each over a fresh dataset in the shared folder."""

import uuid

from pyspark.sql import functions as F

from moorline.operators import Dimension, breakdown_rollup, label_status, lookup_join, star_join
from moorline.queries.registry import query
from moorline.session import scratch_path
from moorline.sinks import (
    Published,
    atomic_publish,
    bucket_count,
    create_database,
    create_external_table,
    partition_counts,
    publish_version,
    published_partitions,
    read_version,
    repair_table,
    skip_published,
    upsert_into,
    upsert_version,
    write_bucketed,
    write_counted,
    write_indexed,
    write_orc,
    write_registered,
)
from moorline.sources import literal_rows, look_up, read_catalog, read_orc

PARTITIONS = ["biz_dt", "biz_status"]
OUTPUTS = {"ACTIVE": ["O"], "EXPIRED": ["F"]}

LANDED = """
    landed AS (
        SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y') AS biz_dt,
               CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'EXPIRED' ELSE 'RESIDUAL' END AS biz_status FROM orders)"""


def _contracts(t):
    labelled = label_status(t.orders, "o_orderstatus", OUTPUTS)
    return labelled.select("o_orderkey", "o_custkey", "o_totalprice", F.date_format("o_orderdate", "yyyy").alias("biz_dt"),
                           "biz_status")


def _landed(t):
    path = scratch_path(t.spark, "landing")
    write_orc(_contracts(t), path, mode="overwrite", partitionBy=PARTITIONS)
    return path


@query(f"WITH {LANDED} SELECT * FROM landed")
def orc_roundtrip(t):
    return read_orc(t.spark, _landed(t), _contracts(t).schema)


@query(f"WITH {LANDED} SELECT * REPLACE (CASE biz_dt WHEN '1996' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice) FROM landed")
def dynamic_overwrite(t):
    path, contracts = _landed(t), _contracts(t)
    doubled = contracts.where("biz_dt = '1996'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    write_orc(doubled, path, mode="overwrite", partitionBy=PARTITIONS)
    return read_orc(t.spark, path, contracts.schema)


@query(f"WITH {LANDED} SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM landed")
def staged_publish(t):
    path, contracts = scratch_path(t.spark, "published"), _contracts(t)
    atomic_publish(contracts, path, fmt="orc", partitionBy=PARTITIONS)
    atomic_publish(contracts.withColumn("o_totalprice", F.col("o_totalprice") + 1), path, fmt="orc", partitionBy=PARTITIONS)
    return read_orc(t.spark, path, contracts.schema)


@query(f"""
    WITH {LANDED}
    SELECT * REPLACE (CASE WHEN biz_dt = '1996' AND biz_status = 'RESIDUAL' THEN 'EXPIRED' ELSE biz_status END AS biz_status)
    FROM landed""")
def partition_upsert(t):
    path, contracts = _landed(t), _contracts(t)
    expired = contracts.where("biz_dt = '1996' AND biz_status = 'RESIDUAL'").withColumn("biz_status", F.lit("EXPIRED"))
    upsert_into(t.spark, path, expired, ["o_orderkey"], PARTITIONS, contracts.schema)
    return read_orc(t.spark, path, contracts.schema)


@query("SELECT count(*) AS rows_written FROM lineitem")
def counted_write(t):
    rows = write_counted(t.lineitem, scratch_path(t.spark, "counted"), mode="overwrite")
    return literal_rows(t.spark, [(rows,)], "rows_written BIGINT")


@query(f"""
    WITH {LANDED}
    SELECT biz_dt, biz_status, count(*) AS row_count, (SELECT count(*) FROM orders JOIN customer ON c_custkey = o_custkey) AS written
    FROM landed JOIN customer ON c_custkey = o_custkey GROUP BY biz_dt, biz_status""")
def lookup_publish(t):
    """Lookup join into a partitioned ORC dataset, with counts from the write and by partition."""
    path = scratch_path(t.spark, "lookup")
    joined = lookup_join(_contracts(t), t.customer, {"o_custkey": "c_custkey"}, ["c_acctbal"])
    written = write_counted(joined, path, mode="overwrite", fmt="orc", partitionBy=PARTITIONS, opts={"compression": "snappy"})
    landed = read_orc(t.spark, path, joined.schema)
    return landed.groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("row_count"), F.lit(written).cast("bigint").alias("written"))


def _catalog_table(t, only="true"):
    """A table in a database of its own over the landed contracts that ``only`` picks."""
    create_database(t.spark, "landing_zone")
    name, path = f"landing_zone.landing_{uuid.uuid4().hex}", scratch_path(t.spark, "landing")
    write_orc(_contracts(t).where(only), path, mode="overwrite", partitionBy=PARTITIONS)
    create_external_table(t.spark, name, _contracts(t).schema, path, PARTITIONS)
    repair_table(t.spark, name)
    return name


@query(f"WITH {LANDED} SELECT biz_dt, biz_status, count(*) AS row_count FROM landed GROUP BY biz_dt, biz_status")
def catalog_partition_counts(t):
    return partition_counts(t.spark, _catalog_table(t), PARTITIONS)


@query(f"WITH {LANDED} SELECT DISTINCT biz_dt, biz_status FROM landed")
def catalog_partitions(t):
    return published_partitions(t.spark, _catalog_table(t), PARTITIONS)


@query(f"WITH {LANDED} SELECT * FROM landed WHERE biz_status <> 'ACTIVE' OR biz_dt >= '1998'", name="skip_published")
def skip_published_partitions(t):
    """What is still to be landed, by the partitions that the catalog has."""
    table = _catalog_table(t, "biz_status = 'ACTIVE' AND biz_dt < '1998'")
    return skip_published(_contracts(t), published_partitions(t.spark, table, PARTITIONS), PARTITIONS)


@query(f"WITH {LANDED} SELECT * FROM landed")
def catalog_scan(t):
    return read_catalog(t.spark, _catalog_table(t))


@query(f"WITH {LANDED} SELECT * FROM landed WHERE biz_dt = '1996' AND biz_status = 'ACTIVE'")
def catalog_pruned_scan(t):
    return read_catalog(t.spark, _catalog_table(t)).where("biz_dt = '1996' AND biz_status = 'ACTIVE'")


def _published(t, keys=()):
    create_database(t.spark, "landing_zone")
    name, root = f"landing_zone.published_{uuid.uuid4().hex}", scratch_path(t.spark, "published")
    return Published(name, root, _contracts(t).schema, tuple(PARTITIONS), keys)


@query(f"""
    WITH {LANDED}
    SELECT 1 AS version, * FROM landed WHERE biz_dt < '1998'
    UNION ALL SELECT 2, * REPLACE (o_totalprice + 1 AS o_totalprice) FROM landed""")
def versioned_publish(t):
    """Two versions behind one name; a frame planned on the first still reads all of it after the switch."""
    to, contracts = _published(t), _contracts(t)
    publish_version(contracts.where("biz_dt < '1998'"), to)
    before = read_version(t.spark, to)
    publish_version(contracts.withColumn("o_totalprice", F.col("o_totalprice") + 1), to)
    after = read_version(t.spark, to)
    return before.select(F.lit(1).alias("version"), "*").union(after.select(F.lit(2).alias("version"), "*"))


@query(f"""
    WITH {LANDED}
    SELECT * REPLACE (CASE WHEN biz_dt = '1996' AND biz_status = 'RESIDUAL' THEN 'EXPIRED' ELSE biz_status END AS biz_status)
    FROM landed WHERE o_orderkey >= 0
    UNION ALL SELECT -o_orderkey - 1, o_custkey, o_totalprice, biz_dt, 'NEW' FROM landed WHERE biz_dt = '1997'""")
def indexed_upsert(t):
    """Keys that change their partition and new ones, in a new version that takes the untouched partitions over."""
    to, contracts = _published(t, ("o_orderkey",)), _contracts(t)
    publish_version(contracts, to)
    moved = contracts.where("biz_dt = '1996' AND biz_status = 'RESIDUAL'").withColumn("biz_status", F.lit("EXPIRED"))
    new = contracts.where("biz_dt = '1997'").withColumns({"o_orderkey": -F.col("o_orderkey") - 1, "biz_status": F.lit("NEW")})
    upsert_version(moved.union(new), to)
    return read_version(t.spark, to)


@query(f"""
    WITH {LANDED}
    SELECT biz_dt, biz_status, count(*) AS row_count FROM landed
    WHERE biz_dt >= '1996' AND NOT (biz_dt = '1997' AND biz_status = 'EXPIRED') GROUP BY biz_dt, biz_status""")
def registered_partitions(t):
    """Loads that register what they wrote, without a look at the folders; an emptied partition leaves the catalog."""
    create_database(t.spark, "landing_zone")
    name, path = f"landing_zone.registered_{uuid.uuid4().hex}", scratch_path(t.spark, "registered")
    contracts = _contracts(t)
    create_external_table(t.spark, name, contracts.schema, path, PARTITIONS)
    write_registered(contracts.where("biz_dt >= '1996' AND biz_dt < '1999'"), name, path, PARTITIONS)
    later = contracts.where("biz_dt >= '1999' OR (biz_dt = '1997' AND biz_status <> 'EXPIRED')")
    write_registered(later, name, path, PARTITIONS, emptied=[("1997", "EXPIRED")])
    return partition_counts(t.spark, name, PARTITIONS)


@query(f"""
    WITH {LANDED}
    SELECT biz_dt, biz_status, count(*) AS row_count, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS value,
           CAST(2 - grouping(biz_dt) - grouping(biz_status) AS INTEGER) AS depth
    FROM landed GROUP BY ROLLUP (biz_dt, biz_status)""", name="breakdown_rollup")
def landed_rollup(t):
    """Per date and status, per date, and in all, from one scan of the landed rows."""
    landed = read_orc(t.spark, _landed(t), _contracts(t).schema)
    return breakdown_rollup(landed, PARTITIONS, {"value": F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)")})


@query("""
    SELECT 'o_orderkey' AS by, o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey IN (0, 7, 500, 1499, 14999, 100000007)
    UNION ALL SELECT 'o_custkey', o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_custkey IN (3, 77)""")
def indexed_lookup(t):
    """Contracts by key out of sorted files, and by customer through the filters of the same files."""
    path, contracts = scratch_path(t.spark, "indexed"), t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    write_indexed(contracts, path, ["o_orderkey"], ["o_custkey"])
    wanted = {"o_orderkey": [0, 7, 500, 1499, 14999, 100000007], "o_custkey": [3, 77]}
    by_key, by_customer = (
        look_up(t.spark, path, contracts.schema, key, values).select(F.lit(key).alias("by"), "*") for key, values in wanted.items())
    return by_key.union(by_customer)


LEAST_BUCKETS = 8


@query("""
    SELECT l_orderkey, l_linenumber, l_extendedprice, o_orderdate, c_name, n_name
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey""")
def bucketed_star_join(t):
    """Contracts and transactions landed in buckets of the contract; their join needs no shuffle."""
    create_database(t.spark, "landing_zone")
    buckets = bucket_count(max(t.orders.count(), t.lineitem.count()), LEAST_BUCKETS)
    mark = uuid.uuid4().hex
    contracts, transactions = f"landing_zone.contracts_{mark}", f"landing_zone.transactions_{mark}"
    write_bucketed(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), contracts, ["o_orderkey"], buckets, scratch_path(t.spark, "buckets"))
    moved = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_extendedprice")
    write_bucketed(moved, transactions, ["o_orderkey"], buckets, scratch_path(t.spark, "buckets"))
    joined = read_catalog(t.spark, transactions).join(read_catalog(t.spark, contracts), "o_orderkey")
    customers = Dimension(t.customer, {"o_custkey": "c_custkey"}, ["c_name", "c_nationkey"])
    whole = star_join(joined, [customers, Dimension(t.nation, {"c_nationkey": "n_nationkey"}, ["n_name"])])
    return whole.select(F.col("o_orderkey").alias("l_orderkey"), "l_linenumber", "l_extendedprice", "o_orderdate", "c_name", "n_name")
