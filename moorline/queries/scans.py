"""Source queries: each format is written by Spark from a given table and scanned back."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moorline.queries.registry import query
from moorline.session import scratch_path
from moorline.sinks import write_df
from moorline.sources import (
    BAD_RECORD,
    Source,
    csv_to_orc,
    read_any,
    read_control_table,
    read_csv,
    read_inferred_csv,
    read_json,
    read_key_values,
    read_parquet,
    read_quarantined,
    register_sources,
    split_bad_records,
    write_with_quarantine,
)

ALL_ORDERS = "SELECT * FROM orders"


def _landed(t, df, fmt, **opts):
    path = scratch_path(t.spark, fmt)
    write_df(df, path, mode="overwrite", fmt=fmt, opts=opts)
    return path


@query(ALL_ORDERS)
def csv_roundtrip(t):
    return read_csv(t.spark, _landed(t, t.orders, "csv", header="true"), t.orders.schema)


@query("""
    SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, o_totalprice, o_orderstatus,
           CAST(o_orderdate AS DATE) AS biz_dt FROM orders""")
def csv_inferred(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus", F.col("o_orderdate").cast("date").alias("biz_dt"))
    return read_inferred_csv(t.spark, _landed(t, rows, "csv", header="true"))


@query(ALL_ORDERS)
def json_roundtrip(t):
    return read_json(t.spark, _landed(t, t.orders, "json"), t.orders.schema)


@query(ALL_ORDERS, name="csv_to_orc")
def csv_to_orc_conversion(t):
    source = _landed(t, t.orders, "csv", header="true")
    return csv_to_orc(t.spark, source, scratch_path(t.spark, "orc"), t.orders.schema)


@query("SELECT * FROM customer")
def parquet_scan(t):
    return read_parquet(t.spark, t.path("customer"))


@query("""
    SELECT n_name, count(*) AS customers FROM customer JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey GROUP BY n_name""")
def named_sources(t):
    register_sources(t.spark, {
        "customers": Source(t.path("customer")),
        "portfolio": Source(_landed(t, t.nation, "csv", header="true"), "csv", t.nation.schema),
        "areas": Source(_landed(t, t.region, "orc"), "orc"),
    })
    return t.spark.sql("""
        SELECT n_name, count(*) AS customers FROM customers JOIN portfolio ON n_nationkey = c_nationkey
        JOIN areas ON r_regionkey = n_regionkey GROUP BY n_name""")


@query("SELECT * FROM orders WHERE o_orderstatus = 'P'")
def control_table_scan(t):
    return read_control_table(t.spark, t.path("orders"), filters={"o_orderstatus": "P"})


@query("""
    SELECT p_name AS param_key, p_type AS param_value FROM part
    WHERE p_brand = 'Brand#2' AND p_type = 'PROMO'""")
def key_value_scan(t):
    chosen = {"p_brand": "Brand#2", "p_type": "PROMO"}
    return read_key_values(t.spark, chosen, fmt="parquet", location=t.path("part"), key="p_name", value="p_type")


@query(" UNION ALL ".join(f"SELECT *, '{fmt}' AS fmt FROM supplier" for fmt in ("csv", "json", "orc", "parquet")))
def extension_dispatch(t):
    """The same rows behind each suffix."""
    frames = []
    for fmt in ("csv", "json", "orc", "parquet"):
        path = f"{scratch_path(t.spark, fmt)}.{fmt}"
        write_df(t.supplier, path, mode="overwrite", fmt=fmt, opts={"header": "true"} if fmt == "csv" else None)
        frames.append(read_any(t.spark, path, t.supplier.schema).withColumn("fmt", F.lit(fmt)))
    return reduce(DataFrame.unionByName, frames)


# Order lines as text: residual orders have a bad amount, low priority ones a field too
# few, urgent ones a field too many.
LINES = """
    SELECT concat_ws(',', o_orderkey, o_custkey, o_orderstatus) ||
           CASE WHEN o_orderstatus = 'P' THEN ',n/a' WHEN o_orderpriority = '5-LOW' THEN ''
                WHEN o_orderpriority = '1-URGENT' THEN ',' || CAST(floor(o_totalprice) AS BIGINT) || ',extra'
                ELSE ',' || CAST(floor(o_totalprice) AS BIGINT) END AS line,
           o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderstatus <> 'P' AND o_orderpriority NOT IN ('5-LOW', '1-URGENT') AS good
    FROM orders"""
LINE_SCHEMA = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, amount BIGINT"

QUARANTINE = f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN good THEN CAST(floor(o_totalprice) AS BIGINT) END AS amount,
           CASE WHEN NOT good THEN line END AS raw FROM ({LINES})"""


def _line_scan(t):
    t.orders.createOrReplaceTempView("order_rows")
    lines = t.spark.sql(LINES.replace("FROM orders", "FROM order_rows"))
    path = _landed(t, lines.select("line"), "text")
    return read_quarantined(t.spark, path, LINE_SCHEMA, opts={"header": "false"})


def _both_sides(good, bad):
    head = ["o_orderkey", "o_custkey", "o_orderstatus"]
    good = good.select(*head, "amount", F.lit(None).cast("string").alias("raw"))
    return good.unionByName(bad.select(*head, F.lit(None).cast("bigint").alias("amount"), F.col(BAD_RECORD).alias("raw")))


@query(QUARANTINE)
def bad_row_split(t):
    return _both_sides(*split_bad_records(_line_scan(t)))


@query(QUARANTINE)
def bad_row_quarantine(t):
    return _both_sides(*write_with_quarantine(_line_scan(t), scratch_path(t.spark, "quarantine")))


# The same for JSON: residual orders are cut off in the middle.
JSON_LINES = """
    SELECT '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus ||
           CASE WHEN o_orderstatus = 'P' THEN '' ELSE '"}' END AS line, o_orderkey, o_orderstatus FROM orders"""


@query(f"""
    SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS o_orderkey,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderstatus = 'P' THEN line END AS raw FROM ({JSON_LINES})""")
def json_quarantine(t):
    t.orders.createOrReplaceTempView("order_rows")
    lines = t.spark.sql(JSON_LINES.replace("FROM orders", "FROM order_rows")).select("line")
    rows = read_quarantined(t.spark, _landed(t, lines, "text"), "o_orderkey BIGINT, o_orderstatus STRING", fmt="json")
    good, bad = write_with_quarantine(rows, scratch_path(t.spark, "quarantine"))
    empty = [F.lit(None).cast("bigint").alias("o_orderkey"), F.lit(None).cast("string").alias("o_orderstatus")]
    return good.withColumn("raw", F.lit(None).cast("string")).unionByName(bad.select(*empty, F.col(BAD_RECORD).alias("raw")))
