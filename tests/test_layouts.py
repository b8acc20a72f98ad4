"""Sorted and bucketed landings, subtotals, contexts parsed once, tables verified at the same time."""

import threading
import uuid

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from moorline.functions import context_field, context_map, malformed, parsed_json
from moorline.operators import breakdown_rollup, verify_tables
from moorline.sinks import write_bucketed, write_indexed
from moorline.sources import look_up

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned_rows(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_reads_a_few_row_groups(spark, tmp_path):
    path, schema = str(tmp_path / "indexed"), "key BIGINT, other BIGINT, body STRING"
    # Keys in no order at all; one in three rows has the same key.
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.pmod(F.xxhash64("id"), F.lit(1 << 40))).alias("key"),
        F.when(F.col("id") == 777, -5).otherwise(F.col("id")).alias("other"), F.col("id").cast("string").alias("body"))
    write_indexed(rows, path, ["key"], ["other"], opts={"orc.row.index.stride": "1000"})
    wanted = [r.key for r in rows.where("id IN (1, 40000)").collect()]
    found = look_up(spark, path, schema, "key", wanted)
    assert sorted(r.body for r in found.collect()) == ["1", "40000"]
    assert scanned_rows(found) <= 4000
    # The other column is in no order; its Bloom filters tell the one row group that may have the value.
    by_other = look_up(spark, path, schema, "other", [-5])
    assert [r.body for r in by_other.collect()] == ["777"] and scanned_rows(by_other) <= 4000
    assert look_up(spark, path, schema, "key", [-1]).count() == 20_000
    assert look_up(spark, path, schema, "key", [5]).count() == look_up(spark, path, schema, "key", []).count() == 0


def test_buckets_join_and_group_without_a_shuffle(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS layouts")
    names = [f"layouts.t_{uuid.uuid4().hex}" for _ in range(2)]
    for i, name in enumerate(names):
        frame = spark.range(1000).select((F.col("id") % 50).alias("key"), (F.col("id") + i).alias(f"v{i}"))
        write_bucketed(frame, name, ["key"], 4, str(tmp_path / str(i)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = map(spark.table, names)
        joined = left.join(right, "key").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
        assert {(r.key, r.n) for r in joined.collect()} == {(k, 400) for k in range(50)}
        text = plan(queries()["bucketed_star_join"](spark, FOLDER))
        join = text[text.index("SortMergeJoin [o_orderkey"):]
        # Both sides of the innermost join are bucketed scans; what follows deals out customers.
        assert join.count("Bucketed: true") == 2 and "Exchange" not in join[:join.index("Bucketed: true")]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_buckets_grow_in_number_with_the_rows(spark, tmp_path, monkeypatch):
    """Else the memory that a task sorts its bucket in grows with the tables."""
    monkeypatch.setattr("moorline.sinks.write.ROWS_PER_BUCKET", 100)
    orders = "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP"
    tables = {
        "orders": spark.createDataFrame([(i, i % 3, None) for i in range(300)] + [(None, 1, None), (7, 2, None)], orders),
        "lineitem": spark.range(1150).selectExpr("IF(id < 900, id % 400, NULL) AS l_orderkey", "CAST(id AS INT) AS l_linenumber", "1.0D AS l_extendedprice"),
        "customer": spark.createDataFrame([(0, "a", 5), (1, "b", 5), (2, "c", None)], "c_custkey BIGINT, c_name STRING, c_nationkey BIGINT"),
        "nation": spark.createDataFrame([(5, "n")], "n_nationkey BIGINT, n_name STRING"),
    }
    for name, table in tables.items():
        table.write.parquet(f"{tmp_path}/{name}.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = queries()["bucketed_star_join"](spark, str(tmp_path))
        assert plan(joined).count("out of 12") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = sum(1 for i in range(900) if i % 400 < 300 and i % 400 % 3 < 2)
    assert {(r.c_name, r.n_name) for r in joined.collect()} == {("a", "n"), ("b", "n")} and joined.count() == want


def test_subtotals_take_one_scan_and_one_shuffle(spark):
    rows = [("d1", "A", 1), ("d1", "A", 2), ("d1", None, 3), (None, "A", 4), (None, None, 5)]
    frame = spark.createDataFrame(rows, "day STRING, status STRING, v INT")
    got = breakdown_rollup(frame, ["day", "status"], {"total": F.sum("v")})
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        ("d1", "A", 2, 3, 2), ("d1", None, 1, 3, 2), (None, "A", 1, 4, 2), (None, None, 1, 5, 2),
        ("d1", None, 3, 6, 1), (None, None, 2, 9, 1), (None, None, 5, 15, 0)], key=str)
    text = plan(queries()["breakdown_rollup"](spark, FOLDER))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


@pytest.mark.parametrize("text, fields, bad", [
    ('{"a": 1, "b": {"c": 2}}', {"a": "1", "b": '{"c":2}'}, False), ('{"a": null}', {"a": None}, False), ("[1, 2]", None, False),
    ('"text"', None, False), ("null", None, False), ('{"a": ', None, True), ('{"a": 1, "a": 2}', None, True), ("  ", None, False), (None, None, False),
])
def test_contexts(spark, text, fields, bad):
    frame = spark.createDataFrame([(text,)], "t STRING").withColumn("v", parsed_json("t"))
    assert frame.select(context_map("v"), malformed("t", "v")).first() == (fields, bad)


def test_fields_have_types_and_odd_names(spark):
    frame = spark.createDataFrame([('{"n": 7, "s": "7", "it\'s a.b": true}',)], "t STRING").select(parsed_json("t").alias("v"))
    got = frame.select(context_field("v", "n", "int"), context_field("v", "s"), context_field("v", "it's a.b", "boolean"), context_field("v", "none"))
    assert got.first() == (7, "7", True, None)


@pytest.mark.parametrize("name", ["flattened_params", "variant_context"])
def test_a_context_is_parsed_once(spark, name):
    assert plan(queries()[name](spark, FOLDER)).count("parseJson") == 1


def test_tables_are_verified_at_the_same_time(spark):
    both = threading.Barrier(2, timeout=60)

    def table(n):
        def load():
            both.wait()  # Passes only if two tables are opened at once.
            seen.append(spark.sparkContext.getLocalProperty("spark.scheduler.pool"))
            return spark.range(n)
        return load

    seen = []
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", "checks")
    try:
        rows = verify_tables(spark, {"a": table(10_000), "b": table(3)}, sample=2, order_by={"a": ["id"], "b": ["id"]}, at_once=2).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
    assert [(r.table_name, r.row_count, r.sample) for r in rows] == [("a", 10_000, ['{"id":0}', '{"id":1}']), ("b", 3, ['{"id":0}', '{"id":1}'])]
    assert seen == ["checks", "checks"]


def test_an_unordered_sample_does_not_shorten_the_count(spark):
    row = verify_tables(spark, {"wide": lambda: spark.range(0, 100_000, 1, 16), "none": lambda: spark.createDataFrame([], "a INT")}, sample=3).collect()
    assert [(r.row_count, len(r.sample)) for r in row] == [(100_000, 3), (0, 0)]
