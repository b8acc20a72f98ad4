"""Hot keys: a third of all rows under one key, with thresholds scaled down to test data."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from moorline.operators import latest_per_key, lookup_join, unmatched, upsert

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextmanager
def conf(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def flow(spark):
    return spark.range(0, 90_000, 1, 12).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("row"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(0, 90_000, 2, 4).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).unionByName(
        spark.sql("SELECT 7L AS k, 14L AS v"))


def final_plan(df):
    total = df.agg(F.count(F.lit(1)), F.sum("row")).collect()[0]
    execution = df._jdf.queryExecution()
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return tuple(total), execution.executedPlan().toString()


@pytest.mark.parametrize("build", [
    lambda flow, lookup: lookup_join(flow, lookup, ["k"]),
    lambda flow, lookup: unmatched(flow, lookup, ["k"]),
    lambda flow, lookup: upsert(flow, lookup.select("k", F.col("v").alias("row"), F.lit("p").alias("pad")), ["k"], ["row"]),
])
def test_a_hot_key_is_split(spark, flow, lookup, build):
    with conf(spark, {**SMALL, "spark.sql.adaptive.enabled": "false"}):
        want = tuple(build(flow, lookup).agg(F.count(F.lit(1)), F.sum("row")).first())
    with conf(spark, SMALL):
        got, text = final_plan(build(flow, lookup))
    assert got == want
    assert "skew=true" in text


def test_a_grouping_after_the_join_keeps_the_split_under_a_profile(spark, flow, lookup):
    """Without the profile's setting a grouping on the join key would keep the hot key in one task."""
    grouped = {"spark.sql.adaptive.forceOptimizeSkewedJoin": "true"}
    with conf(spark, {**SMALL, **grouped}):
        df = lookup_join(flow, lookup, ["k"]).groupBy("k").agg(F.sum("row").alias("row"))
        _, text = final_plan(df)
    assert "skew=true" in text


def test_latest_sends_one_row_per_key_and_task(spark, flow):
    df = latest_per_key(flow, ["k"], ["row"])
    assert df.where("k = 7").collect()[0].row == 89_997
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning")
