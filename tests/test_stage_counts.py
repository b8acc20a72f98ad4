"""Counts of every stage, taken from the one execution that writes the last."""

import uuid

import pytest

from moorline.plans import Stage, StageCounts, land, run_stages
from moorline.sources import Source

ORDERS = "/root/testdata/sf0.001/orders.parquet"
STAGES = [
    Stage("counted_open", sql="SELECT o_orderkey, o_custkey, o_orderstatus FROM counted_orders WHERE o_totalprice > 1000"),
    Stage("counted_customers", sql="SELECT o_custkey, count(*) AS orders FROM counted_open GROUP BY o_custkey"),
    Stage("counted_joined", sql="SELECT * FROM counted_open JOIN counted_customers USING (o_custkey)"),
]


def jobs_of(spark, action):
    """The number of jobs that ``action`` runs."""
    tracker, group = spark.sparkContext.statusTracker(), uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "")
    try:
        action()
        return len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_counts_come_with_the_write(spark, tmp_path):
    spark.read.parquet(ORDERS).createOrReplaceTempView("counted_orders")
    plain, counts = run_stages(spark, STAGES), StageCounts()
    want = {name: df.count() for name, df in plain.items()}
    counted = run_stages(spark, STAGES, counts=counts)["counted_joined"]
    assert counts.rows == {}
    jobs = jobs_of(spark, lambda: counted.write.parquet(str(tmp_path / "counted")))
    counts.settle(counted)
    assert counts.rows == want
    # Counting adds no job to those of the same write without it.
    assert jobs == jobs_of(spark, lambda: plain["counted_joined"].write.parquet(str(tmp_path / "plain")))
    assert [tuple(r) for r in counts.table(spark).orderBy("place").collect()] == [(i, *x) for i, x in enumerate(want.items(), 1)]


def test_each_source_is_scanned_once_a_use(spark):
    spark.read.parquet(ORDERS).createOrReplaceTempView("counted_orders")
    frame = run_stages(spark, STAGES[:2], counts=StageCounts())["counted_customers"]
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and text.count("CollectMetrics") == 2
    # Columns that no stage asks for stay out of the scan.
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in text


def test_empty_stages_count_zero(spark, tmp_path):
    spark.read.parquet(ORDERS).createOrReplaceTempView("counted_orders")
    stages = [STAGES[0], Stage("counted_none", sql="SELECT * FROM counted_open WHERE o_orderstatus = 'no such'"),
              Stage("counted_with", sql="SELECT counted_none.* FROM counted_open JOIN counted_none USING (o_orderkey)")]
    counts = StageCounts()
    last = run_stages(spark, stages, counts=counts)["counted_with"]
    last.write.parquet(str(tmp_path / "none"))
    counts.settle(last)
    assert counts.rows["counted_none"] == counts.rows["counted_with"] == 0


def test_stages_that_lead_nowhere_have_no_count(spark, tmp_path):
    counts = StageCounts()
    stages = [
        Stage("landed_a", sql="SELECT o_orderkey, 'ACTIVE' AS biz_status FROM landing_orders WHERE o_orderstatus = '${status}'"),
        Stage("landed_b", sql="SELECT o_orderkey FROM landed_a WHERE o_orderkey < 0"),
    ]
    rows = land(spark, {"landing_orders": Source(ORDERS)}, stages, str(tmp_path / "landed"),
                {"biz_dt": "2025-05-31", "status": "O"}, outputs=["landed_a"], counts=counts)
    assert counts.rows == {"landed_a": rows, "landed_b": None} and rows > 0


def test_a_stage_is_counted_once(spark):
    counts = StageCounts()
    counts.watch("same", spark.range(3))
    with pytest.raises(ValueError, match="same"):
        counts.watch("same", spark.range(3))
