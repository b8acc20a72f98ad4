import datetime
import math
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moorline.functions import (
    epoch_micros,
    json_context,
    json_is_malformed,
    micros_to_timestamp,
    run_duration,
    run_key,
    run_status,
    split_list,
    value_or_default,
)
from moorline.operators import (
    RESIDUAL,
    collect_records,
    date_window,
    detect_changes,
    equal_to,
    first_per_key,
    inject_defaults,
    iso_record,
    json_record,
    label_status,
    latest_per_key,
    lookup_join,
    merge_layers,
    partition_breakdown,
    repeated_keys,
    require_params,
    require_values,
    rows_processed,
    settings_maps,
    split_by_status,
    table_sample,
    typed_keys,
    union_outputs,
    unique_per_key,
    unmatched,
    upsert,
    validate_non_null,
    verify_tables,
    without_key,
)

SLOW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# Functions

def test_text_functions(spark):
    df = spark.createDataFrame([(" a, b ,c ", "né", None)], "l STRING, r STRING, n STRING")
    got = df.select(split_list("l"), split_list("n"), F.reverse("r"), F.reverse("n"), F.upper("r")).first()
    assert tuple(got) == (["a", "b", "c"], None, "én", None, "NÉ")


def test_value_or_default(spark):
    df = spark.sql("SELECT map('k', '1', 'z', null) AS m UNION ALL SELECT null")
    assert rows(df.select(value_or_default("m", "k", "9"), value_or_default("m", "q", "9"), value_or_default("m", "z", "9"))) == [
        ("1", "9", "9"), ("9", "9", "9")]


def test_json_context(spark):
    texts = ['{"a": 1, "b": {"c": 2}}', '{"a": ', "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, t STRING")
    got = df.orderBy("i").select(json_context("t").alias("c"), json_is_malformed("t").alias("bad")).collect()
    assert [r.c for r in got] == [{"a": "1", "b": '{"c":2}'}, None, None, None]
    assert [r.bad for r in got] == [False, True, False, False]


def test_times(spark):
    df = spark.sql("SELECT 1700000000123456L AS m").withColumn("t", micros_to_timestamp("m"))
    df = df.withColumn("e", F.col("t") + F.expr("INTERVAL 1 HOUR"))
    assert df.select(epoch_micros("t"), run_duration("t", "e"), run_duration("t", F.lit(None).cast("timestamp"))).first() == (
        1700000000123456, 3_600_000_000, None)


def test_run_key_and_status(spark):
    df = spark.createDataFrame([("J", "R", "Failed", "x" * 900), ("J", "R", "Completed", None)], "j STRING, r STRING, s STRING, e STRING")
    got = df.select(run_key("j", "r", F.lit("1")), run_status("s", "e")).collect()
    assert got[0][0] == got[1][0] and len(got[0][0]) == 64
    assert {r[1] for r in got} == {"Failed: " + "x" * 500, "Completed"}


def test_iso_record_matches_isoformat(spark):
    values = [datetime.datetime(2024, 1, 2, 3, 4, 5), datetime.datetime(2024, 1, 2, 3, 4, 5, 60), datetime.datetime(1969, 7, 20, 0, 0, 0, 999999)]
    df = spark.createDataFrame([(v, v, v.date(), 1, None) for v in values], "a TIMESTAMP_NTZ, b TIMESTAMP, c DATE, n INT, z DATE")
    assert rows(iso_record(df)) == sorted(
        [(v.isoformat(), v.isoformat(), v.date().isoformat(), 1, None) for v in values], key=repr)
    assert json_record(df.limit(1)).first()[0] == (
        '{"a":"2024-01-02T03:04:05","b":"2024-01-02T03:04:05","c":"2024-01-02","n":1,"z":null}')


# Projections and filters

def test_defaults_leave_present_columns(spark):
    df = spark.createDataFrame([(1, "X")], "id INT, BIZ_STATUS STRING")
    assert inject_defaults(df, "d").collect() == [(1, "X", "d", "N")]
    assert rows(inject_defaults(spark.range(1), "d")) == [(0, "d", "active", "N")]


def test_date_window(spark):
    days = [datetime.datetime(2025, 1, 31, 23, 59), datetime.datetime(2025, 2, 1), datetime.datetime(2025, 1, 1), datetime.datetime(2024, 12, 31)]
    df = spark.createDataFrame([(d, d.date(), d.date().isoformat()) for d in days], "ts TIMESTAMP_NTZ, d DATE, s STRING")
    for column in df.columns:
        assert date_window(df, column, "2025-01-01", datetime.date(2025, 1, 31)).count() == 2
    with pytest.raises(ValueError):
        date_window(df, "d", "2026-02-31", "2026-03-01")


def test_equal_to_needs_values():
    with pytest.raises(ValueError):
        equal_to({})


def test_required_parameters(spark):
    require_params({"biz_dt": "2025-05-31"})
    with pytest.raises(ValueError, match="biz_dt"):
        require_params({"biz_dt": ""})
    df = spark.createDataFrame([("a",), (None,)], "biz_dt STRING")
    assert require_values(df.where("biz_dt IS NOT NULL")).collect() == [("a",)]
    with pytest.raises(Exception, match="missing required parameter: biz_dt"):
        require_values(df).collect()


# Split and union

@SLOW
@given(st.lists(st.sampled_from(["o", "O", "f", "F", "p", "", None]), max_size=30))
def test_split_holds_each_row_once(spark, statuses):
    df = spark.createDataFrame(list(enumerate(statuses)), "id INT, status STRING")
    frames = split_by_status(df, "status", {"ACTIVE": ["O"], "EXPIRED": ["f"]})
    got = union_outputs(list(frames.values()))
    assert sorted(r.id for r in got.collect()) == list(range(len(statuses)))
    want = Counter({"o": "ACTIVE", "f": "EXPIRED"}.get((s or "").lower(), RESIDUAL) for s in statuses)
    assert Counter(r.biz_status for r in got.collect()) == want


def test_split_refuses_overlaps(spark):
    with pytest.raises(ValueError, match="one output only"):
        label_status(spark.range(1), "id", {"A": ["x"], "B": ["X"]})


def test_union_refuses_other_columns(spark):
    with pytest.raises(Exception):
        union_outputs([spark.range(1), spark.range(1).selectExpr("id", "id AS extra")])


def test_breakdown(spark):
    df = spark.createDataFrame([("d", "ACTIVE"), ("d", "EXPIRED"), ("d", None), ("e", "ACTIVE")], "biz_dt STRING, s STRING")
    assert rows(partition_breakdown(df, ["biz_dt"], "s", ["ACTIVE", "EXPIRED"])) == [("d", 3, 1, 1), ("e", 1, 1, 0)]
    assert rows_processed(df) == 4


# Joins

def test_lookup_join(spark):
    main = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k INT, v STRING")
    lookup = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z"), (None, "n")], "k INT, w STRING")
    assert rows(lookup_join(main, lookup, ["k"])) == [(1, "a", "x"), (1, "a", "y")]
    assert rows(unmatched(main, lookup, ["k"])) == [(2, "b"), (None, "c")]
    assert rows(repeated_keys(lookup, ["k"])) == [(1, 2)]
    assert lookup_join(main, lookup.withColumnRenamed("k", "q"), {"k": "q"}, []).columns == ["k", "v"]
    assert rows(lookup_join(main, main.select("k", F.upper("v").alias("u")), ["k"])) == [(1, "a", "A"), (2, "b", "B")]


def test_typed_keys(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,), (" 2 ",)], "k STRING")
    good, bad = typed_keys(df, {"k": "bigint"})
    assert rows(good) == sorted([(1,), (None,), (2,)], key=repr) and rows(bad) == [("x",)]


# Latest, layers, upsert, changes

def test_latest_is_total_and_keeps_nulls(spark):
    data = [("k", 1, "b", 1.0), ("k", 1, "c", 2.0), ("k", None, "z", 9.0), (None, 5, "n", 0.0)]
    df = spark.createDataFrame(data, "k STRING, t INT, v STRING, x DOUBLE")
    for frame in (df, df.orderBy(F.desc("v")), df.repartition(4)):
        assert rows(latest_per_key(frame, ["k"], ["t"])) == sorted([("k", 1, "c", 2.0), (None, 5, "n", 0.0)], key=repr)
    assert rows(first_per_key(df.where("k = 'k'"), ["k"], ["t"])) == [("k", None, "z", 9.0)]


def test_latest_carries_maps(spark):
    df = spark.sql("SELECT 1 AS k, id AS t, map('id', id) AS m FROM range(3)")
    assert latest_per_key(df, ["k"], ["t"]).collect() == [(1, 2, {"id": 2})]


def test_merge_layers(spark):
    def layer(*pairs):
        return spark.createDataFrame(list(pairs), "k STRING, v STRING")

    got = merge_layers({"table": layer(("a", "1"), ("b", None)), "env": layer(("b", "2"), ("a", "0")), "default": layer(("c", "3"))}, ["k"], "v")
    assert rows(got) == [("a", "1", "table"), ("b", "2", "env"), ("c", "3", "default")]


KEYED = "k INT, v STRING, t INT"


def test_upsert(spark):
    base = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (None, "n", 0)], KEYED)
    updates = spark.createDataFrame([(2, "old", 1), (2, "new", 2), (3, "c", 1), (None, "m", 1)], KEYED)
    once = upsert(base, updates, ["k"], ["t"])
    assert rows(once) == sorted([(1, "a", 0), (2, "new", 2), (3, "c", 1), (None, "m", 1)], key=repr)
    assert rows(upsert(once, updates, ["k"], ["t"])) == rows(once)
    with pytest.raises(Exception, match=r"duplicate key \(k\): 2"):
        upsert(base, updates, ["k"]).collect()
    assert upsert(base, updates.where("k = 3"), ["k"]).count() == 4


def test_upsert_of_a_frame_from_itself(spark):
    base = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], KEYED)
    raised = base.where("k = 2").withColumn("v", F.upper("v"))
    assert rows(upsert(base, raised, ["k"])) == [(1, "a", 0), (2, "B", 0)]


def test_unique_per_key(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], KEYED)
    assert rows(unique_per_key(df, ["k"])) == rows(df)


def test_changes(spark):
    previous = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, None, 0), (4, "d", 0)], KEYED)
    current = spark.createDataFrame([(1, "a", 9), (2, "x", 0), (3, None, 0), (5, None, 0)], KEYED)
    got = {r.k: (r.v, r.change_type, r.change_indicator) for r in detect_changes(previous, current, ["k"], ["v"]).collect()}
    assert got == {1: ("a", "N", "N"), 2: ("x", "U", "Y"), 3: (None, "N", "N"), 4: ("d", "D", "Y"), 5: (None, "I", "Y")}
    assert {r.k for r in detect_changes(previous, current, ["k"], partial_load=True).collect()} == {1, 2, 3, 5}
    assert {r.k: r.change_type for r in detect_changes(previous, current, ["k"]).collect()}[1] == "U"


def test_changes_of_a_frame_against_itself(spark):
    values = [math.nan, -0.0, 0.0, None, 1.5]
    df = spark.createDataFrame(list(enumerate(values)), "k INT, x DOUBLE")
    assert {r.change_type for r in detect_changes(df, df, ["k"]).collect()} == {"N"}
    flipped = df.withColumn("x", F.when(F.col("x") == 0, -F.col("x")).otherwise(F.col("x")))
    assert {r.change_type for r in detect_changes(df, flipped, ["k"]).collect()} == {"N"}


def test_frames_of_keys_only(spark):
    left, right = spark.range(3).toDF("k"), spark.range(2, 5).toDF("k")
    assert {r.k: r.change_type for r in detect_changes(left, right, ["k"]).collect()} == {0: "D", 1: "D", 2: "N", 3: "I", 4: "I"}
    assert rows(upsert(left, right, ["k"])) == [(k,) for k in range(5)]


def test_changes_refuse_repeated_keys(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "b", 0)], KEYED)
    for previous, current in ((df, df.limit(1)), (df.limit(1), df)):
        with pytest.raises(Exception, match="duplicate key"):
            detect_changes(previous, current, ["k"]).collect()


# Arrays and maps

def collected(df):
    return Counter((r.k, tuple(record)) for r in df.collect() for record in r.records)


def test_records_are_sorted_in_each_part(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (None, "z")], "k INT, v STRING")
    got = {r.k: (r.part, [x.v for x in r.records]) for r in collect_records(df, ["k"], ["v"], parts=1).collect()}
    assert got == {1: (0, ["a", "a", "b"]), None: (0, ["z"])}


@pytest.mark.parametrize("parts", [1, 8, 100])
def test_records_of_a_hot_key_are_the_same_for_any_parts(spark, parts):
    """A hot key, a hot null key, and a hot group of copies; brute force over the same rows."""
    data = [(1, i) for i in range(3000)] + [(None, i) for i in range(1500)] + [(2, 7)] * 2500 + [(k, 0) for k in range(10, 60)]
    df = spark.createDataFrame(data, "k INT, v INT").repartition(7)
    got = collect_records(df, ["k"], ["v"], parts)
    assert collected(got) == Counter((k, (v,)) for k, v in data)
    assert max(Counter(r.k for r in got.collect()).values()) <= parts
    assert all(r.records == sorted(r.records) for r in got.collect())


def test_settings_maps(spark):
    data = [("g", "a", "1", 1), ("g", "a", "2", 2), ("g", "b", None, 1), ("h", "a", "3", 1), ("h", None, "4", 1)]
    df = spark.createDataFrame(data, "g STRING, param_key STRING, param_value STRING, t INT")
    assert {r.g: r.settings for r in settings_maps(df, ["g"], 1, order_by=["t"]).collect()} == {"g": {"a": "2", "b": None}, "h": {"a": "3"}}
    assert [r.param_value for r in without_key(df).collect()] == ["4"]
    wide = spark.range(500).selectExpr("'g' AS g", "cast(id AS string) AS param_key", "'v' AS param_value")
    parts = settings_maps(wide, ["g"], 16).collect()
    assert 1 < len(parts) <= 16 and sorted(int(k) for r in parts for k in r.settings) == list(range(500))


def test_guards_hold_in_every_plan(spark):
    """Counting, projecting and joining read none of the guarded columns and still raise."""
    twice = spark.createDataFrame([(1, "a", 0), (1, "b", 0)], KEYED)
    once = spark.createDataFrame([(1, "a", 0)], KEYED)
    holes = spark.createDataFrame([(1, None), (2, "d")], "x INT, biz_dt STRING")
    frames = {
        "duplicate key": [unique_per_key(twice, ["k"]), upsert(once, twice, ["k"]), detect_changes(once, twice, ["k"]), detect_changes(twice, once, ["k"])],
        "missing required": [require_values(holes)],
    }
    for message, guarded in frames.items():
        for df in guarded:
            first = df.columns[0]
            other = spark.range(5).select(F.col("id").cast("int").alias(first))
            for plan in (df.select(F.lit(1)), df.groupBy().count(), df.select(first), df.select(first).join(other, first), df.limit(5)):
                with pytest.raises(Exception, match=message):
                    plan.collect()
            with pytest.raises(Exception, match=message):
                df.count()


# Quality

def test_validate_non_null(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a INT, b STRING")
    assert rows(validate_non_null(df, ["a", "b"])) == [("a", 0, True), ("b", 1, False)]


def test_verify_tables_contains_errors(spark, tmp_path):
    (tmp_path / "part-0.parquet").write_bytes(b"no parquet at all")
    broken = str(tmp_path)
    report = verify_tables(spark, {
        "good": lambda: spark.range(4), "absent": lambda: spark.table("no_such_table"), "broken": lambda: spark.read.parquet(broken),
        "declared": lambda: spark.read.schema("a INT").parquet(broken), "last": lambda: spark.range(1),
    }, sample=2, order_by={"good": ["id"]})
    got = {r.table_name: (r.row_count, r.table_schema, r.sample, r.error) for r in report.collect()}
    assert got["good"] == (4, "struct<id:bigint>", ['{"id":0}', '{"id":1}'], None) and got["last"][0] == 1
    assert got["absent"] == (None, None, None, "TABLE_OR_VIEW_NOT_FOUND")
    assert all(got[name][:3] == (None, None, None) and got[name][3] for name in ("broken", "declared"))


def test_table_sample(spark):
    assert table_sample(spark.range(10), 3, [F.desc("id")]).collect() == [(9,), (8,), (7,)]
    assert table_sample(spark.range(10)).count() == 5
