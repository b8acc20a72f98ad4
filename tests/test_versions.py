"""Versions of a published dataset behind one catalog name."""

import os
import random
import shutil
import uuid

import pytest
from pyspark.sql.types import StructType

from moorline.session import scratch_path
from moorline.sinks import (
    Published,
    create_database,
    create_external_table,
    current_version,
    drop_versions,
    point_at,
    publish_version,
    published_partitions,
    read_version,
    upsert_version,
    versions,
    write_partitions,
    write_registered,
)

SCHEMA = StructType().add("id", "long").add("amount", "double").add("region", "string").add("day", "string")


@pytest.fixture
def to(spark):
    create_database(spark, "versions")
    return Published(f"versions.t_{uuid.uuid4().hex}", scratch_path(spark, "versions"), SCHEMA, ("region", "day"), ("id",))


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def folders(spark, to, version):
    return {tuple(m["partition"]): m["folder"] for m in spark.read.parquet(to.manifest(version)).collect()}


FIRST = [(1, 1.0, "a", "x"), (2, 2.0, "a", "y"), (3, 3.0, "b", "x"), (4, 4.0, None, "it's \\ / é"), (5, 5.0, "", "x")]
# The writers store an empty partition value as none.
STORED = [(*r[:2], r[2] or None, r[3]) for r in FIRST]


def test_a_planned_frame_keeps_its_version(spark, to):
    publish_version(frame(spark, FIRST), to)
    before = read_version(spark, to)
    written = publish_version(frame(spark, FIRST[:1]), to)
    assert written.rows == 1 and written.partitions == [("a", "x")]
    assert found(before) == sorted(STORED, key=str)
    assert found(read_version(spark, to)) == found(read_version(spark, to, 2)) == FIRST[:1]
    point_at(spark, to, 1)
    assert found(read_version(spark, to)) == sorted(STORED, key=str)
    with pytest.raises(ValueError, match="no version 9"):
        point_at(spark, to, 9)


def test_a_run_that_stops_before_the_switch_changes_nothing(spark, to, monkeypatch):
    publish_version(frame(spark, FIRST), to)

    def stop(*_):
        raise KeyboardInterrupt

    seen = []
    with monkeypatch.context() as patch:
        # All partitions of the new version are registered by now, and no reader sees any of them.
        patch.setattr(versions, "point_at", lambda *a: seen.append(found(read_version(spark, to))) or stop())
        for change in (lambda: publish_version(frame(spark, []), to), lambda: upsert_version(frame(spark, [(1, 9.0, "b", "x"), (3, 9.0, "a", "x")]), to)):
            with pytest.raises(KeyboardInterrupt):
                change()
    assert seen == [sorted(STORED, key=str)] * 2 and current_version(spark, to) == 1
    upsert_version(frame(spark, [(1, 9.0, "b", "x")]), to)
    assert current_version(spark, to) == 4
    assert found(read_version(spark, to)) == sorted([(1, 9.0, "b", "x"), *STORED[1:]], key=str)


def test_runs_at_the_same_time_lose_nothing(spark, to, monkeypatch):
    publish_version(frame(spark, FIRST), to)
    switch, other = versions._switch, []

    def late(*args):
        if not other:
            other.append(True)
            publish_version(frame(spark, FIRST[:2]), to)
        switch(*args)

    monkeypatch.setattr(versions, "_switch", late)
    with pytest.raises((RuntimeError, FileExistsError)):
        upsert_version(frame(spark, [(3, 9.0, "b", "x")]), to)
    assert found(read_version(spark, to)) == FIRST[:2]


def test_untouched_partitions_are_not_opened_and_stay_where_they_are(spark, to):
    rows = [(i, float(i), f"r{i % 7}", f"d{i % 3}") for i in range(210)]
    publish_version(frame(spark, rows), to)
    first = folders(spark, to, 1)
    # Key 5 lives in (r5, d2) and moves to (r0, d0); every other partition is unreadable.
    touched = {("r5", "d2"), ("r0", "d0")}
    for values, folder in first.items():
        if values not in touched:
            for name in os.listdir(folder.removeprefix("file:")):
                if name.endswith(".orc"):
                    with open(os.path.join(folder.removeprefix("file:"), name), "wb") as file:
                        file.write(b"broken")
    written = upsert_version(frame(spark, [(5, 99.0, "r0", "d0")]), to)
    assert set(written.partitions) == touched
    second = folders(spark, to, 2)
    assert {v for v in first if first[v] != second[v]} == touched and set(first) == set(second)
    got = found(read_version(spark, to).where("(region = 'r0' AND day = 'd0') OR (region = 'r5' AND day = 'd2')"))
    want = [r for r in rows if r[2:] in touched and r[0] != 5] + [(5, 99.0, "r0", "d0")]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("bits", [1 << 26, 64, 1])
def test_upserts_match_brute_force_however_coarse_the_index(spark, to, bits):
    rng = random.Random(bits)
    to = Published(to.name, to.root, to.schema, to.partitionBy, to.keys, bits)
    state = {i: (i, float(i), rng.choice(["a", "b", None]), rng.choice("xyz")) for i in range(60)}
    publish_version(frame(spark, list(state.values())), to)
    for turn in range(3):
        change = {i: (i, 1000.0 + turn, rng.choice(["a", "b", None, "new"]), rng.choice("xyz")) for i in rng.sample(range(90), 8)}
        upsert_version(frame(spark, list(change.values())), to)
        state |= change
        assert found(read_version(spark, to)) == sorted(state.values(), key=str)
    assert current_version(spark, to) == 4


def test_a_partition_that_all_rows_leave_is_gone(spark, to):
    publish_version(frame(spark, FIRST), to)
    upsert_version(frame(spark, [(3, 3.5, "a", "x")]), to)
    assert ("b", "x") not in folders(spark, to, 2)
    listed = spark.sql(f"SHOW PARTITIONS {to.table(2)}").collect()
    assert len(listed) == len(folders(spark, to, 2)) and "region=b/day=x" not in {r.partition for r in listed}


def test_repeated_and_empty_updates(spark, to):
    twice = frame(spark, [(1, 7.0, "a", "x"), (1, 8.0, "a", "y")])
    upsert_version(twice.withColumn("at", twice.amount), to, order_by=["at"])
    assert found(read_version(spark, to)) == [(1, 8.0, "a", "y")]
    with pytest.raises(Exception, match="duplicate key"):
        upsert_version(twice, to)
    assert upsert_version(frame(spark, []), to).rows == 0
    assert found(read_version(spark, to)) == [(1, 8.0, "a", "y")]
    with pytest.raises(ValueError, match="no indexed keys"):
        upsert_version(twice, Published(to.name, to.root, SCHEMA, to.partitionBy))


def test_old_versions_go_and_shared_folders_stay(spark, to):
    publish_version(frame(spark, FIRST), to)
    for amount in (10.0, 20.0, 30.0):
        upsert_version(frame(spark, [(1, amount, "a", "x")]), to)
    assert drop_versions(spark, to, keep=2) == [1, 2]
    assert found(read_version(spark, to)) == sorted([(1, 30.0, "a", "x"), *STORED[1:]], key=str)
    assert found(read_version(spark, to, 3)) == sorted([(1, 20.0, "a", "x"), *STORED[1:]], key=str)
    held = {f.removeprefix("file:") for v in (3, 4) for f in folders(spark, to, v).values()}
    data = os.path.join(to.root.removeprefix("file:"), "data")
    left = {d for d, _, files in os.walk(data) if any(f.endswith(".orc") for f in files)}
    assert left == held


def test_the_write_tells_its_partitions(spark, tmp_path):
    written = write_partitions(frame(spark, FIRST), str(tmp_path / "t"), ["region", "day"], mode="overwrite")
    assert written.rows == 5
    assert written.partitions == sorted({r[2:] for r in STORED}, key=lambda v: [(x is not None, x or "") for x in v])
    assert write_partitions(frame(spark, []), str(tmp_path / "none"), ["region", "day"], mode="overwrite").partitions == []


def test_registration_needs_no_listing(spark, tmp_path):
    create_database(spark, "versions")
    name, path = f"versions.r_{uuid.uuid4().hex}", str(tmp_path / "table")
    create_external_table(spark, name, SCHEMA, path, ["region", "day"])
    write_registered(frame(spark, FIRST), name, path, ["region", "day"])
    # A folder that no job wrote is not found, as it would be by a repair.
    shutil.copytree(f"{path}/region=a/day=x", f"{path}/region=stray/day=x")
    write_registered(frame(spark, [(6, 6.0, "c", "z")]), name, path, ["region", "day"], emptied=[("b", "x"), ("c", "z")])
    want = [r for r in STORED if r[2:] != ("b", "x")] + [(6, 6.0, "c", "z")]
    assert found(spark.table(name)) == sorted(want, key=str)
    assert found(published_partitions(spark, name, ["region", "day"])) == sorted({r[2:] for r in want}, key=str)
