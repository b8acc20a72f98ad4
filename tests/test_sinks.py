import datetime

import pytest
from pyspark.sql import functions as F

from moorline.session import apply_profile, materialize, shared_dir
from moorline.sinks import (
    atomic_publish,
    create_database,
    create_external_table,
    external_table_ddl,
    partition_columns,
    published_partitions,
    register_view,
    repair_table,
    skip_published,
    upsert_into,
    write_counted,
    write_df,
    write_orc,
)
from moorline.sinks.publish import _swap_in

ROWS = "id INT, biz_dt STRING, biz_status STRING"
PARTS = ["biz_dt", "biz_status"]


def frame(spark, *rows, schema=ROWS):
    return spark.createDataFrame(list(rows), schema)


def content(spark, path, schema=ROWS, fmt="orc"):
    return sorted(map(tuple, spark.read.schema(schema).format(fmt).load(path).select(*[c.split()[0] for c in schema.split(", ")]).collect()))


def test_partition_columns():
    assert partition_columns(" a , b,") == ["a", "b"]
    assert partition_columns(["a", " b"]) == ["a", "b"]
    assert partition_columns() == PARTS
    assert partition_columns(None) == []


def test_overwrite_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_orc(frame(spark, (1, "d1", "A"), (2, "d2", "A")), path, mode="overwrite", partitionBy=PARTS)
    write_orc(frame(spark, (3, "d2", "A")), path, mode="overwrite", partitionBy=PARTS)
    assert content(spark, path) == [(1, "d1", "A"), (3, "d2", "A")]
    write_orc(frame(spark, (4, "d3", "A")), path, mode="overwrite", partitionBy=PARTS, opts={"partitionOverwriteMode": "static"})
    assert content(spark, path) == [(4, "d3", "A")]


def test_partitioned_write_is_rebalanced(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 16).select(F.col("id").cast("int"), F.lit("d").alias("biz_dt"), F.lit("A").alias("biz_status"))
    write_orc(rows, str(tmp_path / "few"), partitionBy=PARTS)
    write_orc(rows, str(tmp_path / "many"), partitionBy=PARTS, rebalance=False)
    assert len(list((tmp_path / "few").rglob("*.orc"))) == 1
    assert len(list((tmp_path / "many").rglob("*.orc"))) == 16
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2KB")
    try:
        write_orc(rows, str(tmp_path / "split"), partitionBy=PARTS)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "split").rglob("*.orc"))) > 1


def test_counted_write_and_modes(spark, tmp_path):
    path = str(tmp_path / "c")
    assert write_counted(spark.range(7), path) == 7
    write_df(spark.range(3), path)
    assert spark.read.parquet(path).count() == 10
    assert write_counted(spark.range(7).where("id > 100"), path, mode="overwrite") == 0


def test_publish_swaps_and_keeps_no_leftovers(spark, tmp_path):
    path = str(tmp_path / "deep" / "final")
    assert atomic_publish(frame(spark, (1, "d1", "A")), path, fmt="orc", partitionBy=PARTS) == 1
    assert atomic_publish(frame(spark, (2, "d2", "A"), (3, "d2", "B")), path, fmt="orc", partitionBy=PARTS) == 2
    assert content(spark, path) == [(2, "d2", "A"), (3, "d2", "B")]
    assert [p.name for p in (tmp_path / "deep").iterdir() if not p.name.startswith(".")] == ["final"]
    assert (tmp_path / "deep" / "final" / "_SUCCESS").exists()


def test_publish_refuses_an_existing_target(spark, tmp_path):
    path = str(tmp_path / "final")
    atomic_publish(spark.range(1), path)
    with pytest.raises(FileExistsError):
        atomic_publish(spark.range(2), path, mode="errorifexists")
    assert spark.read.parquet(path).count() == 1
    assert atomic_publish(spark.range(2), str(tmp_path / "other"), str(tmp_path / "tmp"), mode="errorifexists") == 2


class FakeFs:
    """A file system whose rename of one path fails."""

    def __init__(self, existing, failing, raises=False):
        self.names, self.failing, self.raises = set(existing), failing, raises

    def exists(self, path):
        return path.name in self.names

    def mkdirs(self, path):
        return True

    def rename(self, source, target):
        if source.name in self.failing:
            if self.raises:
                raise OSError("lost")
            return False
        self.names = self.names - {source.name} | {target.name}
        return True

    def delete(self, path, recursive):
        self.names = self.names - {path.name}


class FakePath:
    def __init__(self, parent, name=None):
        self.name = name or parent

    def getParent(self):
        return "folder"


@pytest.mark.parametrize("raises", [False, True])
def test_failed_rename_restores_the_old_data(raises):
    fs = FakeFs({"staged", "final"}, {"staged"}, raises)
    with pytest.raises(RuntimeError, match="old data is in place"):
        _swap_in(fs, FakePath("staged"), FakePath("final"), True, FakePath)
    assert fs.names == {"staged", "final"}


def test_failed_move_aside_leaves_all_in_place():
    fs = FakeFs({"staged", "final"}, {"final"})
    with pytest.raises(RuntimeError, match="unchanged"):
        _swap_in(fs, FakePath("staged"), FakePath("final"), True, FakePath)
    assert fs.names == {"staged", "final"}


def test_skip_published(spark):
    requested = frame(spark, (1, "d1", "A"), (2, "d2", "A"), (3, None, "A"), (4, None, "B"))
    published = frame(spark, (9, "d1", "A"), (8, "d1", "A"), (7, None, "A"))
    assert [r.id for r in skip_published(requested, published, PARTS).orderBy("id").collect()] == [2, 4]


def test_upsert_into_moves_rows_between_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    write_orc(frame(spark, (1, "d1", "A"), (2, "d1", "B"), (3, "d 3/x", "A"), (4, "d4", "A")), path, partitionBy=PARTS)
    kept = tmp_path / "t" / "biz_dt=d4"
    before = {f: f.stat().st_mtime_ns for f in kept.rglob("*.orc")}
    updates = frame(spark, (2, "d1", "A"), (3, "d1", "A"), (5, "new", "A"))
    assert upsert_into(spark, path, updates, ["id"], PARTS, ROWS) == 4
    assert content(spark, path) == [(1, "d1", "A"), (2, "d1", "A"), (3, "d1", "A"), (4, "d4", "A"), (5, "new", "A")]
    assert {f: f.stat().st_mtime_ns for f in kept.rglob("*.orc")} == before
    assert upsert_into(spark, path, updates, ["id"], PARTS, ROWS) == 4
    assert len(content(spark, path)) == 5


def test_upsert_into_a_null_partition(spark, tmp_path):
    path = str(tmp_path / "t")
    write_orc(frame(spark, (1, None, "A"), (2, "d1", "A")), path, partitionBy=PARTS)
    upsert_into(spark, path, frame(spark, (1, None, "B"), (3, None, "A")), ["id"], PARTS, ROWS)
    assert sorted(content(spark, path)) == sorted([(1, None, "B"), (2, "d1", "A"), (3, None, "A")])


def test_catalog_partitions_are_typed_and_unescaped(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "id INT, day DATE, tag STRING"
    day = datetime.date(2025, 5, 31)
    write_orc(frame(spark, (1, day, "a b+c:d"), (2, day, None), schema=schema), path, partitionBy="day,tag")
    create_database(spark, "harbour")
    create_external_table(spark, "harbour.typed", frame(spark, schema=schema).schema, path, "day,tag")
    repair_table(spark, "harbour.typed")
    found = published_partitions(spark, "harbour.typed", "day,tag").collect()
    assert sorted(map(tuple, found), key=str) == sorted([(day, "a b+c:d"), (day, None)], key=str)
    assert spark.table("harbour.typed").count() == 2


def test_hive_ddl(spark):
    schema = frame(spark, schema="contract_id STRING, contract_value DOUBLE, biz_dt STRING, biz_status STRING").schema
    ddl = external_table_ddl("db.t", schema, "/data/it's", PARTS)
    assert ddl == (
        "CREATE EXTERNAL TABLE IF NOT EXISTS `db`.`t` (`contract_id` string, `contract_value` double) "
        "PARTITIONED BY (`biz_dt` string, `biz_status` string) STORED AS ORC LOCATION '/data/it\\'s' "
        "TBLPROPERTIES ('orc.compress'='SNAPPY')"
    )


def test_register_view(spark):
    register_view(spark.range(3), "three")
    assert spark.sql("SELECT count(*) FROM three").first()[0] == 3


def test_profiles(spark):
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
             "spark.sql.adaptive.forceOptimizeSkewedJoin"]
    before = {name: spark.conf.get(name) for name in names}
    try:
        for profile, width in {"small": 100, "medium": 400, "large": 1200}.items():
            assert apply_profile(spark, profile) == width
            assert spark.conf.get(names[0]) == str(width) and spark.conf.get(names[1]) == "true"
        assert apply_profile(spark, "large", input_bytes=100 * 2**40) > 500_000
        with pytest.raises(ValueError, match="unknown profile"):
            apply_profile(spark, "huge")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class Settings(dict):
    def set(self, key, value):
        self[key] = value


class Session:
    def __init__(self, master, **conf):
        self.conf, self.sparkContext = Settings(conf), type("Context", (), {"master": master})


def test_shared_folder():
    named = {"spark.checkpoint.dir": "hdfs://host/shared/"}
    assert shared_dir(Session("yarn", **named)) == "hdfs://host/shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session("yarn"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session("local[2]"))


def test_materialize_writes_under_the_shared_folder(spark):
    table, rows = materialize(spark.range(5), "probe")
    assert rows == table.count() == 5
    assert all(shared_dir(spark) in f for f in table.inputFiles())


def landed(spark, path, schema):
    return sorted(tuple(r) for r in spark.read.schema(schema).orc(path).collect())


def codecs(path):
    """Compression of the ORC files under a folder."""
    import glob

    import pyarrow.orc as orc

    return {orc.ORCFile(f).compression.lower() for f in glob.glob(f"{path}/**/*.orc", recursive=True)}


@pytest.mark.parametrize("stop_at", ["rows", "emptied", "ready", "overwrite", "delete"])
def test_upsert_that_stops_is_finished_by_the_next(spark, tmp_path, monkeypatch, stop_at):
    """Stopped at any step, a rerun gives the rows of one that was not."""
    from moorline.sinks import publish

    schema, path = "k INT, v STRING, p STRING", str(tmp_path / "data")
    base = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "y"), (4, "d", None)], schema)
    updates = spark.createDataFrame([(3, "C", "x"), (4, "D", "z"), (9, "n", "x")], schema)
    want = [(1, "a", "x"), (2, "b", "x"), (3, "C", "x"), (4, "D", "z"), (9, "n", "x")]
    write_df(base, path, mode="overwrite", fmt="orc", partitionBy=["p"])
    write, path_of = publish.write_df, publish.hadoop_path

    def stopping_write(df, target, *args, **kwargs):
        if stop_at == "emptied" and target.endswith("emptied"):
            raise KeyboardInterrupt
        write(df, target, *args, **kwargs)
        if stop_at == "overwrite" and target == path:
            raise KeyboardInterrupt

    def stopping_path(session, target):
        if stop_at == "ready" and target.endswith("_READY") and (tmp_path / "data/_upsert/emptied").exists():
            raise KeyboardInterrupt
        if stop_at == "delete" and "p=" in target:
            raise KeyboardInterrupt
        return path_of(session, target)

    def stopping_count(*args, **kwargs):
        raise KeyboardInterrupt

    monkeypatch.setattr(publish, "write_df", stopping_write)
    monkeypatch.setattr(publish, "hadoop_path", stopping_path)
    if stop_at == "rows":
        monkeypatch.setattr(publish, "write_counted", stopping_count)
    with pytest.raises(KeyboardInterrupt):
        upsert_into(spark, path, updates, ["k"], ["p"], schema)
    monkeypatch.undo()
    upsert_into(spark, path, updates, ["k"], ["p"], schema)
    assert landed(spark, path, schema) == want
    assert not (tmp_path / "data/_upsert").exists() and codecs(path) == {"snappy"}


def test_published_orc_is_snappy(spark, tmp_path):
    atomic_publish(spark.range(5), str(tmp_path / "out"), fmt="orc")
    assert codecs(str(tmp_path / "out")) == {"snappy"}
