"""Session profiles and the shared scratch folder."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Shuffle partitions per profile.
PROFILES = {"small": 100, "medium": 400, "large": 1200}

TARGET_SHUFFLE_BYTES = 200 * 1024 * 1024


def apply_profile(spark: SparkSession, profile: str = "medium", input_bytes: int | None = None) -> int:
    """Set the shuffle width of a named profile, with adaptive execution on.

    A profile is a fixed width, and adaptive execution can only narrow it. Pass
    ``input_bytes`` for inputs beyond the profile: the width then grows so that one
    shuffle partition stays near 200 MB. A skewed join key is split even where a step
    after the join then needs a shuffle of its own. Returns the width that was set.
    """
    if profile not in PROFILES:
        raise ValueError(f"unknown profile {profile!r}; choose one of {', '.join(PROFILES)}")
    width = PROFILES[profile]
    if input_bytes:
        width = max(width, math.ceil(input_bytes / TARGET_SHUFFLE_BYTES))
    spark.conf.set("spark.sql.shuffle.partitions", str(width))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return width


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it in ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return base.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path object itself."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs, target


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, dropped when the application ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    fs, target = hadoop_path(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return f"{path}/data"


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame with a row counter; ``observed(counter)["rows"]`` has the count once it was written.

    The count comes with the action that reads the frame, so nothing is computed twice.
    """
    counter = Observation()
    return df.observe(counter, F.count(F.lit(1)).alias("rows")), counter


def observed(counter: Observation) -> dict:
    """What the action has told; empty where the planner dropped the frame as one that can't have rows."""
    return counter.get if counter._jo.getRow().schema() is not None else {}


def materialize(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Cut lineage with a written table; returns it with its row count.

    A file in the shared folder outlives the executors, and its size is known to the
    planner when it chooses the next join. The count comes from the write itself.
    """
    table, told = materialize_with(df, label, rows=F.count(F.lit(1)))
    return table, told["rows"]


def materialize_with(df: DataFrame, label: str, **counts: Column) -> tuple[DataFrame, dict[str, int]]:
    """As :func:`materialize`, with several counts of the rows that the write tells; 0 where there are none."""
    spark, counter = df.sparkSession, Observation()
    path = scratch_path(spark, label)
    df.observe(counter, *[c.alias(name) for name, c in counts.items()]).write.parquet(path)
    told = observed(counter)
    return spark.read.schema(df.schema).parquet(path), {name: told.get(name) or 0 for name in counts}


def drop_tables(*tables: DataFrame) -> None:
    """Delete tables that :func:`materialize` wrote, once nothing reads them any more."""
    for table in tables:
        spark = table.sparkSession
        base = hadoop_path(spark, shared_dir(spark))
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            fs, target = hadoop_path(spark, folder)
            if not target.toUri().getPath().startswith(base[1].toUri().getPath() + "/"):
                raise ValueError(f"{folder} is no scratch table")
            fs.delete(target, True)
