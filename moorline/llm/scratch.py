"""Written tables between steps, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from moorline.session import hadoop_path, scratch_path


class Scratch:
    """Tables of one job. A saved table survives lost executors; a dropped one frees its disk."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.label = spark, label
        self.paths: dict[int, str] = {}

    def save(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, self.label)
        df.write.parquet(path)
        table = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = path
        # The frame is kept alive with its path, so that its id stays its own.
        self.paths[path] = table
        return table

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self.paths.pop(id(table))
            self.paths.pop(path)
            fs, target = hadoop_path(self.spark, path)
            fs.delete(target, True)
