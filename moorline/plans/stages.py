"""Chains of SQL stages over named views."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from moorline.plans.templates import bind_template
from moorline.session import observed
from moorline.sources.tables import literal_rows


@dataclass(frozen=True)
class Stage:
    """A statement, as text or in a file, and the view its result becomes."""

    view: str
    sql: str | None = None
    path: str | None = None


class StageCounts:
    """Rows of each stage, counted by the one execution that writes what the stages lead to.

    A counter is part of the plan of its stage. A view that is used twice is computed twice, or
    once where Spark reuses the exchange; either way its rows count once. Filters of later stages
    don't move below a counted one, so leave counting off where a later stage narrows a scan.
    """

    def __init__(self):
        self._counters: dict[str, Observation] = {}
        self._rows: dict[str, int | None] = {}

    def watch(self, stage: str, df: DataFrame) -> DataFrame:
        if stage in self._counters:
            raise ValueError(f"stage {stage!r} is counted already")
        self._counters[stage] = Observation(f"{stage}-{uuid.uuid4().hex}")
        return df.observe(self._counters[stage], F.count(F.lit(1)).alias("rows"))

    def settle(self, written: DataFrame) -> None:
        """Take the counts from the action that has read ``written``; call it once after that.

        A stage that ``written`` doesn't use, or that the planner could leave out, was never run and
        has no count.
        """
        plan = written._jdf.queryExecution().analyzed().toString()
        used = {stage: counter for stage, counter in self._counters.items() if counter._name in plan}
        self._rows = {stage: observed(used[stage]).get("rows") if stage in used else None for stage in self._counters}

    @property
    def rows(self) -> dict[str, int | None]:
        """Rows by stage, in the order of the stages; empty before :meth:`settle`."""
        return dict(self._rows)

    def table(self, spark: SparkSession) -> DataFrame:
        """``(place, stage, rows)``: one row per stage, to be kept with the run."""
        rows = [(place, stage, rows) for place, (stage, rows) in enumerate(self._rows.items(), 1)]
        return literal_rows(spark, rows, "place INT, stage STRING, rows BIGINT")


def load_sql(spark: SparkSession, path: str) -> str:
    """Text of a statement file on any file system Spark can read."""
    return spark.read.text(path, wholetext=True).first()["value"]


def run_stage(
    spark: SparkSession, stage: Stage, params: Mapping | None = None, counts: StageCounts | None = None
) -> DataFrame:
    """Bind the parameters, plan the statement and register its view; nothing runs yet.

    With ``counts`` the view counts its rows when it is read.
    """
    if (stage.sql is None) == (stage.path is None):
        raise ValueError(f"stage {stage.view!r} needs either sql or path")
    text, args = bind_template(stage.sql or load_sql(spark, stage.path), params)
    df = spark.sql(text, args=args)
    if counts is not None:
        df = counts.watch(stage.view, df)
    df.createOrReplaceTempView(stage.view)
    return df


def run_stages(
    spark: SparkSession, stages: Sequence[Stage], params: Mapping | None = None, counts: StageCounts | None = None
) -> dict[str, DataFrame]:
    """Plan the stages in order, each over the views before it.

    The result is one lazy plan: the base tables are read when the last frame is written,
    and once per use rather than once per stage.
    """
    return {stage.view: run_stage(spark, stage, params, counts) for stage in stages}
