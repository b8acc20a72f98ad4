"""A landing run from named sources to a partitioned dataset."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import SparkSession

from moorline.operators.project import inject_defaults, require_params
from moorline.operators.split import union_outputs
from moorline.plans.stages import Stage, StageCounts, run_stages
from moorline.sinks.write import LANDING_PARTITIONS, write_counted
from moorline.sources.files import Source, register_sources


def land(
    spark: SparkSession,
    sources: Mapping[str, Source],
    stages: Sequence[Stage],
    path: str,
    params: Mapping,
    outputs: Sequence[str] | None = None,
    partitionBy: str | Sequence[str] = LANDING_PARTITIONS,
    opts: Mapping | None = None,
    rebalance: bool = True,
    counts: StageCounts | None = None,
) -> int:
    """Register the sources, run the stages and write their outputs; returns the rows written.

    ``outputs`` names the stages to union (the last one by default). Landing columns that
    the statements leave out get their defaults. All of it is one execution, and only the
    partitions it brings are replaced. With ``counts``, the same execution counts every stage.
    """
    require_params(params)
    register_sources(spark, sources)
    frames = run_stages(spark, stages, params, counts)
    landed = union_outputs([frames[name] for name in outputs or [stages[-1].view]])
    rows = write_counted(
        inject_defaults(landed, str(params["biz_dt"])), path, mode="overwrite", fmt="orc", partitionBy=partitionBy,
        opts={"compression": "snappy", **(opts or {})}, rebalance=rebalance,
    )
    if counts is not None:
        counts.settle(landed)
    return rows
