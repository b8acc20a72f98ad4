"""Status split and union."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESIDUAL = "RESIDUAL"


def label_status(df: DataFrame, column: str, outputs: Mapping[str, Sequence[str]], into: str = "biz_status") -> DataFrame:
    """Name the output each row belongs to, ignoring case; no match or null is ``RESIDUAL``.

    Keeping the split as a column lets one scan feed every output and the union.
    """
    codes = {name: {member.upper() for member in members} for name, members in outputs.items()}
    if len(set().union(*codes.values())) < sum(map(len, codes.values())):
        raise ValueError("a status may belong to one output only")
    status = F.upper(F.col(column))
    labels = [F.when(status.isin(*sorted(members)), F.lit(name)) for name, members in codes.items()]
    return df.withColumn(into, F.coalesce(*labels, F.lit(RESIDUAL)))


def split_by_status(
    df: DataFrame, column: str, outputs: Mapping[str, Sequence[str]], into: str = "biz_status"
) -> dict[str, DataFrame]:
    """One frame per output plus the residual; together they hold each input row once."""
    labelled = label_status(df, column, outputs, into)
    return {name: labelled.where(F.col(into) == name) for name in [*outputs, RESIDUAL]}


def union_outputs(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name, duplicates kept."""
    return reduce(DataFrame.unionByName, frames)
