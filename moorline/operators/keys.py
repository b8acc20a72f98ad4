"""Rows that have, or lack, a partner by key; null matches null."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_columns(keys: Sequence[str]) -> list[Column]:
    """The key columns under names of their own, so that both sides may stem from one frame."""
    return [F.col(key).alias(f"__key_{i}") for i, key in enumerate(keys)]


def row_struct(columns: Sequence[str]) -> Column:
    """The columns as one struct that is never null, even where there are none."""
    return F.struct(*columns) if columns else F.struct(F.lit(True).alias("present"))


def null_safe(left: DataFrame, side: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [left[key].eqNullSafe(side[f"__key_{i}"]) for i, key in enumerate(keys)])


def with_partner(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is in ``right``; repeated keys are dropped before the shuffle."""
    side = right.select(*key_columns(keys)).distinct()
    return left.join(side, null_safe(left, side, keys), "left_semi")


def without_partner(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``."""
    side = right.select(*key_columns(keys)).distinct()
    return left.join(side, null_safe(left, side, keys), "left_anti")
