"""One record per key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from moorline.operators.keys import row_struct


def _orderable(dtype: DataType) -> bool:
    if isinstance(dtype, ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (MapType, VariantType))


def _pick(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], greatest: bool) -> DataFrame:
    rest = [f for f in df.schema.fields if f.name not in keys]
    ranked = [f.name for f in rest if f.name not in order_by and _orderable(f.dataType)]
    carried = [f.name for f in rest if not _orderable(f.dataType)]
    rank = row_struct([*order_by, *ranked])
    if carried:
        best = (F.max_by if greatest else F.min_by)(F.struct(*[f.name for f in rest]), rank)
    else:
        best = (F.max if greatest else F.min)(rank)
    picked = df.groupBy(*keys).agg(best.alias("best"))
    return picked.select(*[c if c in keys else F.col(f"best.`{c}`") for c in df.columns])


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order_by`` values per key.

    Rows that tie on ``order_by`` are ranked by their other columns, so the result does
    not depend on arrival order. An aggregate, not a window: each task sends one row per
    key to the shuffle, however many rows a hot key has.
    """
    return _pick(df, keys, order_by, True)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the smallest ``order_by`` values per key."""
    return _pick(df, keys, order_by, False)


def merge_layers(layers: Mapping[str, DataFrame], keys: Sequence[str], value: str, into: str = "layer") -> DataFrame:
    """Layered settings, first layer wins; a layer without a value for a key gives way.

    Returns ``keys``, the value, and the name of the layer it came from.
    """

    def ranked(priority: int, name: str, layer: DataFrame) -> DataFrame:
        return layer.where(F.col(value).isNotNull()).select(
            *keys, value, F.lit(priority).alias("priority"), F.lit(name).alias(into)
        )

    rows = reduce(DataFrame.unionByName, [ranked(i, n, layer) for i, (n, layer) in enumerate(layers.items())])
    return first_per_key(rows, keys, ["priority"]).drop("priority")
