"""Lookup and star joins.

No side is broadcast by hint: Spark broadcasts one only when its planned or measured size
is under ``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution splits a skewed
join key otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def typed_keys(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Cast join keys explicitly; rows whose key does not convert come back as rejects."""
    bad = reduce(Column.__or__, [F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in types.items()])
    good = df.where(~bad).withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})
    return good, df.where(bad)


def lookup_join(
    main: DataFrame, lookup: DataFrame, on: Sequence[str] | Mapping[str, str], take: Sequence[str] | None = None
) -> DataFrame:
    """Inner equi join of the main flow with a lookup.

    ``on`` lists shared key names, or maps main keys to lookup keys. All main columns come
    out, and the lookup columns in ``take`` (all but its keys by default). A lookup key
    that repeats repeats the main row, as in SQL.
    """
    pairs = dict(on) if isinstance(on, Mapping) else {key: key for key in on}
    take = [c for c in lookup.columns if c not in pairs.values()] if take is None else list(take)
    keys = [f"__key_{i}" for i in range(len(pairs))]
    side = lookup.select(*[F.col(r).alias(k) for r, k in zip(pairs.values(), keys)], *take)
    condition = reduce(Column.__and__, [main[left] == side[k] for left, k in zip(pairs, keys)])
    return main.join(side, condition, "inner").drop(*keys)


def unmatched(main: DataFrame, lookup: DataFrame, on: Sequence[str] | Mapping[str, str]) -> DataFrame:
    """Main rows without a lookup row: what the inner join leaves out."""
    pairs = dict(on) if isinstance(on, Mapping) else {key: key for key in on}
    side = lookup.select(*[F.col(r).alias(f"__key_{i}") for i, r in enumerate(pairs.values())])
    condition = reduce(Column.__and__, [main[left] == side[f"__key_{i}"] for i, left in enumerate(pairs)])
    return main.join(side, condition, "left_anti")


def repeated_keys(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Lookup keys that would multiply main rows, with their row counts."""
    return lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


@dataclass(frozen=True)
class Dimension:
    """One lookup of a star join."""

    frame: DataFrame
    on: Sequence[str] | Mapping[str, str]
    take: Sequence[str] | None = None


def star_join(fact: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Join a fact flow with its dimensions in turn."""
    return reduce(lambda flow, d: lookup_join(flow, d.frame, d.on, d.take), dimensions, fact)
