"""Counts, grouped measures, settings maps and child-record arrays."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorline.operators.latest import latest_per_key


def total_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def rows_processed(df: DataFrame) -> int:
    """Row count of a frame on its own; prefer the count a write brings along."""
    return df.count()


def partition_breakdown(df: DataFrame, partitions: Sequence[str], status: str, outputs: Sequence[str]) -> DataFrame:
    """Total rows and rows per status of each partition, in one pass."""
    counts = [F.count_if(F.col(status) == name).alias(f"{name.lower()}_count") for name in outputs]
    return df.groupBy(*partitions).agg(F.count(F.lit(1)).alias("total_count"), *counts)


def breakdown_rollup(df: DataFrame, levels: Sequence[str], measures: Mapping[str, Column] | None = None) -> DataFrame:
    """Rows of each group of ``levels``, of each group one level up, and so on up to all rows, in one pass.

    ``row_count`` and the ``measures`` stand beside ``depth``, the number of levels that a row is of:
    all of them in a plain group, 0 in the overall row. Columns of the levels above are null;
    ``depth`` tells them from groups whose value is null. Every task sends one row per group and
    level to the only shuffle. Without rows there is only an overall row where Spark gives one.
    """
    extra = [column.alias(name) for name, column in (measures or {}).items()]
    # Each bit of the number says that a column is summed over.
    depth = F.lit(len(levels)) - F.bit_count(F.grouping_id(*levels))
    return df.rollup(*levels).agg(F.count(F.lit(1)).alias("row_count"), *extra, depth.cast("int").alias("depth"))


@dataclass(frozen=True)
class Measure:
    """Count, sum, least and greatest of one column."""

    column: str
    name: str

    def columns(self) -> list[Column]:
        amount = F.col(self.column)
        return [
            F.count(amount).alias(f"{self.name}_count"),
            F.sum(amount).alias(f"{self.name}_sum"),
            F.min(amount).alias(f"{self.name}_min"),
            F.max(amount).alias(f"{self.name}_max"),
        ]


def grouped_measures(
    df: DataFrame, keys: Sequence[str], measures: Sequence[Measure], having: Column | str | None = None
) -> DataFrame:
    """Grouped measures, then the groups that pass ``having``."""
    grouped = df.groupBy(*keys).agg(*[c for m in measures for c in m.columns()])
    return grouped if having is None else grouped.where(having)


def collect_records(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], parts: int) -> DataFrame:
    """Child rows per key as arrays of records: ``keys, part, records``.

    ``parts`` is how many arrays a key may have, at every size of the data. A child goes to
    the part that its content hashes to, and each array is sorted by ``order_by`` and then the
    other columns; there is no order from one part to the next. The rows of ``df`` are the
    result that always holds; arrays are for consumers that want them, so choose ``parts`` for
    the largest key.
    """
    rest = [*order_by, *[c for c in df.columns if c not in keys and c not in order_by]]
    part = F.pmod(F.xxhash64(*rest), F.lit(parts)).cast("int")
    return df.groupBy(*keys, part.alias("part")).agg(F.sort_array(F.collect_list(F.struct(*rest))).alias("records"))


def settings_maps(
    rows: DataFrame,
    group: Sequence[str],
    parts: int,
    key: str = "param_key",
    value: str = "param_value",
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Key/value rows folded into maps: ``group, part, settings``, ``parts`` of them per group at most.

    The latest value of a repeated key wins. Rows without a key fit no map; see
    :func:`without_key`.
    """
    one = latest_per_key(rows.where(F.col(key).isNotNull()), [*group, key], [*order_by, value]).select(*group, key, value)
    return collect_records(one, group, [key], parts).select(*group, "part", F.map_from_entries("records").alias("settings"))


def without_key(rows: DataFrame, key: str = "param_key") -> DataFrame:
    """The rows that :func:`settings_maps` leaves out: those whose key is null."""
    return rows.where(F.col(key).isNull())


def settings_columns(rows: DataFrame, group: Sequence[str], wanted: Mapping[str, str | None],
                     key: str = "param_key", value: str = "param_value", order_by: Sequence[str] = ()) -> DataFrame:
    """Named settings of each group as columns, with defaults where a key is missing.

    One partial aggregate over the rows: no map is built, however many keys a group has.
    """
    rank = F.struct(*order_by, value)
    picked = [
        F.coalesce(F.max_by(F.col(value), F.when(F.col(key) == name, rank)), F.lit(default)).alias(name)
        for name, default in wanted.items()
    ]
    return rows.groupBy(*group).agg(*picked)
