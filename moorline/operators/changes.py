"""Keyed upsert and change detection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moorline.operators.keys import row_struct, without_partner
from moorline.operators.latest import latest_per_key


def _guard(ok: Column, keys: Sequence[str]) -> Column:
    """A filter that holds or raises; every plan over the rows keeps it, whatever it selects."""
    told = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys])
    message = F.concat(F.lit(f"duplicate key ({', '.join(keys)}): "), told)
    return F.when(ok, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))


def unique_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The frame itself; a key with more than one row raises when the rows are read."""
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(F.any_value(row_struct(rest)).alias("row"), F.count(F.lit(1)).alias("copies"))
    return one.where(_guard(F.col("copies") == 1, keys)).select(*[c if c in keys else F.col(f"row.`{c}`") for c in df.columns])


def upsert(
    base: DataFrame, updates: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """Insert-or-replace by key: updated rows, and the base rows no update touches.

    With ``order_by`` the latest update per key wins; without it a key that is updated
    twice raises. The base is not regrouped: when the updates are small it is not even
    shuffled.
    """
    one = latest_per_key(updates, keys, order_by) if order_by else unique_per_key(updates, keys)
    return without_partner(base, updates, keys).unionByName(one.select(*base.columns))


def detect_changes(
    previous: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    compare_cols: Sequence[str] | None = None,
    partial_load: bool = False,
) -> DataFrame:
    """Compare two loads by key: insert, update, delete or no change.

    Adds ``change_type`` (I/U/D/N) and ``change_indicator`` (Y/N) to the current row, or
    to the previous row for a deletion. Values compare null-safe. With ``partial_load``
    the current load lists changes only, so a missing key is no deletion and is left out,
    and of the previous load only the compared columns are shuffled.
    Both loads go through one aggregation by key, which also finds repeated keys: they
    raise.
    """
    payload = [c for c in current.columns if c not in keys]
    compared = payload if compare_cols is None else list(compare_cols)
    null = F.lit(None)
    old = previous.select(*keys, row_struct(compared if partial_load else payload).alias("old"), null.alias("new"))
    new = current.select(*keys, null.alias("old"), row_struct(payload).alias("new"))
    # Dealt out by key first: unique keys leave a partial aggregate nothing to reduce, and one sort is enough.
    both = old.unionByName(new).repartition(*keys).groupBy(*keys).agg(
        F.any_value("old", True).alias("old"),
        F.any_value("new", True).alias("new"),
        F.count("old").alias("n_old"),
        F.count("new").alias("n_new"),
    )
    differs = reduce(Column.__or__, [~F.col(f"old.`{c}`").eqNullSafe(F.col(f"new.`{c}`")) for c in compared], F.lit(False))
    kind = F.when(F.col("n_old") == 0, "I").when(F.col("n_new") == 0, "D").when(differs, "U").otherwise("N")
    single = (F.col("n_old") <= 1) & (F.col("n_new") <= 1)
    row = F.col("new") if partial_load else F.coalesce("new", "old")
    changes = both.where(_guard(single, keys)).select(*keys, row.alias("row"), kind.alias("change_type")).select(
        *[c if c in keys else F.col(f"row.`{c}`").alias(c) for c in current.columns],
        "change_type",
        F.when(F.col("change_type") == "N", "N").otherwise("Y").alias("change_indicator"),
    )
    return changes.where(F.col("change_type") != "D") if partial_load else changes
