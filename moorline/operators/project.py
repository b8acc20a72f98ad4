"""Projections, filters and record shaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from moorline.functions.columns import iso_text

# Columns a landing record gets when its statement leaves them out.
DEFAULT_STATUS = "active"
DEFAULT_CHANGE = "N"


def with_derived(df: DataFrame, **columns: Column) -> DataFrame:
    """Every input column plus the derived ones."""
    return df.select("*", *[column.alias(name) for name, column in columns.items()])


def bind_constants(df: DataFrame, constants: Mapping) -> DataFrame:
    """Add parameter values as constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def inject_defaults(df: DataFrame, biz_dt: str) -> DataFrame:
    """Add the landing columns that are missing; those present stay as they are."""
    defaults = {"biz_dt": biz_dt, "biz_status": DEFAULT_STATUS, "change_indicator": DEFAULT_CHANGE}
    present = {c.lower() for c in df.columns}
    return bind_constants(df, {c: v for c, v in defaults.items() if c not in present})


def equal_to(values: Mapping) -> Column:
    """Conjunction of ``column = value``; the values are bound, never pasted."""
    if not values:
        raise ValueError("no filter values")
    return reduce(Column.__and__, [F.col(name) == F.lit(value) for name, value in values.items()])


def _as_date(value: date | str) -> date:
    return date.fromisoformat(value) if isinstance(value, str) else value


def date_window(df: DataFrame, column: str, from_date: date | str, to_date: date | str) -> DataFrame:
    """Rows dated from ``from_date`` to the end of ``to_date``; a date that does not exist raises.

    The bounds take the column's own type (text for an ISO string such as ``biz_dt``), so
    that the filter reaches the scan and prunes partitions.
    """
    first, after = _as_date(from_date), _as_date(to_date) + timedelta(days=1)
    if isinstance(df.schema[column].dataType, StringType):
        first, after = first.isoformat(), after.isoformat()
    return df.where((F.col(column) >= F.lit(first)) & (F.col(column) < F.lit(after)))


def iso_record(df: DataFrame) -> DataFrame:
    """Every date and timestamp as ISO-8601 text, other columns unchanged."""
    return df.select(*[iso_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def json_record(df: DataFrame, name: str = "record") -> DataFrame:
    """Each row as one JSON object; nulls are kept and microseconds are not cut."""
    return iso_record(df).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias(name))


def require_values(df: DataFrame, columns: Sequence[str] = ("biz_dt",)) -> DataFrame:
    """The frame itself; a row without a value in one of ``columns`` raises when it is read."""

    def checked(name: str) -> Column:
        missing = F.raise_error(F.lit(f"missing required parameter: {name}")).cast("boolean")
        return F.when(F.col(name).isNotNull(), F.lit(True)).otherwise(missing)

    # A filter, not a column: a plan that reads none of the columns keeps it.
    return df.where(reduce(Column.__and__, [checked(name) for name in columns]))


def require_params(params: Mapping, names: Sequence[str] = ("biz_dt",)) -> None:
    """Raise before any work starts when a parameter is missing or blank."""
    missing = [name for name in names if params.get(name) in (None, "")]
    if missing:
        raise ValueError(f"missing required parameter: {', '.join(missing)}")
