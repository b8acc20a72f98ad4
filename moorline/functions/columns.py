"""Column functions of the landing jobs; all built-ins, so they stay in generated code.

``upper`` and ``reverse`` need no wrapper: use ``pyspark.sql.functions`` directly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType

# Fixed value: how much of the error a run-log status shows; the log keeps the whole text beside it.
STATUS_ERROR_CHARS = 500


def iso_text(column: Column | str, dtype: DataType) -> Column:
    """ISO-8601 text of a date or timestamp; the fraction shows only when it is not zero."""
    column = F.col(column) if isinstance(column, str) else column
    if isinstance(dtype, DateType):
        return F.date_format(column, "yyyy-MM-dd")
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.regexp_replace(F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.0{6}$", "")
    return column


def parsed_json(text: Column | str) -> Column:
    """JSON text as a variant, null where it does not parse; the column that the next three read."""
    return F.try_parse_json(text)


def context_map(parsed: Column | str) -> Column:
    """The fields of a parsed object as texts; null for what is no object."""
    return F.try_variant_get(parsed, "$", "map<string,string>")


def context_field(parsed: Column | str, name: str, kind: str = "string") -> Column:
    """One field of a parsed object with its type; null where it is absent or of another kind.

    A name may have one kind of quotes, not both.
    """
    quote = '"' if "'" in name else "'"
    if quote in name:
        raise ValueError(f"no path can name the field {name!r}")
    return F.try_variant_get(parsed, f"$[{quote}{name}{quote}]", kind)


def malformed(text: Column | str, parsed: Column | str) -> Column:
    """True for text that is there but did not parse."""
    text, parsed = (F.col(c) if isinstance(c, str) else c for c in (text, parsed))
    return F.coalesce(F.trim(text) != "", F.lit(False)) & parsed.isNull()


def json_context(text: Column | str) -> Column:
    """JSON object text as a string map; null when absent or malformed.

    Where more than this is wanted, parse once with :func:`parsed_json`.
    """
    return context_map(parsed_json(text))


def json_is_malformed(text: Column | str) -> Column:
    """True for text that is there but does not parse."""
    return malformed(text, parsed_json(text))


def micros_to_timestamp(micros: Column | str) -> Column:
    return F.timestamp_micros(micros)


def epoch_micros(ts: Column | str) -> Column:
    return F.unix_micros(ts)


def run_duration(start: Column | str, end: Column | str) -> Column:
    """Microseconds from start to end; null while a run has not ended."""
    return F.timestamp_diff("MICROSECOND", F.col(start) if isinstance(start, str) else start,
                            F.col(end) if isinstance(end, str) else end)


def split_list(text: Column | str) -> Column:
    """Items of a comma list, trimmed."""
    return F.transform(F.split(text, ","), lambda item: F.trim(item))


def value_or_default(settings: Column | str, key: str, default: str | None) -> Column:
    """Value under ``key`` of a map, or the default where the key is missing."""
    return F.coalesce(F.try_element_at(settings, F.lit(key)), F.lit(default))


def run_key(job_id: Column | str, run_id: Column | str, attempt: Column | str) -> Column:
    """Run id that a retry of the same attempt finds again; other values, nulls too, give another id."""
    parts = [F.col(c) if isinstance(c, str) else c for c in (job_id, run_id, attempt)]
    named = F.struct(*[part.cast("string").alias(name) for part, name in zip(parts, ("job_id", "run_id", "attempt"))])
    return F.sha2(F.to_json(named, {"ignoreNullFields": "false"}), 256)


def run_status(state: Column | str, error: Column | str) -> Column:
    """``Started``, ``Completed``, or ``Failed: …`` with the start of the error, if there is one."""
    state = F.col(state) if isinstance(state, str) else state
    error = F.coalesce(F.col(error) if isinstance(error, str) else error, F.lit(""))
    return F.when(state == "Failed", F.concat(F.lit("Failed: "), F.left(error, F.lit(STATUS_ERROR_CHARS)))).otherwise(state)
