"""File scans: CSV, JSON, ORC and Parquet, by name or by extension."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

BAD_RECORD = "_bad_record"

# Reader defaults per text format.
PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_RECORD}
DEFAULTS = {
    "csv": {"header": "true", **PERMISSIVE},
    "json": {"primitivesAsString": "false", **PERMISSIVE},
}

# File suffix to format.
FORMATS = {".csv": "csv", ".json": "json", ".orc": "orc", ".parquet": "parquet"}
CODECS = {".gz", ".bz2", ".zst", ".lz4", ".snappy", ".deflate"}


def _scan(spark: SparkSession, fmt: str, path, schema, opts) -> DataFrame:
    reader = spark.read.format(fmt).options(**{**DEFAULTS.get(fmt, {}), **(opts or {})})
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_csv(spark: SparkSession, path, schema: StructType | str | None = None, opts: Mapping | None = None) -> DataFrame:
    """CSV with a header, permissive by default; ``opts`` override the defaults.

    Without a schema every column is a string.
    """
    return _scan(spark, "csv", path, schema, opts)


def read_inferred_csv(spark: SparkSession, path, sampling_ratio: float = 1.0, opts: Mapping | None = None) -> DataFrame:
    """CSV with inferred types. Inference is an extra pass; lower the ratio on large inputs."""
    return read_csv(spark, path, opts={"inferSchema": "true", "samplingRatio": str(sampling_ratio), **(opts or {})})


def read_json(spark: SparkSession, path, schema: StructType | str | None = None, opts: Mapping | None = None) -> DataFrame:
    """Line-delimited JSON, permissive by default."""
    return _scan(spark, "json", path, schema, opts)


def read_orc(spark: SparkSession, path, schema: StructType | str | None = None, opts: Mapping | None = None) -> DataFrame:
    """ORC; declare the schema where partition columns must keep their type (``biz_dt`` as string)."""
    return _scan(spark, "orc", path, schema, opts)


def read_parquet(spark: SparkSession, path, schema: StructType | str | None = None, opts: Mapping | None = None) -> DataFrame:
    """Parquet; same options as :func:`read_orc`."""
    return _scan(spark, "parquet", path, schema, opts)


def format_of(path: str) -> str:
    """Format named by the suffix of ``path``, looking through a compression suffix."""
    stem, suffix = os.path.splitext(path.rstrip("/").lower())
    if suffix in CODECS:
        suffix = os.path.splitext(stem)[1]
    if suffix not in FORMATS:
        raise ValueError(f"cannot tell the format of {path!r}; known suffixes are {', '.join(FORMATS)}")
    return FORMATS[suffix]


def read_any(spark: SparkSession, path: str, schema=None, opts=None, fmt: str | None = None) -> DataFrame:
    """Scan by suffix, or by ``fmt`` for folders whose name has none."""
    return _scan(spark, fmt or format_of(path), path, schema, opts)


@dataclass(frozen=True)
class Source:
    """One named input: its own path, format, schema and options."""

    path: str
    fmt: str | None = None
    schema: StructType | str | None = None
    opts: Mapping | None = None


def register_sources(spark: SparkSession, sources: Mapping[str, Source]) -> dict[str, DataFrame]:
    """Scan each source and register it as the temp view of its name."""
    frames = {}
    for name, source in sources.items():
        frames[name] = read_any(spark, source.path, source.schema, source.opts, source.fmt)
        frames[name].createOrReplaceTempView(name)
    return frames


def csv_to_orc(spark: SparkSession, csv_path: str, orc_path: str, schema=None, opts=None, mode: str = "overwrite") -> DataFrame:
    """Convert CSV files to ORC and return the ORC scan."""
    from moorline.sinks.write import write_orc

    source = read_csv(spark, csv_path, schema, opts)
    write_orc(source, orc_path, mode=mode)
    return read_orc(spark, orc_path, source.schema)
