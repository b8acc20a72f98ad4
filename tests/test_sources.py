import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from moorline.sources import (
    BAD_RECORD,
    Source,
    literal_rows,
    read_any,
    read_csv,
    read_inferred_csv,
    read_json,
    read_key_values,
    read_orc,
    read_parquet,
    read_quarantined,
    register_sources,
    split_bad_records,
    write_with_quarantine,
)
from moorline.sources.files import format_of

SCHEMA = "customer_id INT, contract_id INT, status STRING, amount INT, dt DATE"
LINES = [
    "1,1000,pass,10,2025-05-31",
    "1,abc,pass,11,2025-05-31",
    "1,1002,pass",
    "1,1003,pass,13,2025-05-31,extra",
]


@pytest.fixture
def bad_csv(tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("customer_id,contract_id,status,amount,dt\n" + "\n".join(LINES) + "\n")
    return str(path)


def test_quarantine_keeps_raw_text_and_parsed_fields(spark, bad_csv):
    good, bad = split_bad_records(read_quarantined(spark, bad_csv, SCHEMA))
    assert [r.contract_id for r in good.collect()] == [1000]
    assert sorted(r[BAD_RECORD] for r in bad.collect()) == sorted(LINES[1:])
    assert {r.contract_id for r in bad.collect()} == {None, 1002, 1003}


def test_quarantine_does_not_depend_on_the_selected_columns(spark, bad_csv):
    good, bad = split_bad_records(read_quarantined(spark, bad_csv, SCHEMA))
    for column in good.columns:
        assert good.select(column).count() == len(good.select(column).collect()) == 1
    assert bad.count() == bad.select(BAD_RECORD).count() == 3
    assert good.count() == 1


def test_quarantine_in_one_pass(spark, bad_csv, tmp_path):
    rows = read_quarantined(spark, bad_csv, SCHEMA)
    good, bad = write_with_quarantine(rows, str(tmp_path / "landed"))
    assert (good.count(), bad.select(BAD_RECORD).distinct().count()) == (1, 3)
    clean = rows.where(F.col(BAD_RECORD).isNull())
    good, bad = write_with_quarantine(clean, str(tmp_path / "landed"))
    assert (good.count(), bad.count()) == (1, 0)


def test_json_quarantine(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text('{"a": 1, "b": "x"}\n{"a": 2, "b"\n{"a": "no", "b": "y"}\n')
    good, bad = split_bad_records(read_quarantined(spark, str(path), "a INT, b STRING", "json"))
    assert good.collect() == [(1, "x")]
    assert good.select("b").count() == 1
    assert sorted(r[BAD_RECORD] for r in bad.collect()) == ['{"a": "no", "b": "y"}', '{"a": 2, "b"']


def test_json_quarantine_with_nested_columns(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text('{"m": {"k": 1}, "s": {"x": 1}, "l": [1]}\n{"m": {"k": "no"}, "s": {"x": 1}, "l": [2]}\n')
    schema = "m MAP<STRING, INT>, s STRUCT<x: INT>, l ARRAY<INT>"
    good, bad = split_bad_records(read_quarantined(spark, str(path), schema, "json"))
    assert [r.l for r in good.select("l").collect()] == [[1]] and bad.count() == 1


def test_schema_modes(spark, bad_csv, tmp_path):
    assert set(dict(read_csv(spark, bad_csv).dtypes).values()) == {"string"}
    inferred = dict(read_inferred_csv(spark, bad_csv).dtypes)
    assert inferred["customer_id"] == "int" and inferred["contract_id"] == "string" and inferred["dt"] == "date"
    declared = read_csv(spark, bad_csv, StructType.fromDDL(SCHEMA))
    assert dict(declared.dtypes)["contract_id"] == "int"


def test_caller_options_override_defaults(spark, bad_csv):
    assert read_csv(spark, bad_csv, opts={"header": "false"}).count() == 5
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv(spark, bad_csv, SCHEMA, {"mode": "FAILFAST"}).collect()


def test_format_dispatch(spark, tmp_path):
    assert [format_of(p) for p in ("a.csv", "b.CSV.gz", "dir/c.orc/", "d.parquet", "e.json")] == [
        "csv", "csv", "orc", "parquet", "json"]
    with pytest.raises(ValueError, match="known suffixes"):
        read_any(spark, "table.xyz")


def test_parquet_is_parquet(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "p"))
    assert read_parquet(spark, str(tmp_path / "p")).count() == 3
    spark.range(3).write.orc(str(tmp_path / "o"))
    with pytest.raises(Exception):
        read_parquet(spark, str(tmp_path / "o"), "id BIGINT").collect()


def test_json_keeps_primitive_types(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"a": 1, "b": 1.5, "c": true}\n')
    assert dict(read_json(spark, str(tmp_path / "r.json")).dtypes) == {"a": "bigint", "b": "double", "c": "boolean"}


def test_orc_options(spark, tmp_path):
    spark.sql("SELECT 1 AS a").write.orc(str(tmp_path / "t" / "x=1"))
    spark.sql("SELECT 2 AS a, 'b' AS b").write.orc(str(tmp_path / "t" / "x=2"))
    merged = read_orc(spark, str(tmp_path / "t"), opts={"mergeSchema": "true"})
    assert set(merged.columns) == {"a", "b", "x"} and merged.count() == 2
    flat = read_orc(spark, str(tmp_path / "t"), opts={"recursiveFileLookup": "true"})
    assert "x" not in flat.columns and flat.count() == 2


def test_sources_have_their_own_paths(spark, tmp_path):
    spark.range(2).write.orc(str(tmp_path / "one.orc"))
    spark.range(5).write.json(str(tmp_path / "two.json"))
    frames = register_sources(spark, {
        "first_source": Source(str(tmp_path / "one.orc")), "second_source": Source(str(tmp_path / "two.json"))})
    assert {n: spark.table(n).count() for n in frames} == {"first_source": 2, "second_source": 5}


def test_key_values_push_their_filters(spark, tmp_path):
    rows = [("landing", "harbour", "a", "1"), ("landing", "harbour", "b", "2"), ("other", "harbour", "a", "3")]
    table = literal_rows(spark, rows, "module_name STRING, entity STRING, param_key STRING, param_value STRING")
    table.write.parquet(str(tmp_path / "kv"))
    found = read_key_values(spark, {"module_name": "landing", "entity": "harbour"}, fmt="parquet", location=str(tmp_path / "kv"))
    assert sorted(map(tuple, found.collect())) == [("a", "1"), ("b", "2")]
    assert "EqualTo(module_name,landing)" in found._jdf.queryExecution().toString()
