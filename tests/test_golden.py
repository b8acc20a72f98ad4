"""The contract lookup, end to end: CSV in, stage, partitioned ORC out."""

import pytest
from pyspark.sql import functions as F

from moorline.plans import Stage, land, run_stage
from moorline.sinks import create_external_table, partition_counts, repair_table, show_partitions, write_orc
from moorline.sources import Source, read_orc, register_sources

STATUS = {1003: "fail", 1007: "ok"}
CONTRACTS = [(1, n, STATUS.get(n, "pass"), n - 990) for n in range(1000, 1012)]

STATEMENT = """
    SELECT r.customer_id, r.contract_id, r.status, r.amount, "2025-05-31" AS biz_dt, "2025-05-01" AS etl_start_dt,
           "2025-05-31" AS etl_end_dt, "active" AS biz_status, "Y" AS change_indicator,
           upper(r.status) AS entity_new, l.premium_amt
    FROM source_rows r JOIN lookup_rows l ON r.contract_id = l.contract_id;"""


def write_text(path, lines, end):
    path.write_bytes((end.join(lines) + end).encode())
    return str(path)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_contract_lookup(spark, tmp_path, end):
    source = write_text(tmp_path / "c.csv", ["customer_id,contract_id,status,amount"]
                        + [",".join(map(str, row)) for row in CONTRACTS], end)
    lookup = write_text(tmp_path / "l.csv", ["contract_id,premium_amt"]
                        + [f"{n},{n + 69000}" for n in range(1000, 1012)], end)
    infer = {"inferSchema": "true"}
    register_sources(spark, {"source_rows": Source(source, opts=infer), "lookup_rows": Source(lookup, opts=infer)})
    out = run_stage(spark, Stage("out1", sql=STATEMENT))
    path = str(tmp_path / "landing")
    write_orc(out, path, mode="overwrite", partitionBy="biz_dt, biz_status")

    landed = read_orc(spark, path, out.schema)
    assert dict(landed.dtypes) == {
        "customer_id": "int", "contract_id": "int", "status": "string", "amount": "int", "biz_dt": "string",
        "etl_start_dt": "string", "etl_end_dt": "string", "biz_status": "string", "change_indicator": "string",
        "entity_new": "string", "premium_amt": "int",
    }
    want = [
        (*row, "2025-05-31", "2025-05-01", "2025-05-31", "active", "Y", row[2].upper(), row[1] + 69000) for row in CONTRACTS
    ]
    assert sorted(map(tuple, landed.select(*out.columns).collect())) == want
    assert (tmp_path / "landing" / "biz_dt=2025-05-31" / "biz_status=active").is_dir()

    name = f"landing_{tmp_path.name}".replace("-", "_")
    create_external_table(spark, name, out.schema, path, ["biz_dt", "biz_status"])
    assert spark.table(name).count() == 0
    repair_table(spark, name)
    assert [r[0] for r in show_partitions(spark, name).collect()] == ["biz_dt=2025-05-31/biz_status=active"]
    assert partition_counts(spark, name, ["biz_dt", "biz_status"]).collect() == [("2025-05-31", "active", 12)]
    assert spark.table(name).select(F.sum("premium_amt")).first()[0] == sum(n + 69000 for n in range(1000, 1012))


def test_landing_run_fills_in_what_the_statement_leaves_out(spark, tmp_path):
    source = write_text(tmp_path / "c.csv", ["contract_id,entity", "1,ab", "2,cd"], "\n")
    sources = {"contract_rows": Source(source, schema="contract_id INT, entity STRING")}
    stages = [Stage("derived", sql="SELECT c.*, reverse(entity) AS derived_business_col FROM ${view_name} c")]
    path = str(tmp_path / "landing")
    for day in ("2025-05-31", "2025-06-01", "2025-06-01"):
        assert land(spark, sources, stages, path, {"biz_dt": day, "view_name": "contract_rows"}) == 2
    landed = spark.read.schema("contract_id INT, entity STRING, derived_business_col STRING, change_indicator STRING, "
                               "biz_dt STRING, biz_status STRING").orc(path)
    assert sorted(map(tuple, landed.collect())) == sorted(
        (*row, "N", day, "active") for day in ("2025-05-31", "2025-06-01") for row in ((1, "ab", "ba"), (2, "cd", "dc")))
    with pytest.raises(ValueError, match="biz_dt"):
        land(spark, sources, stages, path, {"view_name": "contract_rows"})


def test_smoke_rows_to_orc(spark, tmp_path):
    rows = [("A", 100), ("B", 200), ("C", 300)]
    write_orc(spark.createDataFrame(rows, "category STRING, value BIGINT"), str(tmp_path / "out"), mode="overwrite")
    assert sorted(map(tuple, read_orc(spark, str(tmp_path / "out")).collect())) == rows
    assert all(".snappy" in f.name for f in (tmp_path / "out").glob("*.orc"))
