import datetime
from decimal import Decimal

import pytest

from moorline.operators import union_outputs
from moorline.plans import Stage, bind_template, run_stage, run_stages


def result(spark, text, **params):
    sql, args = bind_template(text, params)
    return tuple(spark.sql(sql, args=args).first())


def test_quoted_values_are_strings(spark):
    assert result(spark, "SELECT '${d}', \"${d}\", typeof('${n}')", d="2025-05-31", n=5) == ("2025-05-31", "2025-05-31", "string")


def test_bare_values_are_numbers_or_names(spark):
    spark.range(3).createOrReplaceTempView("three")
    text = "SELECT ${col} + ${n}, ${x}, ${flag}, ${day}, ${none} FROM ${VIEW_NAME} t WHERE ${col} = context.n"
    got = result(spark, text, col="id", n="2", x="1.5", flag=True, day=datetime.date(2025, 5, 31), none=None, view_name="three")
    assert got == (4, Decimal("1.5"), True, datetime.date(2025, 5, 31), None)


def test_spliced_forms(spark):
    text = """SELECT ''" + context.d + "'', '" + context.d + "', " + context.n + ", context.n"""
    assert result(spark, text, d="x'y", n=7) == ("x'y", "x'y", 7, 7)


def test_values_are_never_code(spark):
    evil = "a' OR '1'='1\\"
    assert result(spark, "SELECT '${v}', 'say ${v}!', \"say ${v}\" ", v=evil) == (evil, f"say {evil}!", f"say {evil}")
    with pytest.raises(ValueError, match="no number and no name"):
        bind_template("SELECT * FROM ${t}", {"t": "x; DROP TABLE y"})


def test_values_are_not_scanned_again(spark):
    assert result(spark, "SELECT '${a}', 'in ${a}'", a="${b} context.b", b="no") == ("${b} context.b", "in ${b} context.b")


def test_names_match_whole_and_ignore_case(spark):
    got = result(spark, "SELECT '${BIZ_DT}', 'context.biz_dt_x', 'context.biz_dt.'", biz_dt="d", biz_dt_x="e")
    assert got == ("d", "e", "d.")


def test_typed_literals(spark):
    got = result(spark, "SELECT DATE '${d}', timestamp_ntz '${d} 01:02:03', INTERVAL '${n}' DAY", d="2025-05-31", n=2)
    assert got == (datetime.date(2025, 5, 31), datetime.datetime(2025, 5, 31, 1, 2, 3), datetime.timedelta(2))


def test_quoted_identifiers(spark):
    assert spark.sql(bind_template("SELECT 1 AS `n ${k}`", {"k": "a`b"})[0]).columns == ["n a`b"]


@pytest.mark.parametrize("text", ["SELECT '${X}'", "SELECT ${X}", "SELECT 'a ${X} b'", "SELECT context.x", "SELECT ${}"])
def test_unresolved_placeholders_raise(text):
    with pytest.raises(ValueError, match="no value"):
        bind_template(text, {"y": 1})


def test_ambiguous_names_raise():
    with pytest.raises(ValueError, match="twice"):
        bind_template("SELECT 1", {"biz_dt": 1, "BIZ_DT": 2})


def test_comments_are_left_alone(spark):
    assert result(spark, "/* ${a} */ SELECT '--${v}' -- ${b}\n;", v=1) == ("--1",)


def test_no_placeholders(spark):
    text = "SELECT 'it''s', \"a\", 'x\\'y' FROM range(1)"
    assert bind_template(text) == (text, {})


def test_stage_from_file_and_text(spark, tmp_path):
    (tmp_path / "s.hql").write_text("SELECT id,\n  '${d}' AS d\nFROM range(${n});\n")
    df = run_stage(spark, Stage("from_file", path=str(tmp_path / "s.hql")), {"d": "x", "n": 2})
    assert df.collect() == spark.table("from_file").collect() == [(0, "x"), (1, "x")]
    with pytest.raises(ValueError, match="either sql or path"):
        run_stage(spark, Stage("none"))
    with pytest.raises(Exception):
        run_stage(spark, Stage("two", sql="SELECT 1; SELECT 2"))


def test_stage_chain_runs_nothing_until_written(spark):
    tracker, group = spark.sparkContext.statusTracker(), "chain"
    spark.sparkContext.setJobGroup(group, "lazy chain")
    frames = run_stages(spark, [
        Stage("chain_a", sql="SELECT id, id % 2 AS odd FROM range(10)"),
        Stage("chain_b", sql="SELECT * FROM chain_a WHERE odd = 1"),
        Stage("chain_c", sql="SELECT * FROM chain_a WHERE odd = 0 AND id > ${least}"),
    ], {"least": 5})
    assert list(tracker.getJobIdsForGroup(group)) == []
    assert union_outputs([frames["chain_b"], frames["chain_c"]]).count() == 7
    assert len(tracker.getJobIdsForGroup(group)) > 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_unknown_legacy_name_in_quotes():
    text = "SELECT 'see context.biz_dtt'"
    with pytest.raises(ValueError, match="biz_dtt"):
        bind_template(text, {"biz_dt": "d"})
    assert bind_template(text, {"biz_dt": "d"}, plain=["biz_dtt"]) == (text, {})
