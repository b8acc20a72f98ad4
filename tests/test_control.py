import datetime
import random

import pytest

from moorline.operators import CycleError, dependency_closure, dependency_cycles, dependency_levels, direct_dependencies, graph, settings_columns
from moorline.operators.control import (
    EXECUTION_LOG,
    JOB_DEPENDENCY,
    JOB_MASTER,
    PROCESS_CONTROL,
    SYS_PARAMS,
    environment_settings,
    flatten_parameters,
    missing_rows,
    parameter_documents,
    resolve_parameters,
    run_events,
    run_states,
    shared_documents,
)
from moorline.plans import logged_run

DAY = datetime.date
NOW = datetime.datetime(2026, 1, 31, 1, 2, 3, 456)


@pytest.fixture(scope="module")
def control(spark):
    master = [("J1", "landing", '{"table": "t"}', "/s", "first"), ("J2", "transform", "{bad", None, None), ("J0", "transform", None, "/z", None)]
    dates = [("HARBOUR", "LEDGER", DAY(2026, 1, d), DAY(2026, 1, 1), DAY(2026, 1, d), "Y", f"r{d}", NOW, "Y") for d in (25, 27, 26)]
    needs = [("landing", "J1", "a", "P1"), ("landing", "J1", "b", "P2")]
    params = [(k, e, "landing", f"{k}-{e}", NOW) for k in ("cores", "memory") for e in ("DEV", "PROD")]
    params += [("only.dev", "DEV", "landing", "x", NOW), ("none", "PROD", "landing", None, NOW), ("none", "DEV", "landing", "fallback", NOW)]
    make = spark.createDataFrame
    return make(master, JOB_MASTER), make(needs, JOB_DEPENDENCY), make(dates, PROCESS_CONTROL), make(params, SYS_PARAMS)


def requests(spark, *rows):
    return spark.createDataFrame(list(rows), "env STRING, entity STRING, source_system STRING, job_name STRING")


def test_schemas():
    assert EXECUTION_LOG.simpleString() == (
        "struct<job_id:string,id:string,run_id:string,job_name:string,status:string,start_time:timestamp,"
        "end_time:timestamp,spark_app_id:string>")
    assert PROCESS_CONTROL["biz_dt"].dataType.simpleString() == "date" and not PROCESS_CONTROL["biz_dt"].nullable
    assert JOB_MASTER["context_params"].nullable


def test_document(spark, control):
    children = resolve_parameters(requests(spark, ("PROD", "HARBOUR", "LEDGER", "landing")), *control)
    sections = [r.section for r in children.collect()]
    assert sorted(sections) == ["job_dependency"] * 2 + ["job_master"] + ["process_control"] * 3 + ["sys_params"] * 3
    docs = parameter_documents(children, 1).collect()
    assert len(docs) == 1
    doc = docs[0].asDict(recursive=True)
    assert [doc[k] for k in ("env", "entity", "source_system", "job_name", "job_id")] == ["PROD", "HARBOUR", "LEDGER", "landing", "J1"]
    assert doc["job_master"]["script_path"] == "/s"
    assert [d["parent_job_id"] for d in doc["job_dependency"]] == ["P1", "P2"]
    assert [d["biz_dt"] for d in doc["process_control"]] == ["2026-01-27", "2026-01-26", "2026-01-25"]
    assert doc["process_control"][0]["updated_at"] == "2026-01-31T01:02:03.000456"
    assert [(d["param_key"], d["param_value"]) for d in doc["sys_params"]] == [
        ("cores", "cores-PROD"), ("memory", "memory-PROD"), ("none", None)]


@pytest.mark.parametrize("parts", [2, 7])
def test_document_in_parts_has_the_same_children(spark, control, parts):
    children = resolve_parameters(requests(spark, ("PROD", "HARBOUR", "LEDGER", "landing")), *control)
    whole, split = parameter_documents(children, 1).first(), parameter_documents(children, parts).collect()
    assert 1 < len(split) <= parts
    for section in ("job_dependency", "process_control", "sys_params"):
        assert sorted(map(repr, whole[section])) == sorted(repr(r) for p in split for r in p[section])
    assert [p.job_master for p in split if p.job_master] == [whole.job_master]


@pytest.mark.parametrize("parts", [1, 3])
def test_shared_arrays_give_the_same_documents(spark, control, parts):
    wanted = requests(spark, ("PROD", "HARBOUR", "LEDGER", "landing"), ("DEV", "HARBOUR", "LEDGER", "landing"),
                      ("DEV", "HARBOUR", "LEDGER", "transform"), ("DEV", "HARBOUR", "NONE", "landing"))
    def sections(rows):
        found = {}
        for r in rows:
            own = found.setdefault((r.env, r.job_name, r.job_id), {"job_master": []})
            own["job_master"] += [repr(r.job_master)] if r.job_master else []
            for name in ("job_dependency", "process_control", "sys_params"):
                own.setdefault(name, []).extend(map(repr, r[name]))
        return found if parts == 1 else {k: {n: sorted(x) for n, x in v.items()} for k, v in found.items()}

    shared = shared_documents(wanted, *control, parts).collect()
    assert sections(shared) == sections(parameter_documents(resolve_parameters(wanted, *control), parts).collect())
    assert len(sections(shared)) == 4 and (parts > 1 or len(shared) == 4)


def test_flat_row(spark, control):
    wanted = requests(spark, ("DEV", "HARBOUR", "LEDGER", "landing"), ("DEV", "HARBOUR", "LEDGER", "transform"))
    flat = {r.job_id: r for r in flatten_parameters(wanted, control[0], control[2]).collect()}
    landing, transform = flat["J1"], flat["J0"]
    assert (landing.biz_dt, landing.run_id, landing.process_from_date) == ("2026-01-27", "r27", "2026-01-01")
    assert landing.context_params == {"table": "t"} and landing.context_ok
    assert transform.context_params is None and transform.context_ok and transform.comments is None
    # Another job of the same name has a document of its own; its context is malformed.
    assert flat["J2"].context_params is None and not flat["J2"].context_ok


def test_missing_rows(spark, control):
    wanted = requests(spark, ("P", "HARBOUR", "LEDGER", "landing"), ("P", "HARBOUR", "LEDGER", "nobody"), ("P", "HARBOUR", "X", "landing"), ("P", "Q", "X", "nobody"))
    got = sorted((r.job_name, r.source_system, r.missing) for r in missing_rows(wanted, control[0], control[2]).collect())
    assert got == [("landing", "X", "process_control"), ("nobody", "LEDGER", "job_master"), ("nobody", "X", "job_master")]
    assert resolve_parameters(wanted, *control).select("job_id").distinct().count() == 1


def test_environment_settings(spark, control):
    got = {r.param_key: (r.param_value, r.environment) for r in environment_settings(control[3], ["PROD", "DEV"]).collect()}
    assert got == {"cores": ("cores-PROD", "PROD"), "memory": ("memory-PROD", "PROD"), "only.dev": ("x", "DEV"), "none": ("fallback", "DEV")}
    assert {r.param_key for r in environment_settings(control[3], ["PROD"]).collect()} == {"cores", "memory"}


def test_settings_columns(spark, control):
    prod = control[3].where("environment = 'PROD'")
    got = settings_columns(prod, ["key_name"], {"memory": "4g", "instances": "4", "none": "n"}, order_by=["updated_at"]).collect()
    assert got == [("landing", "memory-PROD", "4", "n")]


# Dependencies

def edges(spark, *pairs):
    return spark.createDataFrame(list(pairs), "dependent_job_id STRING, parent_job_id STRING")


def longest(pairs):
    nodes = {n for pair in pairs for n in pair if n is not None}
    parents = {n: [p for c, p in pairs if c == n and p is not None] for n in nodes}

    def level(node):
        return 1 + max(map(level, parents[node])) if parents[node] else 0

    return {n: level(n) for n in nodes}


def test_levels_of_a_diamond_with_a_long_side(spark):
    pairs = [("b", "a"), ("c", "b"), ("d", "c"), ("d", "a"), ("x", None), ("d", "c")]
    got = {r.job_id: r.level for r in dependency_levels(edges(spark, *pairs)).collect()}
    assert got == longest(pairs) == {"a": 0, "b": 1, "c": 2, "d": 3, "x": 0}


def test_levels_of_random_graphs(spark):
    rng = random.Random(7)
    for _ in range(3):
        pairs = list({(f"n{b}", f"n{a}") for a, b in (sorted(rng.sample(range(25), 2)) for _ in range(40))})
        assert {r.job_id: r.level for r in dependency_levels(edges(spark, *pairs)).collect()} == longest(pairs)


def test_deep_graphs_are_compacted(spark, monkeypatch):
    monkeypatch.setattr("moorline.operators.graph.ROUNDS_PER_PLAN", 3)
    chain = edges(spark, *[(f"n{i + 1}", f"n{i}") for i in range(7)])
    assert {r.job_id: r.level for r in dependency_levels(chain).collect()} == {f"n{i}": i for i in range(8)}
    assert {r.job_id: r.distance for r in dependency_closure(chain, "n7").collect()} == {f"n{7 - i}": i for i in range(1, 8)}


@pytest.mark.parametrize("pairs, on", [
    ([("a", "a")], "a"), ([("a", "b"), ("b", "c"), ("c", "a"), ("b", "root")], "abc"), ([("a", "b"), ("b", "a"), ("w", "a"), ("a", "n")], "ab"),
])
def test_cycles_raise(spark, pairs, on):
    with pytest.raises(CycleError, match=f"cycle; {len(on)} jobs") as raised:
        dependency_levels(edges(spark, *pairs))
    assert {r.job_id for r in raised.value.members.collect()} == set(on)


def cycles_of(pairs):
    """Jobs that can reach themselves, each with the least job that it reaches and that reaches it."""
    reach = set(pairs)
    while (more := reach | {(a, d) for a, b in reach for c, d in pairs if b == c}) != reach:
        reach = more
    return {a: min(b for b in {x for pair in pairs for x in pair} if (a, b) in reach and (b, a) in reach) for a, x in reach if a == x}


@pytest.mark.parametrize("seed", range(4))
def test_cycles_match_brute_force(spark, seed):
    rng = random.Random(seed)
    names = [f"n{i:02}" for i in range(30)]
    pairs = list({(rng.choice(names), rng.choice(names)) for _ in range(rng.choice([12, 25, 40]))})
    if seed == 3:
        # Two long cycles, a chain between them, tails on both sides and a job that needs itself.
        ring = lambda c, n: [(f"{c}{i}", f"{c}{(i + 1) % n}") for i in range(n)]
        pairs = ring("p", 9) + ring("q", 7) + [("p0", "m1"), ("m1", "m2"), ("m2", "q3"), ("t1", "t0"), ("t0", "p5"), ("q1", "z0"), ("z0", "z1"), ("s", "s"), ("z1", "s")]
    found = {r.job_id: r.cycle_id for r in dependency_cycles(edges(spark, *pairs, (None, "x"), ("x", None))).collect()}
    assert found == cycles_of(pairs)


def test_no_cycles(spark):
    assert dependency_cycles(edges(spark, *[(f"n{i + 1}", f"n{i}") for i in range(12)])).collect() == []
    assert dependency_cycles(edges(spark, (None, None))).collect() == []


def test_cycles_behind_each_other_take_few_rounds(spark, monkeypatch):
    """Twelve pairs in a row, with the least names at both ends: by names each round would part one more pair."""
    rounds, labelled = [], graph._labelled
    monkeypatch.setattr(graph, "_labelled", lambda *args: rounds.append(1) or labelled(*args))
    order = [*range(0, 12, 2), *range(11, 0, -2)]
    pairs = [pair for i in order for pair in [(f"n{i:02}", f"o{i:02}"), (f"o{i:02}", f"n{i:02}")]]
    pairs += [(f"n{a:02}", f"n{b:02}") for a, b in zip(order, order[1:])]
    found = {r.job_id: r.cycle_id for r in dependency_cycles(edges(spark, *pairs)).collect()}
    assert found == {f"{c}{i:02}": f"n{i:02}" for c in "no" for i in order}
    assert len(rounds) <= 5


def test_long_chains_and_scratch(spark):
    """200 levels; the tables of earlier rounds are gone afterwards."""
    chain = edges(spark, *[(f"n{i + 1}", f"n{i}") for i in range(200)])
    assert {r.job_id: r.level for r in dependency_levels(chain).collect()} == {f"n{i}": i for i in range(201)}


def test_closure(spark):
    pairs = [("d", "c"), ("d", "b"), ("c", "a"), ("b", "a"), ("a", "z"), ("q", "r"), ("z", "d")]
    got = {r.job_id: r.distance for r in dependency_closure(edges(spark, *pairs), "d").collect()}
    assert got == {"b": 1, "c": 1, "a": 2, "z": 3}
    assert dependency_closure(edges(spark, *pairs), "nobody").count() == 0
    assert direct_dependencies(edges(spark, *pairs), "d").count() == 2


# Run log

def test_run_log(spark):
    t = [datetime.datetime(2026, 1, 1, 0, m) for m in range(6)]
    log = spark.createDataFrame([
        ("J", "r1", 1, "Started", None, t[0]), ("J", "r1", 1, "Failed", "boom " * 200, t[2]),
        ("J", "r1", 2, "Started", None, t[3]), ("J", "r1", 2, "Completed", None, t[3]),
        ("J", "r2", 1, "Started", None, t[5]),
    ], "job_id STRING, run_id STRING, attempt INT, state STRING, error STRING, event_time TIMESTAMP")
    got = {(r.run_id, r.attempt): r for r in run_states(run_events(log)).collect()}
    assert len(got) == 3 and len({r.id for r in got.values()}) == 3
    assert got["r1", 1].status == "Failed: " + ("boom " * 200)[:500] and got["r1", 1].duration_micros == 120_000_000
    assert got["r1", 2].status == "Completed" and got["r1", 2].duration_micros == 0
    assert got["r2", 1].status == "Started" and got["r2", 1].end_time is None and got["r2", 1].duration_micros is None


def test_logged_runs(spark, tmp_path):
    path = str(tmp_path / "log")
    with logged_run(spark, path, "J", "r1", job_name="landing"):
        pass
    with pytest.raises(KeyError):
        with logged_run(spark, path, "J", "r1", attempt=2):
            raise KeyError("lost")
    got = {r.attempt: r for r in run_states(spark.read.parquet(path)).collect()}
    assert (got[1].status, got[1].job_name, got[2].status) == ("Completed", "landing", "Failed: 'lost'")
    assert got[1].spark_app_id == spark.sparkContext.applicationId and got[1].duration_micros > 0
    assert set(EXECUTION_LOG.fieldNames()) <= set(run_states(spark.read.parquet(path)).columns)


def test_a_retried_log_row_changes_nothing(spark):
    log = spark.createDataFrame([("J", "r", 1, "Started", None, NOW)], "job_id STRING, run_id STRING, attempt INT, state STRING, error STRING, event_time TIMESTAMP")
    once = run_events(log)
    assert run_states(once.union(once)).collect() == run_states(once).collect()
