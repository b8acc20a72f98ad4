"""Control tables: run parameters, settings and the run log."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from moorline.functions.columns import context_map, malformed, parsed_json, run_duration, run_key, run_status
from moorline.operators.latest import first_per_key, latest_per_key
from moorline.operators.project import iso_record


# The five control tables, each with its key first, which can't be null. Run
# events are the rows the execution log is derived from.
JOB_MASTER = (
    StructType().add("job_id", "string", False).add("job_name", "string", False)
    .add("context_params", "string").add("script_path", "string").add("comments", "string")
)
PROCESS_CONTROL = (
    StructType().add("entity", "string", False).add("source_system", "string", False).add("biz_dt", "date", False)
    .add("process_from_date", "date").add("process_to_date", "date").add("run_indicator", "string").add("run_id", "string")
    .add("updated_at", "timestamp").add("change_indicator", "string")
)
JOB_DEPENDENCY = (
    StructType().add("dependent_job_name", "string", False).add("dependent_job_id", "string", False)
    .add("parent_job_name", "string").add("parent_job_id", "string")
)
SYS_PARAMS = (
    StructType().add("param_key", "string", False).add("environment", "string", False).add("key_name", "string", False)
    .add("param_value", "string").add("updated_at", "timestamp")
)
EXECUTION_LOG = (
    StructType().add("job_id", "string", False).add("id", "string").add("run_id", "string").add("job_name", "string")
    .add("status", "string").add("start_time", "timestamp").add("end_time", "timestamp").add("spark_app_id", "string")
)
RUN_EVENT = (
    StructType().add("job_id", "string", False).add("run_id", "string", False).add("attempt", "integer", False)
    .add("job_name", "string").add("spark_app_id", "string").add("state", "string").add("error", "string").add("event_time", "timestamp")
)
REQUEST = ["env", "entity", "source_system", "job_name"]
DOCUMENT = [*REQUEST, "job_id"]


def environment_settings(sys_params: DataFrame, environments: Sequence[str]) -> DataFrame:
    """Settings of the first named environment that has the key, later ones as fallback.

    Returns ``key_name, param_key, param_value`` and the environment it came from.
    """
    names = F.array(*[F.lit(env) for env in environments])
    held = sys_params.where(F.col("environment").isin(*environments) & F.col("param_value").isNotNull())
    ranked = held.select(
        "key_name", "param_key", F.array_position(names, F.col("environment")).alias("priority"),
        "param_value", "environment",
    )
    return first_per_key(ranked, ["key_name", "param_key"], ["priority"]).drop("priority")


def missing_rows(requests: DataFrame, job_master: DataFrame, process_control: DataFrame) -> DataFrame:
    """Requests that cannot be resolved, with the table that lacks their row."""
    names = job_master.select("job_name").distinct()
    dates = process_control.select("entity", "source_system").distinct()
    no_job = requests.join(names, "job_name", "left_anti").select(*REQUEST, F.lit("job_master").alias("missing"))
    known = requests.join(names, "job_name", "left_semi")
    no_date = known.join(dates, ["entity", "source_system"], "left_anti")
    return no_job.unionByName(no_date.select(*REQUEST, F.lit("process_control").alias("missing")))


def resolved_jobs(requests: DataFrame, job_master: DataFrame, process_control: DataFrame) -> DataFrame:
    """Every job of each request that has a process row: the request, ``job_id`` and the job's fields.

    A name that several jobs bear gives one document for each of them.
    """
    dates = process_control.select("entity", "source_system").distinct()
    ready = requests.select(*REQUEST).distinct().join(dates, ["entity", "source_system"], "left_semi")
    return ready.join(job_master.select(*JOB_MASTER.fieldNames()), "job_name")


def resolve_parameters(
    requests: DataFrame,
    job_master: DataFrame,
    job_dependency: DataFrame,
    process_control: DataFrame,
    sys_params: DataFrame,
) -> DataFrame:
    """The parameter documents of ``(env, entity, source_system, job_name, job_id)``, one row per child.

    A row has the document's key, its ``section``, and the child as a struct in the column of
    that name; the columns of other sections are null. Section ``job_master`` has one child, so
    every document has a row. A job and at least one process row are required (see
    :func:`missing_rows` for the requests without); dependencies and settings may be missing.
    Settings are those of the requested environment. The same plan at every size: the children
    are joined to narrow keys, and the job's own fields stay in their one row.
    """
    jobs = resolved_jobs(requests, job_master, process_control)
    keys = jobs.select(*DOCUMENT)

    def children(name: str, table: DataFrame, on: dict[str, str]) -> DataFrame:
        rows = iso_record(table)
        record = F.struct(*rows.columns).alias(name)
        side = rows.select(record, *[F.col(theirs).alias(ours) for ours, theirs in on.items()])
        return keys.join(side, list(on)).select(*DOCUMENT, F.lit(name).alias("section"), name)

    heads = jobs.select(*DOCUMENT, F.lit("job_master").alias("section"), F.struct(*JOB_MASTER.fieldNames()).alias("job_master"))
    sections = [
        heads,
        children("job_dependency", job_dependency, {"job_id": "dependent_job_id"}),
        children("process_control", process_control, {"entity": "entity", "source_system": "source_system"}),
        children("sys_params", sys_params, {"env": "environment", "job_name": "key_name"}),
    ]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), sections)


def parameter_documents(children: DataFrame, parts: int) -> DataFrame:
    """The rows of :func:`resolve_parameters` as nested documents of up to ``parts`` parts each.

    A part has an array per section, each sorted: process rows newest first, settings and
    dependencies by key. Nothing is said about order from part to part. ``job_master`` is null
    in all parts but one.
    """
    names = ["job_dependency", "process_control", "sys_params"]
    lists = {name: F.collect_list(name) for name in names}
    part = F.pmod(F.xxhash64("section", *names), F.lit(parts)).cast("int").alias("part")
    grouped = children.groupBy(*DOCUMENT, part).agg(
        F.first("job_master", True).alias("job_master"), *[rows.alias(name) for name, rows in lists.items()]
    )
    ranks = {"job_dependency": ["parent_job_id"], "process_control": ["biz_dt", "updated_at", "run_id"], "sys_params": ["param_key"]}

    def ordered(name: str) -> Column:
        fields = [f.name for f in children.schema[name].dataType.fields]
        lead = [f for f in ranks[name] if f in fields]
        ranked = F.transform(name, lambda r: F.struct(*[r[f].alias(f) for f in [*lead, *[f for f in fields if f not in lead]]]))
        return F.sort_array(ranked, name != "process_control").alias(name)

    return grouped.select(*DOCUMENT, "part", "job_master", *[ordered(name) for name in names])


# Each section with the owner's columns in its table, their names in a document, and the order of its records.
SECTIONS = {
    "job_dependency": ({"dependent_job_id": "job_id"}, ["parent_job_id"], True),
    "process_control": ({"entity": "entity", "source_system": "source_system"}, ["biz_dt", "updated_at", "run_id"], False),
    "sys_params": ({"environment": "env", "key_name": "job_name"}, ["param_key"], True),
}


def _owned_arrays(table: DataFrame, name: str, parts: int) -> DataFrame:
    """Records of a section as sorted arrays, once for each owner that has any, and each part."""
    owner, lead, ascending = SECTIONS[name]
    rows = iso_record(table)
    first = [c for c in lead if c in rows.columns]
    record = [*first, *[c for c in rows.columns if c not in first]]
    part = F.pmod(F.xxhash64(*record), F.lit(parts)).cast("int").alias("part")
    return rows.groupBy(*[F.col(theirs).alias(ours) for theirs, ours in owner.items()], part).agg(
        F.sort_array(F.collect_list(F.struct(*record)), ascending).alias(name)
    )


def shared_documents(
    requests: DataFrame,
    job_master: DataFrame,
    job_dependency: DataFrame,
    process_control: DataFrame,
    sys_params: DataFrame,
    parts: int,
) -> DataFrame:
    """The documents of :func:`parameter_documents`, from arrays that are made once for all that share them.

    Process rows are collected and sorted once per entity and source system, settings once per
    environment and name, dependencies once per job; requests are handed the arrays by key. So no
    row is repeated, shuffled or sorted for every request of its pair. ``parts`` bounds the arrays of
    a key, as there; ``job_master`` is in part 0, and a part has a row if it has any record.
    """
    jobs = resolved_jobs(requests, job_master, process_control)
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    master = F.struct(*JOB_MASTER.fieldNames())
    documents = jobs.select(*DOCUMENT, master.alias("master"), every)
    for name, table in (("job_dependency", job_dependency), ("process_control", process_control), ("sys_params", sys_params)):
        arrays = _owned_arrays(table, name, parts)
        documents = documents.join(arrays, [*SECTIONS[name][0].values(), "part"], "left")
        documents = documents.withColumn(name, F.coalesce(name, F.array().cast(arrays.schema[name].dataType)))
    filled = F.col("part") == 0
    for name in SECTIONS:
        filled = filled | (F.size(name) > 0)
    return documents.where(filled).select(
        *DOCUMENT, "part", F.when(F.col("part") == 0, F.col("master")).alias("job_master"), *SECTIONS
    )


def flatten_parameters(requests: DataFrame, job_master: DataFrame, process_control: DataFrame) -> DataFrame:
    """One flat row per document, with the latest process row; absent fields are null.

    The latest row of each entity and source system is picked before it meets the requests, so
    neither other process rows nor arrays are made.
    """
    latest = latest_per_key(process_control, ["entity", "source_system"], ["biz_dt", "updated_at", "run_id"])
    # The process fields of a flat document.
    fields = ["biz_dt", "process_from_date", "process_to_date", "run_indicator", "run_id", "change_indicator"]
    dates = iso_record(latest.select("entity", "source_system", *fields))
    # A job's context is parsed once, before the job meets its requests.
    parsed = job_master.select(*JOB_MASTER.fieldNames(), parsed_json("context_params").alias("parsed"))
    master = parsed.select(
        "job_name", "job_id", "script_path", "comments", context_map("parsed").alias("context_params"),
        (~malformed("context_params", "parsed")).alias("context_ok"),
    )
    jobs = requests.select(*REQUEST).distinct().join(master, "job_name")
    return jobs.join(dates, ["entity", "source_system"]).select(
        *DOCUMENT, "script_path", "comments", *fields, "context_params", "context_ok"
    )


def run_events(events: DataFrame) -> DataFrame:
    """Append-only run-log rows from ``job_id, run_id, attempt, state, error, event_time``."""
    return events.withColumns({
        "id": run_key("job_id", "run_id", F.col("attempt").cast("string")),
        "status": run_status("state", "error"),
    })


def run_states(log: DataFrame) -> DataFrame:
    """Latest state of each run: its status, whole error, start, end and duration in microseconds.

    A run has ended when an event other than ``Started`` is its latest. Other columns of
    the log, such as the job name, come from the latest event.
    """
    started = F.col("status") == "Started"
    rank = F.struct("event_time", F.when(started, 0).otherwise(1), "status")
    run = ["id", "job_id", "run_id", "attempt"]
    others = [c for c in log.columns if c not in (*run, "state", "status", "event_time")]
    runs = log.groupBy(*run).agg(
        *[F.max_by(c, rank).alias(c) for c in others],
        F.max_by("status", rank).alias("status"),
        F.min(F.when(started, F.col("event_time"))).alias("start_time"),
        F.max(F.when(~started, F.col("event_time"))).alias("last_end"),
    )
    end = F.when(F.col("status") != "Started", F.col("last_end"))
    return runs.withColumn("end_time", end).drop("last_end").withColumn(
        "duration_micros", run_duration("start_time", "end_time")
    )
