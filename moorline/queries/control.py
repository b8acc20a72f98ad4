"""Control-data queries; the control tables are derived from the given tables."""

from pyspark.sql import functions as F

from moorline.functions import epoch_micros, micros_to_timestamp
from moorline.operators import (
    collect_records,
    dependency_closure,
    dependency_cycles,
    dependency_levels,
    direct_dependencies,
    latest_per_key,
    merge_layers,
    settings_columns,
    settings_maps,
)
from moorline.operators.control import (
    environment_settings,
    flatten_parameters,
    missing_rows,
    resolve_parameters,
    run_events,
    run_states,
    shared_documents,
)
from moorline.queries.registry import query

# Customers as jobs, each needing the job at half and the job at a third of its number.
EDGES = """
    edges AS (
        SELECT DISTINCT c_custkey AS child, c_custkey // d AS parent
        FROM customer, (VALUES (2), (3)) v(d) WHERE c_custkey > 0)"""


def _edges(t):
    parents = F.array_distinct(F.array(F.expr("c_custkey div 2"), F.expr("c_custkey div 3")))
    return t.customer.where("c_custkey > 0").select(
        F.col("c_custkey").alias("dependent_job_id"), F.explode(parents).alias("parent_job_id"))


@query(f"""
    WITH RECURSIVE {EDGES},
    walk(job_id, level) AS (
        SELECT CAST(0 AS BIGINT), 0 UNION SELECT e.child, w.level + 1 FROM walk w JOIN edges e ON e.parent = w.job_id)
    SELECT job_id, max(level) AS level FROM walk GROUP BY job_id""", name="dependency_levels")
def dependency_order(t):
    return dependency_levels(_edges(t))


@query(f"""
    WITH RECURSIVE {EDGES},
    walk(job_id, distance) AS (
        SELECT CAST(1 AS BIGINT), 0 UNION SELECT e.child, w.distance + 1 FROM walk w JOIN edges e ON e.parent = w.job_id)
    SELECT job_id, min(distance) AS distance FROM walk WHERE job_id <> 1 GROUP BY job_id""", name="dependency_closure")
def dependents_of_job(t):
    return dependency_closure(_edges(t), 1, child="parent_job_id", parent="dependent_job_id")


@query(f"""
    WITH RECURSIVE {EDGES},
    links AS (
        SELECT child, parent FROM edges WHERE parent > 0
        UNION SELECT c_custkey // 8, c_custkey FROM customer WHERE c_custkey % 60 = 0 AND c_custkey >= 8
        UNION SELECT c_custkey, c_custkey FROM customer WHERE c_custkey % 101 = 100),
    reach(a, b) AS (SELECT child, parent FROM links UNION SELECT r.a, l.parent FROM reach r JOIN links l ON l.child = r.b)
    SELECT x.a AS job_id, least(x.a, min(x.b)) AS cycle_id FROM reach x JOIN reach y ON y.a = x.b AND y.b = x.a GROUP BY x.a""", name="dependency_cycles")
def jobs_on_cycles(t):
    """A few jobs need one that needs them, over three steps or themselves; many more wait on those."""
    longer = t.customer.where("c_custkey % 60 = 0 AND c_custkey >= 8").select(F.expr("c_custkey div 8"), "c_custkey")
    itself = t.customer.where("c_custkey % 101 = 100").select("c_custkey", "c_custkey")
    return dependency_cycles(_edges(t).where("parent_job_id > 0").union(longer).union(itself))


@query(f"WITH {EDGES} SELECT child AS dependent_job_id, parent AS parent_job_id FROM edges WHERE child = 100", name="direct_dependencies")
def dependencies_of_job(t):
    return direct_dependencies(_edges(t), 100)


@query("SELECT o_custkey, o_orderkey, o_orderdate, o_orderpriority, o_orderstatus, o_totalprice FROM orders")
def child_records(t):
    """Every child of every array, one row each."""
    arrays = collect_records(t.orders, ["o_custkey"], ["o_orderkey"], parts=16)
    return arrays.select("o_custkey", F.inline("records"))


SETTINGS = """
    settings AS (
        SELECT p_type AS environment, p_brand AS key_name, p_name AS param_key, CAST(p_size AS VARCHAR) AS param_value
        FROM part QUALIFY row_number() OVER (PARTITION BY p_type, p_brand, p_name ORDER BY p_partkey DESC) = 1)"""


def _registry(t):
    return t.part.select(
        F.col("p_type").alias("environment"), F.col("p_brand").alias("key_name"), F.col("p_name").alias("param_key"),
        F.col("p_size").cast("string").alias("param_value"), F.col("p_partkey").alias("updated_at"))


@query("""
    SELECT p_brand AS key_name, p_name AS param_key, CAST(p_size AS VARCHAR) AS param_value
    FROM part QUALIFY row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_partkey DESC) = 1""")
def kv_to_map_lookup(t):
    maps = settings_maps(_registry(t), ["key_name"], parts=16, order_by=["updated_at"])
    return maps.select("key_name", F.explode("settings").alias("param_key", "param_value"))


@query("""
    SELECT p_brand AS key_name,
           coalesce(arg_max(p_size, p_partkey) FILTER (p_name = 'red widget'), 4)::VARCHAR AS "red widget",
           coalesce(arg_max(p_size, p_partkey) FILTER (p_name = 'no such part'), 8)::VARCHAR AS "no such part"
    FROM part GROUP BY p_brand""")
def settings_with_defaults(t):
    wanted = {"red widget": "4", "no such part": "8"}
    return settings_columns(_registry(t), ["key_name"], wanted, order_by=["updated_at"])


@query(f"""
    WITH {SETTINGS}
    SELECT key_name, param_key, param_value, environment FROM settings WHERE environment IN ('PROMO', 'STANDARD', 'ECONOMY')
    QUALIFY row_number() OVER (PARTITION BY key_name, param_key
        ORDER BY list_position(['PROMO', 'STANDARD', 'ECONOMY'], environment)) = 1""")
def settings_by_environment(t):
    current = latest_per_key(_registry(t), ["environment", "key_name", "param_key"], ["updated_at"])
    return environment_settings(current, ["PROMO", "STANDARD", "ECONOMY"])


@query("""
    WITH layers AS (
        SELECT n_name AS param_key, CAST(count(*) AS VARCHAR) AS param_value, 'control' AS layer, 0 AS priority
        FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal < 0 GROUP BY n_name
        UNION ALL
        SELECT n_name, CAST(count(*) AS VARCHAR), 'context', 1
        FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY n_name
        UNION ALL SELECT n_name, '0', 'default', 2 FROM nation)
    SELECT param_key, param_value, layer FROM layers
    QUALIFY row_number() OVER (PARTITION BY param_key ORDER BY priority) = 1""")
def layered_settings(t):
    def counted(df, nation):
        rows = df.join(t.nation, F.col(nation) == F.col("n_nationkey")).groupBy(F.col("n_name").alias("param_key"))
        return rows.agg(F.count(F.lit(1)).cast("string").alias("param_value"))

    layers = {
        "control": counted(t.customer.where("c_acctbal < 0"), "c_nationkey"),
        "context": counted(t.supplier, "s_nationkey"),
        "default": t.nation.selectExpr("n_name AS param_key", "'0' AS param_value"),
    }
    return merge_layers(layers, ["param_key"], "param_value")


CONTROL = """
    jobs AS (
        SELECT 'JOB_' || c_custkey AS job_id, c_name AS job_name,
               CASE WHEN c_acctbal < 0 THEN '{"segment": ' ELSE '{"segment": "' || c_mktsegment || '"}' END AS context_params,
               '/jobs/' || c_mktsegment AS script_path, 'CUST_' || c_custkey AS entity,
               CASE WHEN c_acctbal < 0 THEN 'DEV' ELSE 'PROD' END AS env, c_custkey FROM customer),
    dates AS (
        SELECT 'CUST_' || o_custkey AS entity, o_orderpriority AS source_system, CAST(o_orderdate AS DATE) AS biz_dt,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS process_from_date,
               CAST(o_orderdate AS DATE) AS process_to_date, o_orderstatus AS run_indicator,
               CAST(o_orderkey AS VARCHAR) AS run_id, 'N' AS change_indicator
        FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority, o_orderdate ORDER BY o_orderkey DESC) = 1),
    params AS (
        SELECT o_orderpriority AS param_key, CASE o_orderstatus WHEN 'F' THEN 'DEV' ELSE 'PROD' END AS environment,
               'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS key_name,
               CAST(max(o_orderkey) AS VARCHAR) AS param_value
        FROM orders GROUP BY 1, 2, 3)"""


def _control(t):
    """Requests and the four control tables of :data:`CONTROL`."""
    entity = F.concat(F.lit("CUST_"), "c_custkey")
    env = F.when(F.col("c_acctbal") < 0, "DEV").otherwise("PROD")
    pairs = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("source_system")).distinct()
    requests = t.customer.join(pairs, "c_custkey").select(
        env.alias("env"), entity.alias("entity"), "source_system", F.col("c_name").alias("job_name"))
    quoted = F.concat(F.lit('{"segment": "'), "c_mktsegment", F.lit('"}'))
    context = F.when(F.col("c_acctbal") < 0, '{"segment": ').otherwise(quoted)
    master = t.customer.select(
        F.concat(F.lit("JOB_"), "c_custkey").alias("job_id"), F.col("c_name").alias("job_name"),
        context.alias("context_params"), F.concat(F.lit("/jobs/"), "c_mktsegment").alias("script_path"),
        F.lit(None).cast("string").alias("comments"))
    job = F.concat(F.lit("JOB_"), F.col("dependent_job_id")).alias("dependent_job_id")
    needed = F.concat(F.lit("JOB_"), F.col("parent_job_id")).alias("parent_job_id")
    dependency = _edges(t).select(job, needed)
    day = F.col("o_orderdate").cast("date")
    dates = t.orders.select(
        F.concat(F.lit("CUST_"), "o_custkey").alias("entity"), F.col("o_orderpriority").alias("source_system"),
        day.alias("biz_dt"), F.trunc(day, "month").alias("process_from_date"), day.alias("process_to_date"),
        F.col("o_orderstatus").alias("run_indicator"), F.col("o_orderkey").alias("run_number"),
        F.lit(None).cast("timestamp").alias("updated_at"), F.lit("N").alias("change_indicator"))
    dates = latest_per_key(dates, ["entity", "source_system", "biz_dt"], ["run_number"])
    dates = dates.withColumn("run_id", F.col("run_number").cast("string")).drop("run_number")
    environment = F.when(F.col("o_orderstatus") == "F", "DEV").otherwise("PROD").alias("environment")
    key_name = F.concat(F.lit("Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).alias("key_name")
    params = t.orders.groupBy(F.col("o_orderpriority").alias("param_key"), environment, key_name).agg(
        F.max("o_orderkey").cast("string").alias("param_value"))
    return requests, master, dependency, dates, params


@query(f"""
    WITH {EDGES}, {CONTROL}, documents AS (
        SELECT DISTINCT j.env, j.entity, d.source_system, j.job_name, j.job_id, j.script_path, j.c_custkey
        FROM jobs j JOIN dates d ON d.entity = j.entity)
    SELECT job_id, source_system, 'job_master' AS section, script_path AS child, NULL AS value FROM documents
    UNION ALL SELECT job_id, source_system, 'job_dependency', 'JOB_' || e.parent, NULL
        FROM documents d JOIN edges e ON e.child = d.c_custkey
    UNION ALL SELECT d.job_id, d.source_system, 'process_control', strftime(p.biz_dt, '%Y-%m-%d'), p.run_id
        FROM documents d JOIN dates p ON p.entity = d.entity AND p.source_system = d.source_system
    UNION ALL SELECT d.job_id, d.source_system, 'sys_params', p.param_key, p.param_value
        FROM documents d JOIN params p ON p.key_name = d.job_name AND p.environment = d.env""")
def nested_params(t):
    """Every child of every document."""
    child = F.coalesce("job_master.script_path", "job_dependency.parent_job_id", "process_control.biz_dt", "sys_params.param_key")
    return resolve_parameters(*_control(t)).select(
        "job_id", "source_system", "section", child.alias("child"),
        F.coalesce("process_control.run_id", "sys_params.param_value").alias("value"))


@query(f"""
    WITH {EDGES}, {CONTROL}, documents AS (
        SELECT DISTINCT j.env, j.entity, d.source_system, j.job_name, j.job_id, j.c_custkey FROM jobs j JOIN dates d ON d.entity = j.entity)
    SELECT job_id, source_system,
           (SELECT string_agg('JOB_' || e.parent, ',' ORDER BY 'JOB_' || e.parent) FROM edges e WHERE e.child = d.c_custkey) AS needs,
           (SELECT string_agg(p.run_id, ',' ORDER BY p.biz_dt DESC) FROM dates p
            WHERE p.entity = d.entity AND p.source_system = d.source_system) AS runs,
           (SELECT string_agg(p.param_key || '=' || p.param_value, ',' ORDER BY p.param_key) FROM params p
            WHERE p.key_name = d.job_name AND p.environment = d.env) AS settings
    FROM documents d""")
def parameter_arrays(t):
    """The same documents with an array per section, in one part each."""
    documents = shared_documents(*_control(t), parts=1)

    def listed(items):
        return F.nullif(F.array_join(items, ","), F.lit(""))

    return documents.select(
        "job_id", "source_system", listed(F.col("job_dependency.parent_job_id")).alias("needs"),
        listed(F.col("process_control.run_id")).alias("runs"),
        listed(F.transform("sys_params", lambda r: F.concat(r["param_key"], F.lit("="), r["param_value"]))).alias("settings"))


@query(f"""
    WITH {CONTROL}
    SELECT j.env, j.entity, d.source_system, j.job_name, j.job_id, j.script_path, CAST(NULL AS VARCHAR) AS comments,
           strftime(d.biz_dt, '%Y-%m-%d') AS biz_dt, strftime(d.process_from_date, '%Y-%m-%d') AS process_from_date,
           strftime(d.process_to_date, '%Y-%m-%d') AS process_to_date, d.run_indicator, d.run_id, d.change_indicator,
           CASE WHEN j.env = 'PROD' THEN json_extract_string(j.context_params, '$.segment') END AS segment,
           j.env = 'PROD' AS context_ok
    FROM jobs j JOIN dates d ON d.entity = j.entity
    QUALIFY row_number() OVER (PARTITION BY j.job_id, d.source_system ORDER BY d.biz_dt DESC) = 1""")
def flattened_params(t):
    requests, master, _, dates, _ = _control(t)
    flat = flatten_parameters(requests, master, dates)
    return flat.withColumn("segment", F.try_element_at("context_params", F.lit("segment"))).drop("context_params")


@query(f"""
    WITH {CONTROL}, requests AS (
        SELECT DISTINCT j.env, j.entity, d.source_system, j.job_name FROM jobs j JOIN dates d ON d.entity = j.entity
        UNION ALL SELECT env, entity, 'NO-PRIORITY', job_name FROM jobs
        UNION ALL SELECT 'PROD', 'CUST_' || s_suppkey, '1-URGENT', s_name FROM supplier)
    SELECT env, entity, source_system, job_name,
           CASE WHEN job_name NOT IN (SELECT job_name FROM jobs) THEN 'job_master' ELSE 'process_control' END AS missing
    FROM requests r WHERE job_name NOT IN (SELECT job_name FROM jobs)
       OR NOT EXISTS (SELECT 1 FROM dates d WHERE d.entity = r.entity AND d.source_system = r.source_system)""", name="missing_rows")
def missing_control_rows(t):
    requests, master, _, dates, _ = _control(t)
    suppliers = t.supplier.select(F.lit("PROD").alias("env"), F.concat(F.lit("CUST_"), "s_suppkey").alias("entity"),
                                  F.lit("1-URGENT").alias("source_system"), F.col("s_name").alias("job_name"))
    unknown = requests.select("env", "entity", F.lit("NO-PRIORITY").alias("source_system"), "job_name").distinct()
    customers = t.customer.select(F.col("c_name").alias("job_name"))
    undated = customers.join(unknown, "job_name", "left_anti").join(master, "job_name").select(
        F.when(F.col("context_params") == '{"segment": ', "DEV").otherwise("PROD").alias("env"),
        F.regexp_replace("job_id", "JOB_", "CUST_").alias("entity"), F.lit("NO-PRIORITY").alias("source_system"), "job_name")
    wanted = requests.unionByName(suppliers).unionByName(unknown).unionByName(undated)
    return missing_rows(wanted, master, dates)


def _run_log(t):
    """Purchases complete a user's run of the day, errors fail it, anything else starts it."""
    state = F.when(F.col("event_type") == "purchase", "Completed").when(F.col("event_type") == "error", "Failed")
    return run_events(t.events.select(
        F.col("user_id").cast("string").alias("job_id"), F.date_format("ts", "yyyyMMdd").alias("run_id"),
        F.lit(1).alias("attempt"), F.coalesce(state, F.lit("Started")).alias("state"),
        F.when(F.col("event_id") % 3 != 0, F.repeat("props", F.lit(60))).alias("error"), F.col("ts").alias("event_time")))


@query("""
    WITH log AS (
        SELECT CAST(user_id AS VARCHAR) AS job_id, strftime(ts, '%Y%m%d') AS run_id, ts,
               CASE WHEN event_id % 3 <> 0 THEN repeat(props, 60) END AS error,
               CASE event_type WHEN 'purchase' THEN 'Completed'
                    WHEN 'error' THEN 'Failed: ' || coalesce(left(error, 500), '') ELSE 'Started' END AS status FROM events),
    runs AS (
        SELECT job_id, run_id, arg_max(status, ts) AS status, arg_max_null(error, ts) AS error, min(ts) FILTER (status = 'Started') AS start_time,
               max(ts) FILTER (status <> 'Started') AS last_end FROM log GROUP BY job_id, run_id)
    SELECT sha256('{"job_id":"' || job_id || '","run_id":"' || run_id || '","attempt":"1"}') AS id, job_id, run_id,
           CAST(1 AS INTEGER) AS attempt, status, error, start_time,
           CASE WHEN status <> 'Started' THEN last_end END AS end_time,
           CASE WHEN status <> 'Started' THEN epoch_us(last_end) - epoch_us(start_time) END AS duration_micros FROM runs""")
def run_log_duration(t):
    return run_states(_run_log(t))


@query("SELECT event_id, epoch_us(ts) + 600000000 AS later_micros FROM events")
def epoch_arithmetic(t):
    zero = F.lit("1970-01-01").cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", zero, "ts")
    later = micros_to_timestamp(micros) + F.expr("INTERVAL 10 MINUTES")
    return t.events.select("event_id", epoch_micros(later).alias("later_micros"))
