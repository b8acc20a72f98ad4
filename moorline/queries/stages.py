"""Templated statements and stage chains."""

from pyspark.sql import functions as F

from moorline.operators import merge_layers, partition_breakdown, union_outputs
from moorline.operators.control import JOB_MASTER, flatten_parameters
from moorline.plans import Stage, StageCounts, land, run_stage, run_stages
from moorline.queries.registry import query
from moorline.session import scratch_path
from moorline.sinks import write_df
from moorline.sources import Source, literal_rows, read_orc, register_sources


def _sources(t):
    tables = {"customers": "customer", "portfolio": "nation", "contracts": "orders", "products": "part", "transactions": "lineitem"}
    return {name: Source(t.path(table)) for name, table in tables.items()}


def _views(t):
    register_sources(t.spark, _sources(t))


def _in_file(t, stage):
    """The stage with its statement in a file of the shared folder."""
    path = scratch_path(t.spark, "statement")
    write_df(literal_rows(t.spark, [(stage.sql,)], "value STRING").coalesce(1), path, fmt="text", opts={"lineSep": "\n"})
    return Stage(stage.view, path=path)


@query("""
    SELECT o_orderkey AS contract_id, o_custkey AS customer_id, c_name AS customer_name, o_totalprice AS contract_value,
           CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'EXPIRED' ELSE 'RESIDUAL' END AS biz_status,
           strftime(o_orderdate, '%Y') AS biz_dt, 'N' AS change_indicator
    FROM orders JOIN customer ON c_custkey = o_custkey""")
def landing_job(t):
    """Sources to partitioned ORC in one execution; the change flag is left to its default.

    The split stays a column, so the sources are read once for all outputs; other codes are residual.
    """
    sources = {"contracts": Source(t.path("orders")), "customers": Source(t.path("customer"))}
    stages = [
        Stage("joined_contracts", sql="""
            SELECT o_orderkey AS contract_id, o_custkey AS customer_id, c_name AS customer_name,
                   o_totalprice AS contract_value, date_format(o_orderdate, 'yyyy') AS biz_dt,
                   CASE o_orderstatus WHEN 'O' THEN '${active}' WHEN 'F' THEN '${expired}' ELSE 'RESIDUAL' END AS biz_status
            FROM contracts JOIN customers ON c_custkey = o_custkey"""),
        Stage("landed_contracts", sql="SELECT * FROM joined_contracts WHERE biz_status IN ('${active}', '${expired}', 'RESIDUAL')"),
    ]
    params = {"biz_dt": "2025-05-31", "active": "ACTIVE", "expired": "EXPIRED"}
    path = scratch_path(t.spark, "landing-job")
    land(t.spark, sources, stages, path, params)
    return read_orc(t.spark, path, "contract_id BIGINT, customer_id BIGINT, customer_name STRING, contract_value DOUBLE, "
                                   "change_indicator STRING, biz_dt STRING, biz_status STRING")


@query("""
    SELECT *, reverse(o_orderpriority) AS derived_business_col FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice > 100000.5""")
def templated_sql(t):
    _views(t)
    statement = """
        -- keeps one status of ${NO_SUCH_NAME}
        SELECT c.*, reverse(o_orderpriority) AS derived_business_col FROM ${VIEW_NAME} c
        WHERE c.o_orderstatus = '${STATUS}' AND c.o_totalprice > ${least};"""
    params = {"view_name": "contracts", "status": "F", "LEAST": "100000.5"}
    return run_stage(t.spark, Stage("filtered", sql=statement), params)


@query("""
    SELECT o_orderkey, '2025-05-31' AS biz_dt, 'load of 2025-05-31' AS note, 7 AS batch FROM orders
    WHERE o_orderstatus = 'O' AND o_orderpriority <> '5-LOW' AND o_custkey > 7""")
def legacy_templated_sql(t):
    _views(t)
    statement = """
        SELECT o_orderkey, ''" + context.biz_dt + "'' AS biz_dt, 'load of context.biz_dt' AS note, context.batch AS batch
        FROM contracts
        WHERE o_orderstatus = '" + context.status + "' AND o_custkey > " + context.batch + "
          AND o_orderpriority <> 'context.status_x'"""
    params = {"biz_dt": "2025-05-31", "status": "O", "batch": 7, "status_x": "5-LOW"}
    return run_stage(t.spark, Stage("legacy", sql=statement), params)


@query("""
    SELECT o_orderkey, 'it''s landed' AS note, 'say "now"' AS quoted FROM orders WHERE o_orderpriority = '1-URGENT'""")
def double_quoted_literals(t):
    _views(t)
    statement = '''
        SELECT o_orderkey, "it's landed" AS note, "say \\"${when}\\"" AS quoted FROM contracts WHERE o_orderpriority = "${priority}"'''
    return run_stage(t.spark, _in_file(t, Stage("quoted", sql=statement)), {"when": "now", "priority": "1-URGENT"})


# Transactions and contracts are summed before they are joined, so a contract or customer with
# very many of them is reduced in each task before anything is shuffled on its number. The
# outcome stays a column: two outputs of one plan are read from the same stage.
CHAIN = [
    Stage("joined_data", sql="""
        SELECT c_nationkey, c_mktsegment, contracts, amount, quantity, last_date
        FROM customers JOIN (
            SELECT o_custkey, count(*) AS contracts, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS amount,
                   sum(quantity) AS quantity, max(o_orderdate) AS last_date
            FROM contracts LEFT JOIN (
                SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(18, 2))) AS quantity FROM transactions GROUP BY l_orderkey)
              ON l_orderkey = o_orderkey
            GROUP BY o_custkey) ON c_custkey = o_custkey"""),
    Stage("aggregated_data", sql="""
        SELECT c_nationkey, c_mktsegment, sum(contracts) AS contracts, sum(amount) AS amount, sum(quantity) AS quantity,
               max(last_date) AS last_date
        FROM joined_data GROUP BY c_nationkey, c_mktsegment HAVING sum(contracts) > ${least}"""),
    Stage("transformed_data", sql="""
        SELECT c_nationkey, lower(c_mktsegment) AS segment, contracts, CAST(amount AS DOUBLE) AS amount,
               CAST(quantity AS DOUBLE) AS quantity, '${biz_dt}' AS biz_dt,
               CASE WHEN last_date >= DATE '${process_from_date}' THEN 'ACTIVE' ELSE 'EXPIRED' END AS biz_status
        FROM aggregated_data"""),
    Stage("output_active", sql="SELECT * FROM transformed_data WHERE biz_status = 'ACTIVE'"),
    Stage("output_expired", sql="SELECT * FROM transformed_data WHERE biz_status = 'EXPIRED'"),
]


@query("""
    SELECT c_nationkey, lower(c_mktsegment) AS segment, count(*) AS contracts,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS amount, CAST(sum(quantity) AS DOUBLE) AS quantity,
           '2025-05-31' AS biz_dt, CASE WHEN max(o_orderdate) >= DATE '2001-07-25' THEN 'ACTIVE' ELSE 'EXPIRED' END AS biz_status
    FROM orders JOIN customer ON c_custkey = o_custkey
    LEFT JOIN (SELECT l_orderkey, sum(CAST(l_quantity AS DECIMAL(18, 2))) AS quantity FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
    GROUP BY c_nationkey, c_mktsegment HAVING count(*) > 5""")
def stage_chain(t):
    _views(t)
    frames = run_stages(t.spark, CHAIN, {"biz_dt": "2025-05-31", "process_from_date": "2001-07-25", "least": 5})
    return union_outputs([frames["output_active"], frames["output_expired"]])


# The main job: five sources, five stages from files, parameters from the control tables.
MAIN_JOB = [
    Stage("priced_contracts", sql="""
        SELECT l_orderkey, l_partkey, count(*) AS transactions, sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS value
        FROM transactions GROUP BY l_orderkey, l_partkey"""),
    Stage("joined_data", sql="""
        SELECT n_name, p_brand, o_orderstatus, date_format(o_orderdate, 'yyyy') AS biz_dt, o_orderdate, transactions, value
        FROM priced_contracts JOIN contracts ON o_orderkey = l_orderkey JOIN customers ON c_custkey = o_custkey
        JOIN portfolio ON n_nationkey = c_nationkey JOIN products ON p_partkey = l_partkey"""),
    Stage("aggregated_data", sql="""
        SELECT n_name, p_brand, o_orderstatus, biz_dt, sum(transactions) AS transactions, sum(value) AS value, max(o_orderdate) AS last_date
        FROM joined_data GROUP BY n_name, p_brand, o_orderstatus, biz_dt HAVING sum(transactions) >= ${least}"""),
    Stage("transformed_data", sql="""
        SELECT n_name AS nation, lower(p_brand) AS brand, transactions, CAST(value AS DOUBLE) AS value, '${run_id}' AS run_id,
               last_date >= DATE '${process_from_date}' AS recent, o_orderstatus, biz_dt FROM aggregated_data"""),
    Stage("landed_data", sql="""
        SELECT nation, brand, transactions, value, run_id, recent, biz_dt,
               CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'EXPIRED' ELSE 'RESIDUAL' END AS biz_status
        FROM transformed_data"""),
]
MAIN_SCHEMA = "nation STRING, brand STRING, transactions BIGINT, value DOUBLE, run_id STRING, recent BOOLEAN, change_indicator STRING, biz_dt STRING, biz_status STRING"


def _main_params(t):
    """Run parameters of one job: its flat document over environment settings over defaults."""
    dates = t.orders.where("o_orderpriority = '1-URGENT'").select(
        F.lit("LANDING").alias("entity"), F.col("o_orderpriority").alias("source_system"), F.col("o_orderdate").cast("date").alias("biz_dt"),
        F.trunc("o_orderdate", "month").alias("process_from_date"), F.col("o_orderdate").cast("date").alias("process_to_date"),
        F.lit("Y").alias("run_indicator"), F.col("o_orderkey").cast("string").alias("run_id"),
        F.lit(None).cast("timestamp").alias("updated_at"), F.lit("N").alias("change_indicator"))
    request = literal_rows(t.spark, [("PROD", "LANDING", "1-URGENT", "main")], "env STRING, entity STRING, source_system STRING, job_name STRING")
    master = literal_rows(t.spark, [("J1", "main", '{"least": "2"}', "/sql/main", None)], JOB_MASTER)
    flat = flatten_parameters(request, master, dates)
    names = ["biz_dt", "process_from_date", "run_id"]
    document = flat.select(F.explode(F.map_concat(
        F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("string"))]), "context_params")).alias("param_key", "param_value"))
    defaults = literal_rows(t.spark, [("least", "1"), ("batch", "0")], "param_key STRING, param_value STRING")
    layers = merge_layers({"document": document, "default": defaults}, ["param_key"], "param_value")
    return {row.param_key: row.param_value for row in layers.collect()}


def _main_landed(t, counts=None):
    path = scratch_path(t.spark, "main-job")
    land(t.spark, _sources(t), [_in_file(t, stage) for stage in MAIN_JOB], path, _main_params(t), counts=counts)
    return read_orc(t.spark, path, MAIN_SCHEMA)


MAIN_SQL = """
    latest AS (
        SELECT CAST(o_orderkey AS VARCHAR) AS run_id, date_trunc('month', o_orderdate) AS process_from_date FROM orders
        WHERE o_orderpriority = '1-URGENT' ORDER BY CAST(o_orderdate AS DATE) DESC, CAST(o_orderkey AS VARCHAR) DESC LIMIT 1),
    main AS (
        SELECT n_name AS nation, lower(p_brand) AS brand, CAST(count(*) AS BIGINT) AS transactions,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS value,
               max(o_orderdate) >= (SELECT process_from_date FROM latest) AS recent, 'N' AS change_indicator,
               strftime(o_orderdate, '%Y') AS biz_dt,
               CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'F' THEN 'EXPIRED' ELSE 'RESIDUAL' END AS biz_status
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey JOIN part ON p_partkey = l_partkey
        GROUP BY n_name, p_brand, o_orderstatus, strftime(o_orderdate, '%Y') HAVING count(*) >= 2)"""


@query(f"WITH {MAIN_SQL} SELECT *, (SELECT run_id FROM latest) AS run_id FROM main")
def multi_source_job(t):
    """Five sources through five stages to partitioned ORC, driven by a resolved parameter document."""
    return _main_landed(t)


@query(f"""
    WITH {MAIN_SQL}
    SELECT biz_dt, count(*) AS total_count, count(*) FILTER (biz_status = 'ACTIVE') AS active_count,
           count(*) FILTER (biz_status = 'EXPIRED') AS expired_count, count(*) FILTER (biz_status = 'RESIDUAL') AS residual_count
    FROM main GROUP BY biz_dt""")
def multi_source_breakdown(t):
    """Rows per partition and output of the same job, counted over what it wrote."""
    return partition_breakdown(_main_landed(t), ["biz_dt"], "biz_status", ["ACTIVE", "EXPIRED", "RESIDUAL"])


@query("""
    WITH priced_contracts AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem),
    joined_data AS (
        SELECT count(*) OVER (PARTITION BY l_orderkey, l_partkey) AS transactions, n_name, p_brand, o_orderstatus, strftime(o_orderdate, '%Y') AS year,
               row_number() OVER (PARTITION BY l_orderkey, l_partkey) AS n
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        JOIN nation ON n_nationkey = c_nationkey JOIN part ON p_partkey = l_partkey),
    aggregated_data AS (
        SELECT n_name FROM joined_data WHERE n = 1 GROUP BY n_name, p_brand, o_orderstatus, year HAVING sum(transactions) >= 2)
    SELECT CAST(place AS INTEGER) AS place, stage, CASE place
        WHEN 1 THEN (SELECT count(*) FROM priced_contracts) WHEN 2 THEN (SELECT count(*) FROM joined_data WHERE n = 1)
        ELSE (SELECT count(*) FROM aggregated_data) END AS rows
    FROM (VALUES (1, 'priced_contracts'), (2, 'joined_data'), (3, 'aggregated_data'), (4, 'transformed_data'), (5, 'landed_data')) AS s(place, stage)""")
def stage_counts(t):
    """Rows of all five stages of the main job, from the write of the last one."""
    counts = StageCounts()
    _main_landed(t, counts)
    return counts.table(t.spark)


@query("""
    WITH big AS (SELECT * FROM orders WHERE o_totalprice > 100000),
    totals AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS total FROM big GROUP BY o_custkey)
    SELECT CAST(place AS INTEGER) AS place, stage, CASE place
        WHEN 1 THEN (SELECT count(*) FROM big) WHEN 2 THEN (SELECT count(*) FROM totals) WHEN 3 THEN (SELECT count(*) FROM big)
        WHEN 4 THEN (SELECT count(*) FROM big WHERE o_orderstatus = 'O') WHEN 5 THEN (SELECT count(*) FROM big WHERE o_orderstatus = 'F') END AS rows
    FROM (VALUES (1, 'big'), (2, 'totals'), (3, 'shares'), (4, 'active'), (5, 'expired'), (6, 'unread')) AS s(place, stage)""")
def shared_stage_counts(t):
    """Stages that several later ones read count once; one that leads to no output has no count."""
    _views(t)
    stages = [
        Stage("big", sql="SELECT * FROM contracts WHERE o_totalprice > ${least}"),
        Stage("totals", sql="SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS total FROM big GROUP BY o_custkey"),
        Stage("shares", sql="SELECT o_orderkey, o_orderstatus, CAST(o_totalprice / total AS DOUBLE) AS share FROM big JOIN totals USING (o_custkey)"),
        Stage("active", sql="SELECT * FROM shares WHERE o_orderstatus = 'O'"),
        Stage("expired", sql="SELECT * FROM shares WHERE o_orderstatus = 'F'"),
        Stage("unread", sql="SELECT * FROM shares WHERE o_orderstatus = 'P'"),
    ]
    counts = StageCounts()
    frames = run_stages(t.spark, stages, {"least": 100000}, counts)
    written = union_outputs([frames["active"], frames["expired"]])
    write_df(written, scratch_path(t.spark, "shares"), mode="overwrite")
    counts.settle(written)
    return counts.table(t.spark)
