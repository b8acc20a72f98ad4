"""Projection, filter, split, join, aggregate, upsert and quality queries."""

from pyspark.sql import functions as F

from moorline.functions import context_field, context_map, json_context, json_is_malformed, malformed, parsed_json, split_list
from moorline.operators import (
    RESIDUAL,
    Dimension,
    Measure,
    bind_constants,
    date_window,
    detect_changes,
    equal_to,
    grouped_measures,
    inject_defaults,
    iso_record,
    json_record,
    label_status,
    latest_per_key,
    lookup_join,
    null_profile,
    partition_breakdown,
    repeated_keys,
    require_values,
    split_by_status,
    star_join,
    table_sample,
    total_count,
    typed_keys,
    union_outputs,
    unmatched,
    upsert,
    validate_non_null,
    verify_tables,
    with_derived,
)
from moorline.queries.registry import query
from moorline.session import apply_profile, materialize

# Business status of an order code; other codes are residual.
OUTPUTS = {"ACTIVE": ["o"], "EXPIRED": ["f"]}


@query("""
    SELECT o_custkey AS customer_id, o_orderkey AS contract_id, o_orderstatus AS status, o_totalprice AS amount,
           '2025-05-31' AS biz_dt, '2025-05-01' AS etl_start_dt, '2025-05-31' AS etl_end_dt,
           'active' AS biz_status, 'Y' AS change_indicator,
           upper(o_orderpriority) AS entity_new, c_acctbal AS premium_amt
    FROM orders JOIN customer ON c_custkey = o_custkey""", name="lookup_join")
def lookup_join_constants(t):
    contracts = t.orders.select(
        F.col("o_custkey").alias("customer_id"), F.col("o_orderkey").alias("contract_id"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"), "o_orderpriority",
    )
    lookup = t.customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_acctbal").alias("premium_amt"))
    joined = lookup_join(contracts, lookup, ["customer_id"])
    run = {"biz_dt": "2025-05-31", "etl_start_dt": "2025-05-01", "etl_end_dt": "2025-05-31",
           "biz_status": "active", "change_indicator": "Y"}
    return with_derived(bind_constants(joined, run), entity_new=F.upper("o_orderpriority")).drop("o_orderpriority")


@query("SELECT *, reverse(c_name) AS derived_business_col FROM customer WHERE c_mktsegment = 'BUILDING'")
def star_derived(t):
    chosen = t.customer.where(equal_to({"c_mktsegment": "BUILDING"}))
    return with_derived(chosen, derived_business_col=F.reverse("c_name"))


@query("""
    SELECT o_orderkey AS contract_id, o_orderstatus AS biz_status, '2025-05-31' AS biz_dt, 'N' AS change_indicator
    FROM orders""")
def default_columns(t):
    contracts = t.orders.select(F.col("o_orderkey").alias("contract_id"), F.col("o_orderstatus").alias("biz_status"))
    return inject_defaults(contracts, "2025-05-31")


@query("SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def conjunctive_filter(t):
    return t.orders.where(equal_to({"o_orderstatus": "F", "o_orderpriority": "1-URGENT"}))


@query("""
    SELECT *, CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' ELSE 'EXPIRED' END AS biz_status
    FROM orders WHERE o_orderstatus IN ('O', 'F')""")
def status_split_union(t):
    return label_status(t.orders, "o_orderstatus", OUTPUTS).where(F.col("biz_status") != RESIDUAL)


@query("""
    SELECT *, 'RESIDUAL' AS biz_status FROM orders WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('O', 'F')""")
def split_residual(t):
    return split_by_status(t.orders, "o_orderstatus", OUTPUTS)[RESIDUAL]


@query("""
    SELECT c_custkey AS party_id, c_name AS party_name, c_nationkey AS nation_id FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_nationkey FROM supplier""")
def union_by_name(t):
    customers = t.customer.selectExpr("c_custkey AS party_id", "c_name AS party_name", "c_nationkey AS nation_id")
    suppliers = t.supplier.selectExpr("s_nationkey AS nation_id", "s_suppkey AS party_id", "s_name AS party_name")
    return union_outputs([customers, suppliers])


@query("SELECT * FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '1996-02-01'", name="date_window")
def date_range(t):
    return date_window(t.orders, "o_orderdate", "1996-01-01", "1996-01-31")


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate, o_orderstatus, o_orderdate,
           c_name, c_mktsegment, n_name, r_name, p_name, p_brand
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
    JOIN part ON p_partkey = l_partkey""", name="star_join")
def star_join_sources(t):
    # The contract side is put together first, so the transactions are shuffled once for
    # it, and after the part lookup, which adds fewer columns to that shuffle.
    portfolio = lookup_join(t.nation, t.region, {"n_regionkey": "r_regionkey"}, ["r_name"])
    contracts = star_join(
        t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"),
        [
            Dimension(t.customer, {"o_custkey": "c_custkey"}, ["c_name", "c_mktsegment", "c_nationkey"]),
            Dimension(portfolio, {"c_nationkey": "n_nationkey"}, ["n_name", "r_name"]),
        ],
    )
    joined = star_join(
        t.lineitem,
        [
            Dimension(t.part, {"l_partkey": "p_partkey"}, ["p_name", "p_brand"]),
            Dimension(contracts, {"l_orderkey": "o_orderkey"},
                      ["o_orderstatus", "o_orderdate", "c_name", "c_mktsegment", "n_name", "r_name"]),
        ],
    )
    return joined.drop("l_partkey", "l_suppkey", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


@query("""
    SELECT o_custkey, l_partkey, count(amount) AS amount_count, CAST(sum(amount) AS DOUBLE) AS amount_sum,
           CAST(min(amount) AS DOUBLE) AS amount_min, CAST(max(amount) AS DOUBLE) AS amount_max
    FROM (SELECT o_custkey, l_partkey, CAST(l_extendedprice AS DECIMAL(18, 2)) AS amount
          FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
    GROUP BY o_custkey, l_partkey HAVING sum(amount) > 50000""")
def grouped_agg_having(t):
    sales = lookup_join(t.lineitem, t.orders, {"l_orderkey": "o_orderkey"}, ["o_custkey"]).select(
        "o_custkey", "l_partkey", F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"))
    report = grouped_measures(sales, ["o_custkey", "l_partkey"], [Measure("amount", "amount")], "amount_sum > 50000")
    return report.withColumns({f"amount_{m}": F.col(f"amount_{m}").cast("double") for m in ("sum", "min", "max")})


@query("""
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS biz_dt, count(*) AS total_count,
           count(*) FILTER (o_orderstatus = 'O') AS active_count, count(*) FILTER (o_orderstatus = 'F') AS expired_count,
           count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) AS residual_count
    FROM orders GROUP BY 1""", name="partition_breakdown")
def breakdown_by_date(t):
    dated = t.orders.select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("biz_dt"), "o_orderstatus")
    labelled = label_status(dated, "o_orderstatus", OUTPUTS)
    return partition_breakdown(labelled, ["biz_dt"], "biz_status", [*OUTPUTS, RESIDUAL])


@query("SELECT count(*) AS row_count FROM lineitem", name="total_count")
def row_count(t):
    return total_count(t.lineitem)


@query("""
    SELECT user_id, event_id, ts, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""", name="latest_per_key")
def latest_record(t):
    return latest_per_key(t.events, ["user_id"], ["ts", "event_id"])


@query("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_n(t):
    return table_sample(t.orders, 10, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@query("""
    WITH revised AS (
        SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, c_mktsegment FROM customer WHERE c_acctbal < 0
        UNION ALL SELECT -1 - s_suppkey, s_name, s_nationkey, s_acctbal, 'SUPPLIER' FROM supplier)
    SELECT * FROM revised
    UNION ALL SELECT * FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM revised)""")
def keyed_upsert(t):
    overdrawn = t.customer.where("c_acctbal < 0")
    suppliers = t.supplier.selectExpr(
        "-1 - s_suppkey AS c_custkey", "s_name AS c_name", "s_nationkey AS c_nationkey", "s_acctbal AS c_acctbal",
        "'SUPPLIER' AS c_mktsegment", "2 AS version")
    batch = [overdrawn.withColumns({"c_acctbal": F.col("c_acctbal") + F.lit(v * 50.0), "version": F.lit(v)}) for v in (1, 2)]
    return upsert(t.customer, union_outputs([*batch, suppliers]), ["c_custkey"], ["version"])


@query("""
    WITH previous AS (SELECT * FROM orders WHERE o_orderdate < DATE '2000-01-01'),
    current AS (
        SELECT * REPLACE (CASE o_orderpriority WHEN '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
        FROM orders WHERE o_orderdate >= DATE '1996-01-01')
    SELECT coalesce(c.o_orderkey, p.o_orderkey) AS o_orderkey, coalesce(c.o_custkey, p.o_custkey) AS o_custkey,
           coalesce(c.o_orderstatus, p.o_orderstatus) AS o_orderstatus,
           coalesce(c.o_totalprice, p.o_totalprice) AS o_totalprice,
           coalesce(c.o_orderdate, p.o_orderdate) AS o_orderdate,
           coalesce(c.o_orderpriority, p.o_orderpriority) AS o_orderpriority,
           CASE WHEN p.o_orderkey IS NULL THEN 'I' WHEN c.o_orderkey IS NULL THEN 'D'
                WHEN p.o_totalprice IS DISTINCT FROM c.o_totalprice THEN 'U' ELSE 'N' END AS change_type,
           CASE WHEN p.o_orderkey IS NOT NULL AND c.o_orderkey IS NOT NULL
                 AND p.o_totalprice IS NOT DISTINCT FROM c.o_totalprice THEN 'N' ELSE 'Y' END AS change_indicator
    FROM previous p FULL JOIN current c ON p.o_orderkey = c.o_orderkey""")
def change_detection(t):
    previous = t.orders.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("date"))
    raised = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    current = t.orders.where(F.col("o_orderdate") >= F.lit("1996-01-01").cast("date")).withColumn("o_totalprice", raised)
    return detect_changes(previous, current, ["o_orderkey"], ["o_custkey", "o_orderstatus", "o_totalprice"])


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, false AS malformed FROM events", name="json_context")
def json_context_values(t):
    context = json_context("props")
    return t.events.select("event_id", F.try_element_at(context, F.lit("k")).alias("k"),
                           json_is_malformed("props").alias("malformed"))


@query("""
    WITH texts AS (
        SELECT event_id, CASE event_id % 5 WHEN 0 THEN left(props, length(props) - 1) WHEN 1 THEN NULL WHEN 2 THEN ' ' WHEN 3 THEN '[' || props || ']'
            ELSE '{"n": ' || event_id || ', "of": ' || props || '}' END AS context FROM events)
    SELECT event_id, event_id % 5 = 4 AS has_fields, CASE event_id % 5 WHEN 4 THEN event_id END AS n,
           CASE event_id % 5 WHEN 4 THEN CAST(event_id AS VARCHAR) END AS n_text,
           CASE event_id % 5 WHEN 4 THEN json_extract_string(context, '$.of.k') END AS k,
           event_id % 5 = 0 AS malformed FROM texts""")
def variant_context(t):
    """Contexts parsed once: typed and nested fields, the map and the flag; a fifth of them is cut short, a fifth is a list."""
    texts = F.when(F.col("event_id") % 5 == 0, F.expr("left(props, length(props) - 1)")).when(F.col("event_id") % 5 == 1, F.lit(None)).when(
        F.col("event_id") % 5 == 2, " ").when(F.col("event_id") % 5 == 3, F.concat(F.lit("["), "props", F.lit("]"))).otherwise(
        F.concat(F.lit('{"n": '), "event_id", F.lit(', "of": '), "props", F.lit("}")))
    parsed = t.events.select("event_id", texts.alias("context")).withColumn("parsed", parsed_json("context"))
    return parsed.select(
        "event_id", context_map("parsed").isNotNull().alias("has_fields"), context_field("parsed", "n", "bigint").alias("n"),
        F.try_element_at(context_map("parsed"), F.lit("n")).alias("n_text"), F.try_variant_get("parsed", "$.of.k", "string").alias("k"),
        malformed("context", "parsed").alias("malformed"))


@query("""
    SELECT event_id, user_id, event_type, value, props,
           regexp_replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '\\.000000$', '') AS ts FROM events""", name="iso_record")
def iso_records(t):
    return iso_record(t.events)


@query("""
    SELECT to_json(struct_pack(o_orderkey := o_orderkey, o_orderstatus := o_orderstatus,
                               o_orderdate := strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')))::VARCHAR AS record
    FROM orders""", name="json_record")
def json_records(t):
    return json_record(t.orders.select("o_orderkey", "o_orderstatus", "o_orderdate"))


@query("""
    SELECT p_partkey, CAST(item AS VARCHAR) AS item FROM (
        SELECT p_partkey, unnest([trim(x) FOR x IN string_split(concat(p_brand, ' , ', p_type, ',  ', p_name), ',')]) AS item
        FROM part)""")
def csv_list_split(t):
    listed = F.concat("p_brand", F.lit(" , "), "p_type", F.lit(",  "), "p_name")
    return t.part.select("p_partkey", F.explode(split_list(listed)).alias("item"))


@query("""
    SELECT event_id, user_id AS customer_id, event_type, c_name FROM events JOIN customer ON c_custkey = user_id
    WHERE event_type <> 'error'
    UNION ALL SELECT event_id, NULL, event_type, 'rejected' FROM events WHERE event_type = 'error'""")
def typed_key_lookup(t):
    # Error events carry text where the others carry a customer number.
    key = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.col("user_id").cast("string"))
    flow = t.events.select("event_id", key.alias("customer_id"), "event_type")
    good, rejected = typed_keys(flow, {"customer_id": "bigint"})
    joined = lookup_join(good, t.customer, {"customer_id": "c_custkey"}, ["c_name"])
    marked = rejected.withColumns({"customer_id": F.lit(None).cast("bigint"), "c_name": F.lit("rejected")})
    return union_outputs([joined, marked])


@query("""
    SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def unmatched_lookup(t):
    return unmatched(t.orders, t.customer.where("c_mktsegment = 'BUILDING'"), {"o_custkey": "c_custkey"})


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber
    HAVING count(*) > 1""")
def repeated_lookup_keys(t):
    return repeated_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
    SELECT count(*) AS row_count, count(*) FILTER (o_orderkey IS NULL) AS o_orderkey_nulls,
           count(*) FILTER (o_custkey IS NULL) AS o_custkey_nulls,
           count(*) FILTER (o_orderstatus IS NULL) AS o_orderstatus_nulls,
           count(*) FILTER (o_totalprice IS NULL) AS o_totalprice_nulls,
           count(*) FILTER (o_orderdate IS NULL) AS o_orderdate_nulls,
           count(*) FILTER (o_orderpriority IS NULL) AS o_orderpriority_nulls
    FROM orders""", name="null_profile")
def null_counts(t):
    return null_profile(t.orders)


@query("""
    WITH joined AS (
        SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
    SELECT 'doc_id' AS column_name, count(*) FILTER (doc_id IS NULL) AS null_count,
           count(*) FILTER (doc_id IS NULL) = 0 AS passed FROM joined
    UNION ALL SELECT 'quality', count(*) FILTER (quality IS NULL), count(*) FILTER (quality IS NULL) = 0 FROM joined
    UNION ALL SELECT 'toxic', count(*) FILTER (toxic IS NULL), count(*) FILTER (toxic IS NULL) = 0 FROM joined""", name="validate_non_null")
def non_null_validation(t):
    documents = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return validate_non_null(documents, ["doc_id", "quality", "toxic"])


# Each given table with the columns that order its sample.
TABLES = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"], "supplier": ["s_suppkey"], "part": ["p_partkey"],
    "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"], "events": ["event_id"], "documents": ["doc_id"],
    "embeddings": ["vec_id"], "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id"], "conversations": ["conv_id", "turn"],
}


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count,"
        f" (SELECT string_agg(column_name || ' ' || data_type, ', ' ORDER BY column_name) FROM duckdb_columns() WHERE table_name = '{name}') AS table_columns,"
        f" (SELECT string_agg(k, ',' ORDER BY n) FROM (SELECT {keys[0]} AS k, row_number() OVER (ORDER BY {', '.join(keys)}) AS n FROM {name})"
        f" WHERE n <= 5) AS sample_keys, NULL AS error FROM {name}"
        for name, keys in TABLES.items()
    ) + " UNION ALL SELECT 'archive', NULL, NULL, NULL, 'PATH_NOT_FOUND'"
)
def table_verification(t):
    report = verify_tables(t.spark, {n: lambda n=n: getattr(t, n) for n in [*TABLES, "archive"]}, order_by=TABLES)
    keys = F.create_map(*[F.lit(x) for name, columns in TABLES.items() for x in (name, f"$.{columns[0]}")])
    # What the types are called in SQL.
    names = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "array<float>": "FLOAT[]"}
    types = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    fields = F.split(F.regexp_extract("table_schema", r"^struct<(.*)>$", 1), ",(?=[a-z_]+:)")
    columns = F.array_sort(F.transform(fields, lambda f: F.concat(
        F.split_part(f, F.lit(":"), F.lit(1)), F.lit(" "), F.try_element_at(types, F.split_part(f, F.lit(":"), F.lit(2))))))
    return report.withColumn("key", F.try_element_at(keys, "table_name")).select(
        "table_name", "row_count", F.array_join(columns, ", ").alias("table_columns"),
        F.expr("array_join(transform(sample, r -> get_json_object(r, key)), ',')").alias("sample_keys"), "error",
    )


@query("SELECT o_orderkey, o_orderdate FROM orders")
def required_values(t):
    """Rows pass if none lacks a required value."""
    return require_values(t.orders, ["o_orderdate", "o_custkey"]).select("o_orderkey", "o_orderdate")


@query("SELECT o_orderstatus, count(*) AS row_count, 100 AS width FROM orders GROUP BY o_orderstatus")
def profiled_count(t):
    """An aggregate written under a profile, whose settings are put back afterwards."""
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled",
             "spark.sql.adaptive.forceOptimizeSkewedJoin"]
    before = {name: t.spark.conf.get(name, None) for name in names}
    try:
        width = apply_profile(t.spark, "small")
        counts = t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("row_count"), F.lit(width).alias("width"))
        return materialize(counts, "profiled")[0]
    finally:
        for name, value in before.items():
            t.spark.conf.unset(name) if value is None else t.spark.conf.set(name, value)
