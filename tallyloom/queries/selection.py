"""Projection, filters, row selection, sort and top-k."""

from pyspark.sql import functions as F

from tallyloom.operators import selection as sel
from tallyloom.queries.registry import query


@query("p1_project_rename_drop", """
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice
    FROM orders""")
def project(t):
    return (
        t.orders.withColumnsRenamed({"o_orderkey": "order_id", "o_custkey": "customer_id"})
        .drop("o_orderstatus", "o_orderdate", "o_orderpriority")
    )


@query("p2_boolean_filter", """
    SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
    WHERE o_totalprice BETWEEN 50000 AND 150000
      AND (o_orderstatus = 'F' OR o_orderpriority = '1-URGENT')
      AND NOT (o_custkey % 2 = 0)""")
def boolean_filter(t):
    return t.orders.filter(
        F.col("o_totalprice").between(50000, 150000)
        & ((F.col("o_orderstatus") == "F") | (F.col("o_orderpriority") == "1-URGENT"))
        & ~(F.col("o_custkey") % 2 == 0)
    ).select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("p2_not_equal_keeps_null", """
    WITH o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS status
               FROM orders)
    SELECT o_orderkey, status FROM o WHERE status IS DISTINCT FROM 'F'""")
def not_equal_keeps_null(t):
    status = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus"))
    return sel.not_equal(t.orders.select("o_orderkey", status.alias("status")), "status", "F")


@query("p3_label_slice", """
    SELECT c_custkey, c_name, c_mktsegment FROM customer
    WHERE c_name >= 'Customer#000000020' AND c_name <= 'Customer#000000090' AND c_acctbal > 0""")
def label_slice(t):
    rows = sel.label_slice(t.customer, "c_name", "Customer#000000020", "Customer#000000090")
    return rows.filter(F.col("c_acctbal") > 0).select("c_custkey", "c_name", "c_mktsegment")


@query("p4_positional_slice", """
    SELECT o_orderkey, o_custkey FROM (
      SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
    WHERE rn > 10 AND rn <= 30""")
def positional_slice(t):
    return sel.positional_slice(
        t.orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10, 30, 0, 2
    )


@query("p5_membership", """
    SELECT p_partkey, p_brand, p_size FROM part
    WHERE p_brand IN ('Brand#1', 'Brand#7', 'Brand#13') AND p_size NOT IN (1, 2, 3)""")
def membership(t):
    return t.part.filter(
        F.col("p_brand").isin("Brand#1", "Brand#7", "Brand#13") & ~F.col("p_size").isin(1, 2, 3)
    ).select("p_partkey", "p_brand", "p_size")


@query("p6_parameter_filter", """
    SELECT event_id, user_id, value FROM events
    WHERE date_trunc('day', ts) = COALESCE(CAST(NULL AS TIMESTAMP),
                                           (SELECT max(date_trunc('day', ts)) FROM events))""")
def parameter_filter(t):
    return sel.at_or_latest(t.events, F.date_trunc("day", "ts").cast("timestamp_ntz"), None).select(
        "event_id", "user_id", "value"
    )


@query("p7_text_length", """
    SELECT doc_id, CAST(length(trim(text)) AS BIGINT) AS text_length FROM documents
    WHERE length(trim(text)) > 0""")
def text_length(t):
    length = F.length(F.trim("text"))
    return t.documents.filter(length > 0).select("doc_id", length.cast("long").alias("text_length"))


@query("p8_select_by_type", """
    SELECT c_custkey, c_nationkey, c_acctbal FROM customer""")
def select_by_type(t):
    return sel.columns_of(t.customer, "number")


@query("o1_multi_key_order", """
    SELECT o_orderkey, o_custkey, o_orderdate FROM (
      SELECT o_orderkey, CASE WHEN o_custkey % 5 <> 0 THEN CAST(o_custkey AS DOUBLE) END AS o_custkey, o_orderdate
      FROM orders)
    ORDER BY o_custkey DESC NULLS LAST, o_orderdate, o_orderkey""")
def multi_key_order(t):
    key = F.when(F.col("o_custkey") % 5 != 0, F.col("o_custkey").cast("double")).alias("o_custkey")
    return t.orders.select("o_orderkey", key, "o_orderdate").orderBy(
        F.col("o_custkey").desc_nulls_last(), "o_orderdate", "o_orderkey"
    )


@query("o2_head_and_tail", """
    (SELECT 'head' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10)
    UNION ALL
    (SELECT 'tail' AS part, o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 9)""")
def head_and_tail(t):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    head = rows.orderBy("o_orderkey").limit(10).select(F.lit("head").alias("part"), "*")
    tail = rows.orderBy(F.col("o_orderkey").desc()).limit(9).select(F.lit("tail").alias("part"), "*")
    return head.unionByName(tail)


@query("o3_top_k", """
    SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events
    GROUP BY user_id HAVING sum(value) > 0 ORDER BY total DESC, user_id LIMIT 12""")
def top_k(t):
    return (
        t.events.groupBy("user_id")
        .agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
        .filter(F.col("total") > 0)
        .orderBy(F.col("total").desc(), "user_id")
        .limit(12)
    )


@query("o4_top_k_per_group", """
    SELECT o_orderpriority, o_orderkey, o_totalprice, rn FROM (
      SELECT *, row_number() OVER (PARTITION BY o_orderpriority
                                   ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
    WHERE rn <= 3""")
def top_k_per_group(t):
    return sel.top_k_per_group(
        t.orders, ["o_orderpriority"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3
    ).select("o_orderpriority", "o_orderkey", "o_totalprice", "rn")


@query("o5_sort_by_absolute", """
    SELECT c_custkey, c_acctbal, abs(c_acctbal) AS magnitude FROM customer
    ORDER BY abs(c_acctbal) DESC, c_custkey LIMIT 25""")
def sort_by_absolute(t):
    return (
        t.customer.select("c_custkey", "c_acctbal", F.abs("c_acctbal").alias("magnitude"))
        .orderBy(F.col("magnitude").desc(), "c_custkey")
        .limit(25)
    )
