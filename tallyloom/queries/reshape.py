"""Set operations and reshaping."""

from pyspark.sql import functions as F

from tallyloom.operators import reshape as rs
from tallyloom.queries.registry import query


@query("u1_union_all", """
    SELECT 'orders' AS source, count(*) AS n FROM orders
    UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'events', count(*) FROM events""")
def union_all(t):
    def audit(name):
        return getattr(t, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("source"), "n")

    return audit("orders").unionByName(audit("lineitem")).unionByName(audit("events"))


@query("u2_union_distinct", """
    SELECT c_nationkey AS area FROM customer UNION SELECT s_nationkey FROM supplier
    UNION SELECT n_nationkey FROM nation""")
def union_distinct(t):
    return (
        t.customer.select(F.col("c_nationkey").alias("area"))
        .union(t.supplier.select("s_nationkey"))
        .union(t.nation.select("n_nationkey"))
        .distinct()
    )


@query("u3_distinct_rows", """
    SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem""")
def distinct_rows(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity").distinct()


@query("u3_dedupe_by_key", """
    SELECT doc_id, lang, source, n_chars FROM (
      SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def dedupe_by_key(t):
    return rs.dedupe_text(t.documents, "text", "doc_id").select("doc_id", "lang", "source", "n_chars")


@query("u4_except_all", """
    SELECT l_suppkey, l_quantity FROM lineitem WHERE l_returnflag = 'R'
    EXCEPT ALL SELECT l_suppkey, l_quantity FROM lineitem WHERE l_linestatus = 'O'""")
def except_all(t):
    columns = ["l_suppkey", "l_quantity"]
    returned = t.lineitem.filter(F.col("l_returnflag") == "R").select(columns)
    return returned.exceptAll(t.lineitem.filter(F.col("l_linestatus") == "O").select(columns))


@query("u4_intersect", """
    SELECT c_nationkey AS nation FROM customer WHERE c_acctbal < 0
    INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal < 0""")
def intersect(t):
    poor = t.customer.filter(F.col("c_acctbal") < 0).select(F.col("c_nationkey").alias("nation"))
    return poor.intersect(t.supplier.filter(F.col("s_acctbal") < 0).select("s_nationkey"))


@query("u5_append_frames", """
    SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier""")
def append_frames(t):
    customers = t.customer.select(
        F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = t.supplier.select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return customers.unionByName(suppliers, allowMissingColumns=True)


@query("u6_pivot", """
    SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS click,
           count(*) FILTER (WHERE event_type = 'error') AS error,
           count(*) FILTER (WHERE event_type = 'purchase') AS purchase,
           count(*) FILTER (WHERE event_type = 'signup') AS signup,
           count(*) FILTER (WHERE event_type = 'view') AS view FROM events GROUP BY user_id""")
def pivot(t):
    return (
        t.events.groupBy("user_id").pivot("event_type", ["click", "error", "purchase", "signup", "view"]).count().na.fill(0)
    )


@query("u6_unpivot", """
    SELECT p_partkey, 'p_size' AS measure, CAST(p_size AS DOUBLE) AS value FROM part
    UNION ALL SELECT p_partkey, 'p_retailprice', p_retailprice FROM part""")
def unpivot(t):
    rows = t.part.select("p_partkey", F.col("p_size").cast("double").alias("p_size"), "p_retailprice")
    return rows.unpivot(["p_partkey"], ["p_size", "p_retailprice"], "measure", "value")


@query("u7_column_layout", """
    SELECT o_orderkey // 1000 AS block, count(*) AS n,
           list(o_custkey ORDER BY o_orderkey)[1] AS first_customer,
           round(list_sum(list(o_totalprice ORDER BY o_orderkey)), 2) AS total
    FROM orders GROUP BY o_orderkey // 1000""")
def column_layout(t):
    blocks = rs.to_column_blocks(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", 1000)
    return blocks.select(
        "block",
        F.size("o_orderkey").cast("long").alias("n"),
        F.element_at("o_custkey", 1).alias("first_customer"),
        F.round(F.aggregate("o_totalprice", F.lit(0.0), lambda a, x: a + x), 2).alias("total"),
    )


@query("u7_row_layout", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def row_layout(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return rs.from_column_blocks(rs.to_column_blocks(rows, "o_orderkey", 1000))
