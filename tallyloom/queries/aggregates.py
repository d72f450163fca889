"""Aggregation."""

from pyspark.sql import functions as F

from tallyloom.operators import aggregates as ag
from tallyloom.plans.ordering import exact_quantiles
from tallyloom.queries.registry import query


@query("a1_group_count", """
    SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL""")
def group_count(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("a2_named_aggregates", """
    SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
           round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue,
           round(avg(l_discount), 6) AS avg_discount, min(l_quantity) AS min_qty,
           max(l_extendedprice) AS max_price, count(*) AS n
    FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY ALL""")
def named_aggregates(t):
    return (
        t.lineitem.filter(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
            F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
            F.round(F.avg("l_discount"), 6).alias("avg_discount"),
            F.min("l_quantity").alias("min_qty"),
            F.max("l_extendedprice").alias("max_price"),
            F.count("*").alias("n"),
        )
    )


@query("a3_having", """
    SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS spent FROM orders
    GROUP BY o_custkey HAVING count(*) > 12""")
def having(t):
    return (
        t.orders.groupBy("o_custkey")
        .agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("spent"))
        .filter(F.col("n") > 12)
    )


@query("a4_conditional_aggregate", """
    SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS errors,
           round(COALESCE(sum(value) FILTER (WHERE event_type = 'purchase'), 0), 2) AS spent
    FROM events GROUP BY user_id""")
def conditional_aggregate(t):
    bought = F.when(F.col("event_type") == "purchase", F.col("value"))
    return t.events.groupBy("user_id").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
        F.round(F.coalesce(F.sum(bought), F.lit(0.0)), 2).alias("spent"),
    )


@query("a5_distinct_count", """
    SELECT event_type, count(DISTINCT user_id) AS users,
           count(DISTINCT user_id) FILTER (WHERE value > 100) AS big_users
    FROM events GROUP BY event_type""")
def distinct_count(t):
    return t.events.groupBy("event_type").agg(
        F.count_distinct("user_id").alias("users"),
        F.count_distinct(F.when(F.col("value") > 100, F.col("user_id"))).alias("big_users"),
    )


@query("a5_distinct_with_null", """
    SELECT count(DISTINCT status) + CAST(max(CASE WHEN status IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n
    FROM (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS status FROM orders)""")
def distinct_with_null(t):
    status = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus"))
    return t.orders.select(status.alias("status")).agg(ag.distinct_with_null("status").alias("n"))


@query("a6_null_accounting", """
    WITH j AS (SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders
               ON o_custkey = c_custkey AND o_totalprice > 400000)
    SELECT count(*) AS all_rows, count(o_orderkey) AS matched,
           count(*) - count(o_orderkey) AS unmatched, count(DISTINCT c_custkey) AS customers FROM j""")
def null_accounting(t):
    big = t.orders.filter(F.col("o_totalprice") > 400000)
    joined = t.customer.join(big, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.agg(
        F.count("*").alias("all_rows"),
        F.count("o_orderkey").alias("matched"),
        (F.count("*") - F.count("o_orderkey")).alias("unmatched"),
        F.count_distinct("c_custkey").alias("customers"),
    )


@query("a7_scalar_latest", """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""")
def scalar_latest(t):
    latest = t.orders.select(F.max("o_orderdate")).scalar()
    return t.orders.filter(F.col("o_orderdate") == latest).select("o_orderkey", "o_totalprice")


@query("a8_value_counts", """
    WITH s AS (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS value FROM orders)
    SELECT value, count(*) AS n,
           round(count(*) / (SELECT count(*) FROM s WHERE value IS NOT NULL), 6) AS share
    FROM s WHERE value IS NOT NULL GROUP BY value""")
def value_counts(t):
    value = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority")).alias("value")
    return ag.value_counts(t.orders.select(value), "value").select(
        "value", "n", F.round("share", 6).alias("share")
    )


@query("a9_cross_tab", """
    SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS F,
           count(*) FILTER (WHERE o_orderstatus = 'O') AS O,
           count(*) FILTER (WHERE o_orderstatus = 'P') AS P
    FROM orders GROUP BY o_orderpriority""")
def cross_tab(t):
    return ag.cross_tab(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"])


@query("a10_describe", """
    SELECT o_orderpriority, count(o_totalprice) AS n, round(avg(o_totalprice), 4) AS mean,
           round(stddev_samp(o_totalprice), 4) AS std, min(o_totalprice) AS min,
           round(quantile_cont(o_totalprice, 0.25), 4) AS q25,
           round(median(o_totalprice), 4) AS median,
           round(quantile_cont(o_totalprice, 0.75), 4) AS q75, max(o_totalprice) AS max
    FROM orders GROUP BY o_orderpriority""")
def describe(t):
    return ag.describe(t.orders, "o_totalprice", ["o_orderpriority"], 4)


@query("a10_global_quantiles", """
    SELECT round(quantile_cont(l_extendedprice, 0.05), 4) AS p05,
           round(median(l_extendedprice), 4) AS p50,
           round(quantile_cont(l_extendedprice, 0.95), 4) AS p95 FROM lineitem""")
def global_quantiles(t):
    found = exact_quantiles(t.lineitem, "l_extendedprice", {"p05": 0.05, "p50": 0.5, "p95": 0.95})
    return found.select(*[F.round(c, 4).alias(c) for c in found.columns])


@query("a11_correlation", """
    SELECT 'l_quantity' AS a, 'l_extendedprice' AS b, round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem
    UNION ALL SELECT 'l_quantity', 'l_discount', round(corr(l_quantity, l_discount), 6) FROM lineitem
    UNION ALL SELECT 'l_quantity', 'l_tax', round(corr(l_quantity, l_tax), 6) FROM lineitem
    UNION ALL SELECT 'l_extendedprice', 'l_discount', round(corr(l_extendedprice, l_discount), 6) FROM lineitem
    UNION ALL SELECT 'l_extendedprice', 'l_tax', round(corr(l_extendedprice, l_tax), 6) FROM lineitem
    UNION ALL SELECT 'l_discount', 'l_tax', round(corr(l_discount, l_tax), 6) FROM lineitem""")
def correlation(t):
    pairs = ag.correlations(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return pairs.select("a", "b", F.round("r", 6).alias("r"))


@query("a12_group_mean_difference", """
    SELECT l_linestatus, round(avg(l_quantity) FILTER (WHERE l_returnflag = 'R'), 4) AS wrong_mean,
           round(avg(l_quantity) FILTER (WHERE l_returnflag <> 'R'), 4) AS right_mean,
           round(100 * (avg(l_quantity) FILTER (WHERE l_returnflag = 'R')
                      - avg(l_quantity) FILTER (WHERE l_returnflag <> 'R'))
                     / avg(l_quantity) FILTER (WHERE l_returnflag <> 'R'), 4) AS percent
    FROM lineitem GROUP BY l_linestatus""")
def group_mean_difference(t):
    found = ag.mean_difference(t.lineitem, ["l_linestatus"], "l_quantity", F.col("l_returnflag") == "R")
    return found.select("l_linestatus", *[F.round(c, 4).alias(c) for c in ("wrong_mean", "right_mean", "percent")])


@query("a13_histogram", """
    WITH b AS (SELECT event_type, CASE WHEN value < 0 THEN -1 WHEN value > 500 THEN 20
                      ELSE least(CAST(floor((value - 0) / 25.0) AS BIGINT), 19) END AS bin
               FROM events WHERE value IS NOT NULL)
    SELECT event_type, bin, count(*) AS n,
           CASE WHEN bin BETWEEN 0 AND 19 THEN
               round(count(*) / (sum(CASE WHEN bin BETWEEN 0 AND 19 THEN count(*) END) OVER (PARTITION BY event_type) * 25.0), 8) END AS density
    FROM b GROUP BY event_type, bin""")
def histogram(t):
    return ag.histogram(t.events, "value", 0.0, 500.0, 20, ["event_type"]).select(
        "event_type", "bin", "n", F.round("density", 8).alias("density")
    )


@query("a14_rows_with_any_null", """
    SELECT count(*) AS n FROM (
      SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS a,
             CASE WHEN o_custkey % 11 <> 0 THEN o_totalprice END AS b FROM orders)
    WHERE a IS NULL OR b IS NULL""")
def rows_with_any_null(t):
    rows = t.orders.select(
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("a"),
        F.when(F.col("o_custkey") % 11 != 0, F.col("o_totalprice")).alias("b"),
    )
    return rows.agg(F.count_if(ag.any_null(rows.columns)).alias("n"))


@query("a15_run_summary", """
    SELECT event_type AS source, CASE WHEN value > 100 THEN 'success' ELSE 'failed' END AS status,
           count(*) AS runs, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total_rows,
           max(ts) AS latest_start
    FROM events GROUP BY ALL""")
def run_summary(t):
    return (
        t.events.groupBy(
            F.col("event_type").alias("source"),
            F.when(F.col("value") > 100, "success").otherwise("failed").alias("status"),
        )
        .agg(
            F.count("*").alias("runs"),
            F.sum(F.get_json_object("props", "$.k").cast("long")).alias("total_rows"),
            F.max("ts").alias("latest_start"),
        )
    )


@query("a16_rollup", """
    SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag, l_linestatus) AS BIGINT) AS level,
           round(sum(l_quantity), 2) AS qty FROM lineitem
    GROUP BY ROLLUP (l_returnflag, l_linestatus)""")
def rollup(t):
    return t.lineitem.rollup("l_returnflag", "l_linestatus").agg(
        F.grouping_id().cast("long").alias("level"), F.round(F.sum("l_quantity"), 2).alias("qty")
    )


@query("a16_cube", """
    SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders
    GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def cube(t):
    return t.orders.cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("a16_grouping_sets", """
    SELECT n_name, c_mktsegment, count(*) AS n, round(sum(c_acctbal), 2) AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    GROUP BY GROUPING SETS ((n_name), (c_mktsegment), ())""")
def grouping_sets(t):
    rows = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.groupingSets(
        [[F.col("n_name")], [F.col("c_mktsegment")], []], F.col("n_name"), F.col("c_mktsegment")
    ).agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
