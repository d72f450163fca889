"""Window functions."""

from pyspark.sql import functions as F

from tallyloom.operators import evaluation as ev
from tallyloom.operators import selection as sel
from tallyloom.operators import cleaning as cl
from tallyloom.operators import features as ft
from tallyloom.plans import ordering, timejoin
from tallyloom.queries.registry import query


@query("w1_surrogate_key", """
    WITH a AS (SELECT c_name AS area FROM customer UNION SELECT s_name FROM supplier
               UNION SELECT p_brand FROM part)
    SELECT row_number() OVER (ORDER BY area) AS area_id, area FROM a""")
def surrogate_key(t):
    areas = (
        t.customer.select(F.col("c_name").alias("area"))
        .union(t.supplier.select("s_name"))
        .union(t.part.select("p_brand"))
    )
    return ordering.surrogate_keys(areas, "area", "area_id")


@query("w2_top_one_per_group", """
    SELECT user_id, event_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rk
      FROM events) WHERE rk = 1""")
def top_one_per_group(t):
    rows = t.events.select("user_id", "event_id", "event_type", "value", "ts")
    return sel.best_per_group(rows, ["user_id"], [F.col("ts"), F.col("event_id")]).drop("ts")


@query("w3_group_transform", """
    SELECT o_orderkey, o_totalprice,
           round(median(o_totalprice) OVER (PARTITION BY o_orderpriority), 4) AS group_median
    FROM orders""")
def group_transform(t):
    return cl.with_group_median(t.orders, ["o_orderpriority"], "o_totalprice", "group_median").select(
        "o_orderkey", "o_totalprice", F.round("group_median", 4).alias("group_median")
    )


@query("w4_lag_demand", """
    WITH h AS (SELECT user_id, date_trunc('hour', ts) AS hr, count(*) AS n FROM events GROUP BY ALL),
         w AS (SELECT event_id, user_id, ts,
           count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 15 MINUTE PRECEDING AND CURRENT ROW) AS last_15m,
           count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 30 MINUTE PRECEDING AND CURRENT ROW) AS last_30m,
           count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 60 MINUTE PRECEDING AND CURRENT ROW) AS last_1h
           FROM events)
    SELECT event_id, last_15m, last_30m, last_1h, COALESCE(h.n, 0) AS same_hour_yesterday
    FROM w LEFT JOIN h ON h.user_id = w.user_id AND h.hr = date_trunc('hour', w.ts) - INTERVAL 1 DAY""")
def lag_demand(t):
    return ft.lag_demand(
        t.events, ["user_id"], "ts", {"last_15m": 900, "last_30m": 1800, "last_1h": 3600}
    ).select("event_id", "last_15m", "last_30m", "last_1h", "same_hour_yesterday")


@query("w5_rolling_features", """
    SELECT event_id,
      round(avg(value) OVER w, 4) AS rolling_avg, max(value) OVER w AS rolling_max,
      CASE WHEN max(epoch_us(ts)) OVER w - min(epoch_us(ts)) OVER w >= 60000000 THEN
        round(regr_slope(value, (epoch_us(ts) - 1704067200000000) / 3600000000.0) OVER w, 3) END AS trend_per_hour
    FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW)""")
def rolling_features(t):
    def measures(frame):
        w = frame(7200)
        spread = F.max(timejoin.micros("ts")).over(w) - F.min(timejoin.micros("ts")).over(w)
        hours = (timejoin.micros("ts") - F.lit(1704067200000000)) / F.lit(3.6e9)
        return {
            "rolling_avg": F.round(F.avg("value").over(w), 4),
            "rolling_max": F.max("value").over(w),
            # A trend needs points that are at least a minute apart.
            "trend_per_hour": F.when(
                spread >= 60_000_000, F.round(F.regr_slope(F.col("value"), hours).over(w), 3)
            ),
        }

    return timejoin.trailing_window(t.events, ["user_id"], "ts", 7200, measures).select(
        "event_id", "rolling_avg", "rolling_max", "trend_per_hour"
    )


@query("w6_cumulative_curve", """
    WITH s AS (SELECT n_chars AS score, quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
         v AS (SELECT score, count(*) AS n, sum(quality) AS pos FROM s GROUP BY score),
         c AS (SELECT score, sum(n) OVER (ORDER BY score DESC) AS flagged,
                      sum(pos) OVER (ORDER BY score DESC) AS hits, sum(pos) OVER () AS positives FROM v)
    SELECT CAST(score AS DOUBLE) AS score, CAST(flagged AS BIGINT) AS flagged, CAST(hits AS BIGINT) AS hits,
           round(hits / flagged, 6) AS precision, round(hits / positives, 6) AS recall FROM c""")
def cumulative_curve(t):
    scored = t.documents.join(t.labels, "doc_id").select(
        F.col("n_chars").cast("double").alias("score"), F.col("quality").alias("label")
    )
    return ev.precision_recall_curve(scored, "score", "label").select(
        "score", "flagged", "hits", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall")
    )


@query("w7_decile_table", """
    WITH d AS (SELECT o_totalprice, o_orderstatus, ntile(10) OVER (ORDER BY o_totalprice, o_orderkey) AS decile FROM orders)
    SELECT decile, count(*) AS n, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END), 6) AS bad_rate,
           min(o_totalprice) AS low, max(o_totalprice) AS high
    FROM d GROUP BY decile""")
def decile_table(t):
    numbered = ordering.row_numbers(
        t.orders.select("o_totalprice", "o_orderkey", "o_orderstatus"),
        "o_totalprice", "o_orderkey", with_total="total",
    )
    bad = F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)
    return (
        numbered.withColumn("decile", ordering.ntile(F.col("rn"), F.col("total"), 10))
        .groupBy("decile")
        .agg(
            F.count("*").alias("n"), F.round(F.avg(bad), 6).alias("bad_rate"),
            F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"),
        )
    )


@query("w8_ranks_with_ties", """
    WITH m AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
    SELECT o_custkey, n, rank() OVER (ORDER BY n DESC) AS rank, dense_rank() OVER (ORDER BY n DESC) AS dense_rank
    FROM m""")
def ranks_with_ties(t):
    counts = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"))
    return ordering.ranks(counts.withColumn("down", -F.col("n")), "down").drop("down")


@query("w9_trailing_rate", """
    SELECT event_id, user_id, n_recent, n_recent > 3 AS limited FROM (
      SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY ts
             RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND CURRENT ROW) AS n_recent FROM events)""")
def trailing_rate(t):
    rows = timejoin.trailing_window(
        t.events, ["user_id"], "ts", 21600, lambda frame: {"n_recent": F.count("*").over(frame(21600))}
    )
    return rows.select("event_id", "user_id", "n_recent", (F.col("n_recent") > 3).alias("limited"))
