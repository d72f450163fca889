"""Joins: equi, outer, anti, semi, interval, point-in-time, nearest, dense grid."""

from pyspark.sql import functions as F

from tallyloom.operators import joins as jn
from tallyloom.plans import timejoin
from tallyloom.queries.registry import query


@query("j1_fact_to_dimension", """
    SELECT s_suppkey, s_name, n_name, r_name FROM supplier
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def fact_to_dimension(t):
    return (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", "s_name", "n_name", "r_name")
    )


@query("j2_left_two_keys", """
    WITH l AS (SELECT l_partkey, l_suppkey, count(*) AS n, round(sum(l_quantity), 2) AS qty
               FROM lineitem GROUP BY ALL),
         r AS (SELECT l_partkey, l_suppkey, round(avg(l_discount), 6) AS avg_discount
               FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL)
    SELECT l.l_partkey, l.l_suppkey, n, qty, avg_discount
    FROM l LEFT JOIN r ON l.l_partkey = r.l_partkey AND l.l_suppkey = r.l_suppkey""")
def left_two_keys(t):
    keys = ["l_partkey", "l_suppkey"]
    left = t.lineitem.groupBy(*keys).agg(
        F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty")
    )
    right = (
        t.lineitem.filter(F.col("l_returnflag") == "R")
        .groupBy(*keys)
        .agg(F.round(F.avg("l_discount"), 6).alias("avg_discount"))
    )
    return left.join(right, keys, "left")


@query("j3_right_outer", """
    SELECT c_name, CAST(o_orderkey AS DOUBLE) AS o_orderkey, o_totalprice
    FROM orders RIGHT JOIN customer ON o_custkey = c_custkey AND o_totalprice > 300000""")
def right_outer(t):
    big = t.orders.filter(F.col("o_totalprice") > 300000)
    return big.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "right").select(
        "c_name", F.col("o_orderkey").cast("double").alias("o_orderkey"), "o_totalprice"
    )


@query("j3_full_outer", """
    WITH c AS (SELECT * FROM customer WHERE c_acctbal > 5000),
         o AS (SELECT * FROM orders WHERE o_totalprice > 200000)
    SELECT c_name, CAST(o_orderkey AS DOUBLE) AS o_orderkey, o_totalprice
    FROM c FULL JOIN o ON o_custkey = c_custkey""")
def full_outer(t):
    c = t.customer.filter(F.col("c_acctbal") > 5000)
    o = t.orders.filter(F.col("o_totalprice") > 200000)
    return c.join(o, F.col("o_custkey") == F.col("c_custkey"), "full").select(
        "c_name", F.col("o_orderkey").cast("double").alias("o_orderkey"), "o_totalprice"
    )


@query("j4_anti_join_audit", """
    SELECT c_custkey, c_name FROM customer LEFT JOIN
      (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F') ON o_custkey = c_custkey
    WHERE o_custkey IS NULL""")
def anti_join(t):
    done = t.orders.filter(F.col("o_orderstatus") == "F")
    return t.customer.join(
        done, F.col("o_custkey") == F.col("c_custkey"), "left_anti"
    ).select("c_custkey", "c_name")


@query("j5_interval_asof", """
    WITH v AS (SELECT event_id AS view_id, user_id, value AS view_value, ts AS s,
                      ts + INTERVAL 1 HOUR * (1 + event_id % 5) AS e, ts AS u
               FROM events WHERE event_type = 'view'),
         m AS (SELECT t.event_id, t.user_id, v.view_value, CAST(v.view_id AS DOUBLE) AS view_id,
                      row_number() OVER (PARTITION BY t.event_id
                                         ORDER BY v.u DESC NULLS LAST, v.view_id) AS rk
               FROM events t LEFT JOIN v ON t.user_id = v.user_id
                AND t.ts >= v.s AND t.ts < v.e AND v.u <= t.ts)
    SELECT event_id, user_id, view_value, view_id FROM m WHERE rk = 1""")
def interval_asof(t):
    views = t.events.filter(F.col("event_type") == "view").select(
        "user_id",
        F.col("value").alias("view_value"),
        F.col("event_id").alias("view_id"),
        F.col("ts").alias("valid_from"),
        F.expr("ts + make_interval(0, 0, 0, 0, cast(1 + event_id % 5 as int))").alias("valid_to"),
    )
    found = timejoin.interval_latest_join(
        t.events.select("event_id", "user_id", "ts"), views, ["user_id"], ["event_id"],
        "ts", "valid_from", "valid_to", "valid_from", "view_id", ["view_value", "view_id"],
    )
    return found.select(
        "event_id", "user_id", "view_value", F.col("view_id").cast("double").alias("view_id")
    )


@query("j6_point_in_time", """
    WITH f AS (SELECT event_id AS fid, user_id, value AS purchase_value, ts AS et,
                      ts + INTERVAL 1 MINUTE * (event_id % 90) AS ct
               FROM events WHERE event_type = 'purchase'),
         m AS (SELECT e.event_id, e.user_id, f.purchase_value,
                      row_number() OVER (PARTITION BY e.event_id
                        ORDER BY f.et DESC NULLS LAST, f.ct DESC, f.fid DESC) AS rk
               FROM events e LEFT JOIN f ON e.user_id = f.user_id AND f.et <= e.ts AND f.ct <= e.ts)
    SELECT event_id, user_id, purchase_value FROM m WHERE rk = 1""")
def point_in_time(t):
    features = t.events.filter(F.col("event_type") == "purchase").select(
        "user_id", "ts", F.col("event_id").alias("feature_id"), F.col("value").alias("purchase_value"),
        F.expr("ts + make_interval(0, 0, 0, 0, 0, cast(event_id % 90 as int))").alias("created"),
    )
    return timejoin.point_in_time_join(
        t.events.select("event_id", "user_id", F.col("ts").alias("at")), features, ["user_id"],
        "at", "ts", ["purchase_value"], created="created", tie="feature_id",
    ).drop("at")


@query("j7_future_target", """
    WITH m AS (SELECT a.event_id, a.user_id, a.value, b.value AS target_value,
                      row_number() OVER (PARTITION BY a.event_id ORDER BY
                        abs(epoch_us(b.ts) - epoch_us(a.ts + INTERVAL 2 HOUR)) NULLS LAST,
                        b.ts, b.event_id) AS rk
               FROM events a LEFT JOIN events b ON a.user_id = b.user_id
                AND b.ts BETWEEN a.ts + INTERVAL 90 MINUTE AND a.ts + INTERVAL 150 MINUTE)
    SELECT event_id, user_id, value, target_value FROM m WHERE rk = 1""")
def future_target(t):
    targets = t.events.select(
        "user_id", F.col("ts").alias("target_ts"), F.col("event_id").alias("target_id"),
        F.col("value").alias("target_value"),
    )
    return timejoin.nearest_join(
        t.events.select("event_id", "user_id", "ts", "value"), targets, ["user_id"], "ts",
        "target_ts", "target_id", ["target_value"], offset_seconds=7200, tolerance_seconds=1800,
    ).drop("ts")


@query("j9_merge_with_default", """
    SELECT n_name, COALESCE(n, 0) AS suppliers, round(COALESCE(bal, 0), 2) AS balance
    FROM nation LEFT JOIN (SELECT s_nationkey, count(*) AS n, sum(s_acctbal) AS bal
                           FROM supplier WHERE s_acctbal > 3000 GROUP BY s_nationkey)
      ON s_nationkey = n_nationkey""")
def merge_with_default(t):
    counts = (
        t.supplier.filter(F.col("s_acctbal") > 3000)
        .groupBy(F.col("s_nationkey").alias("n_nationkey"))
        .agg(F.count("*").alias("suppliers"), F.round(F.sum("s_acctbal"), 2).alias("balance"))
    )
    return jn.merge_with_default(
        t.nation, counts, ["n_nationkey"], {"suppliers": 0, "balance": 0.0}
    ).select("n_name", "suppliers", "balance")


@query("j10_lookup_map", """
    SELECT conv_id, turn, role, CAST(length(text) AS BIGINT) AS n_chars FROM conversations""")
def lookup_map(t):
    """Readings refer to stations of the same document by id."""
    docs = jn.fold_pages(
        t.conversations.select(
            "conv_id", "turn",
            F.struct(
                F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("role").alias("name")
            ).alias("station"),
            F.struct(
                F.concat_ws("-", "conv_id", "turn").alias("station_id"),
                F.col("turn").alias("turn"), F.length("text").cast("long").alias("n_chars"),
            ).alias("reading"),
        ),
        ["conv_id"], "turn", 100, {"stations": "station", "readings": "reading"},
    )
    rows = jn.lookup_in_document(docs, "readings", "station_id", "stations", "id", {"name": "role"})
    return rows.select("conv_id", "reading.turn", "role", "reading.n_chars")


@query("j11_dense_grid", """
    WITH d AS (SELECT DISTINCT date_trunc('day', ts) AS day FROM events),
         a AS (SELECT DISTINCT event_type FROM events),
         n AS (SELECT date_trunc('day', ts) AS day, event_type, count(*) AS n
               FROM events WHERE value > 150 GROUP BY ALL)
    SELECT CAST(d.day AS TIMESTAMP) AS day, a.event_type, COALESCE(n, 0) AS n
    FROM d CROSS JOIN a LEFT JOIN n ON n.day = d.day AND n.event_type = a.event_type""")
def dense_grid(t):
    rows = t.events.withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    counts = rows.filter(F.col("value") > 150).groupBy("day", "event_type").agg(F.count("*").alias("n"))
    return jn.dense_grid(rows, "day", "event_type", counts, {"n": 0})


@query("j12_concat_columns", """
    SELECT d.doc_id, lang, n_chars, CAST(quality AS DOUBLE) AS quality, CAST(toxic AS DOUBLE) AS toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def concat_columns(t):
    labels = t.labels.select(
        "doc_id", F.col("quality").cast("double").alias("quality"), F.col("toxic").cast("double").alias("toxic")
    )
    return t.documents.select("doc_id", "lang", "n_chars").join(labels, "doc_id", "left")


@query("j13_semi_join", """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 48)""")
def semi_join(t):
    large = t.lineitem.filter(F.col("l_quantity") > 48)
    return t.orders.join(
        large, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi"
    ).select("o_orderkey", "o_totalprice")
