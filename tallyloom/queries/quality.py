"""Data quality, cleaning and imputation."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators import cleaning as cl
from tallyloom.operators import reshape as rs
from tallyloom.plans import timejoin
from tallyloom.plans.scratch import run_dir
from tallyloom.queries.registry import query

_HOLES = """SELECT o_orderkey, o_orderpriority,
    CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 7 = 1 THEN '  ' ELSE o_orderstatus END AS status,
    CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price FROM orders"""


def with_holes(t):
    """Orders with nulls and blanks put in by key arithmetic."""
    k = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey", "o_orderpriority",
        F.when(k % 7 == 0, None).when(k % 7 == 1, "  ").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(k % 5 != 0, F.col("o_totalprice")).alias("price"),
    )


def _profile_sql(name, text):
    blank = f"count(*) FILTER (WHERE trim({name}) = '')" if text else "CAST(0 AS BIGINT)"
    return f"""SELECT '{name}' AS "column", count(*) AS rows,
        count(DISTINCT {name}) + CASE WHEN count(*) > count({name}) THEN 1 ELSE 0 END AS distinct_values,
        count(*) - count({name}) AS null_count, {blank} AS blank_count,
        count(*) - count({name}) + {blank} AS missing_count,
        round(100.0 * (count(*) - count({name})) / count(*), 4) AS null_percent FROM h"""


@query("q1_column_profile", f"WITH h AS ({_HOLES}) " + " UNION ALL ".join(
    _profile_sql(n, s) for n, s in (("o_orderkey", 0), ("o_orderpriority", 1), ("status", 1), ("price", 0))))
def column_profile(t):
    return cl.profile_columns(with_holes(t)).withColumn("null_percent", F.round("null_percent", 4))


_LINE_COLUMNS = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")


@query("q2_quality_report", f"""
    WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL),
         r AS (SELECT *, CASE WHEN l_partkey % 9 <> 0 THEN l_quantity END AS quantity FROM lineitem)
    SELECT 'rows' AS "check", count(*) AS value FROM r
    UNION ALL SELECT 'duplicate_rows', CAST(sum(n - 1) AS BIGINT) FROM k
    UNION ALL SELECT 'null_l_orderkey', count(*) - count(l_orderkey) FROM r
    UNION ALL SELECT 'null_l_linenumber', count(*) - count(l_linenumber) FROM r
    UNION ALL SELECT 'null_quantity', count(*) - count(quantity) FROM r
    {" ".join(f"UNION ALL SELECT 'null_{c}', count(*) - count({c}) FROM r" for c in _LINE_COLUMNS)}""")
def quality_report(t):
    rows = t.lineitem.withColumn("quantity", F.when(F.col("l_partkey") % 9 != 0, F.col("l_quantity")))
    return cl.quality_report(rows, ["l_orderkey", "l_linenumber"])


@query("q3_null_normalisation", f"""
    SELECT o_orderkey, nullif(CASE WHEN trim(status) = '' THEN NULL ELSE status END, 'P') AS status,
           price FROM ({_HOLES})""")
def null_normalisation(t):
    raw = with_holes(t).select("o_orderkey", "status", F.coalesce("price", F.lit(float("nan"))).alias("price"))
    return cl.normalise_nulls(raw, {"status": ["P"]})


@query("q4_listwise_deletion", f"SELECT o_orderkey, status, price FROM ({_HOLES}) WHERE status IS NOT NULL AND price IS NOT NULL")
def listwise_deletion(t):
    return with_holes(t).na.drop(subset=["status", "price"]).select("o_orderkey", "status", "price")


@query("q5_group_median_impute", f"""
    WITH h AS ({_HOLES}), m AS (SELECT o_orderpriority, median(price) AS g FROM h GROUP BY o_orderpriority)
    SELECT o_orderkey, round(COALESCE(price, g, (SELECT median(price) FROM h)), 4) AS price,
           CASE WHEN price IS NULL THEN 1 ELSE 0 END AS price_missing
    FROM h LEFT JOIN m ON m.o_orderpriority = h.o_orderpriority""")
def group_median_impute(t):
    filled = cl.impute_group_median(with_holes(t), ["o_orderpriority"], "price", "price_missing")
    return filled.select("o_orderkey", F.round("price", 4).alias("price"), "price_missing")


@query("q6_constant_and_mean_impute", f"""
    WITH h AS ({_HOLES})
    SELECT o_orderkey, COALESCE(status, 'unknown') AS status, round(COALESCE(price, (SELECT avg(price) FROM h)), 3) AS price FROM h""")
def constant_and_mean_impute(t):
    filled = cl.impute_constants(with_holes(t), {"status": "unknown"}, ["price"])
    return filled.select("o_orderkey", "status", F.round("price", 3).alias("price"))


@query("q7_duplicate_impact", """
    WITH d AS (SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text),
         b AS (SELECT lang, count(*) AS n, count(*) / (SELECT count(*) FROM documents) AS share FROM documents GROUP BY lang),
         a AS (SELECT lang, count(*) AS n, count(*) / (SELECT count(*) FROM d) AS share
               FROM documents WHERE doc_id IN (SELECT doc_id FROM d) GROUP BY lang)
    SELECT b.lang, b.n AS n_before, a.n AS n_after, round(b.share, 6) AS before, round(a.share, 6) AS after,
           round(abs(b.share - a.share), 6) AS difference FROM b JOIN a ON a.lang = b.lang""")
def duplicate_impact(t):
    unique = rs.dedupe_text(t.documents, "text", "doc_id")
    found = cl.duplicate_impact(t.documents, unique, "lang")
    return found.select(
        "lang", "n_before", "n_after", *[F.round(c, 6).alias(c) for c in ("before", "after", "difference")]
    )


@query("q8_row_count_audit", """
    SELECT 'orders' AS name, (SELECT count(*) FROM orders) AS staged, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS loaded
    UNION ALL SELECT 'customer', (SELECT count(*) FROM customer), (SELECT count(DISTINCT o_custkey) FROM orders)""")
def row_count_audit(t):
    def audit(name, staged, loaded, key):
        n = staged.select(F.count("*").alias("n")).scalar()
        return loaded.agg(F.count_distinct(key).alias("loaded")).select(F.lit(name).alias("name"), n.alias("staged"), "loaded")

    return audit("orders", t.orders, t.lineitem, "l_orderkey").unionByName(
        audit("customer", t.customer, t.orders, "o_custkey")
    )


@query("q8_key_audit", """
    SELECT 'primary' AS kind, (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(*) > 1)) AS violations
    UNION ALL SELECT 'unique', (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1))
    UNION ALL SELECT 'foreign', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))""")
def key_audit(t):
    def repeated(df, *keys):
        return df.groupBy(*keys).count().filter(F.col("count") > 1)

    orphans = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")
    found = {"primary": repeated(t.orders, "o_orderkey"), "unique": repeated(t.lineitem, "l_orderkey", "l_linenumber"), "foreign": orphans}
    rows = [d.agg(F.count("*").alias("violations")).select(F.lit(k).alias("kind"), "violations") for k, d in found.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("q9_import_log", """
    SELECT event_type AS source, count(*) AS rows FROM events GROUP BY event_type""")
def import_log(t):
    path = run_dir(t.spark, "staged")
    t.events.hint("rebalance", "event_type").write.partitionBy("event_type").parquet(path)
    from tallyloom.operators.ingest import import_log as log

    found = log(t.spark.read.parquet(path))
    source = F.regexp_extract("file", r"event_type=([a-z]+)/", 1)
    return found.groupBy(source.alias("source")).agg(F.sum("rows").alias("rows"))


@query("q10_invalid_range", """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'negative balance'
        WHEN CASE WHEN c_custkey % 6 <> 0 THEN c_nationkey END IS NULL THEN 'no nation' END AS reject_reason FROM customer""")
def invalid_range(t):
    rows = t.customer.select(
        "c_custkey", "c_acctbal", F.when(F.col("c_custkey") % 6 != 0, F.col("c_nationkey")).alias("nation")
    )
    rules = {"negative balance": F.col("c_acctbal") >= 0, "no nation": F.col("nation").isNotNull()}
    return cl.split_rejects(rows, rules).select("c_custkey", "reject_reason")


@query("q11_outlier_count", """
    WITH s AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS sd FROM events GROUP BY event_type)
    SELECT e.event_type, count(*) AS rows, count(*) FILTER (WHERE abs(value - m) > 1.5 * sd) AS outliers
    FROM events e JOIN s ON s.event_type = e.event_type GROUP BY e.event_type""")
def outlier_count(t):
    return cl.outlier_counts(t.events, ["event_type"], "value", 1.5)


_ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query("q12_column_roles", f"""
    WITH c AS ({" UNION ALL ".join(f"SELECT '{c}' AS column, count(*) AS n, count(DISTINCT {c}) AS d FROM orders" for c in _ORDER_COLUMNS)})
    SELECT "column", round(d / n, 6) AS unique_ratio, CASE WHEN d <= 1 THEN 'constant' WHEN d = n THEN 'identifier'
        WHEN d > 50 THEN 'high_cardinality' ELSE 'ordinary' END AS role FROM c""")
def column_roles(t):
    profile = cl.profile_columns(t.orders)
    return cl.column_roles(profile).withColumn("unique_ratio", F.round("unique_ratio", 6))


@query("q13_key_alignment", """
    SELECT count(*) FILTER (WHERE d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL) AS matched,
           count(*) FILTER (WHERE l.doc_id IS NULL) AS left_only, count(*) FILTER (WHERE d.doc_id IS NULL) AS right_only
    FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id""")
def key_alignment(t):
    return cl.key_alignment(t.documents, t.labels, "doc_id")


@query("q14_schema_check", """
    SELECT field, status, (SELECT count(*) FROM orders) AS rows FROM (VALUES ('o_orderkey', 'ok'), ('o_totalprice', 'retyped'),
      ('customer_id', 'renamed'), ('o_clerk', 'missing'), ('o_orderstatus', 'ok'), ('o_orderdate', 'unexpected'), ('o_orderpriority', 'unexpected')) v(field, status)""")
def schema_check(t):
    declared = T.StructType([
        T.StructField("o_orderkey", T.LongType()), T.StructField("o_totalprice", T.DecimalType(12, 2)),
        T.StructField("customer_id", T.LongType()), T.StructField("o_clerk", T.StringType()),
        T.StructField("o_orderstatus", T.StringType()),
    ])
    rows = t.orders.select(F.count("*").alias("rows")).scalar()
    found = cl.schema_differences(t.orders, declared, {"o_custkey": "customer_id"})
    return found.select("field", "status", rows.alias("rows"))


@query("q15_join_match_rate", """
    SELECT count(*) AS rows, count(l.k) AS matched, round(count(l.k) / count(*), 6) AS match_rate
    FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_quantity > 40) l ON l.k = o.o_orderkey""")
def join_match_rate(t):
    large = t.lineitem.filter(F.col("l_quantity") > 40).select(F.col("l_orderkey").alias("o_orderkey"))
    return cl.match_rate(t.orders, large, "o_orderkey").withColumn("match_rate", F.round("match_rate", 6))


@query("q15_volume_drop", """
    WITH c AS (SELECT date_trunc('hour', ts) AS bucket, count(*) AS n FROM events GROUP BY 1),
         s AS (SELECT bucket, n, avg(n) OVER w AS m, stddev_samp(n) OVER w AS sd FROM c
               WINDOW w AS (ORDER BY bucket ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
    SELECT CAST(bucket AS TIMESTAMP) AS bucket, n, round((n - m) / nullif(sd, 0), 4) AS z,
           COALESCE((n - m) / nullif(sd, 0) < -2, false) AS dropped FROM s""")
def volume_drop(t):
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    return cl.volume_drop(t.events, hour, 24, 2.0).withColumn("z", F.round("z", 4))


@query("q16_interpolate", """
    WITH h AS (SELECT event_id, user_id, epoch_us(ts) AS t, CASE WHEN event_type <> 'error' THEN value END AS v FROM events),
         n AS (SELECT event_id, v, t,
            last_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER b AS t0, last_value(v IGNORE NULLS) OVER b AS v0,
            first_value(CASE WHEN v IS NOT NULL THEN t END IGNORE NULLS) OVER a AS t1, first_value(v IGNORE NULLS) OVER a AS v1
          FROM h WINDOW b AS (PARTITION BY user_id ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                        a AS (PARTITION BY user_id ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT event_id, round(CASE WHEN v IS NOT NULL THEN v
        WHEN v0 IS NOT NULL AND v1 IS NOT NULL THEN v0 + (v1 - v0) * ((t - t0) / (t1 - t0)) END, 4) AS filled FROM n""")
def interpolate(t):
    rows = t.events.select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") != "error", F.col("value")).alias("v")
    )
    filled = timejoin.interpolate(rows, ["user_id"], "ts", "v", "filled")
    return filled.select("event_id", F.round("filled", 4).alias("filled"))
