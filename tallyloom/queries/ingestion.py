"""Ingestion: payloads, drift, and repeatable loads."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tallyloom.plans.literals import literal_table
from tallyloom.functions import times
from tallyloom.operators import ingest as ig
from tallyloom.operators import joins as jn
from tallyloom.plans.ordering import row_numbers
from tallyloom.plans.scratch import run_dir
from tallyloom.queries.registry import query
from tallyloom.sources import files

_PAGE = 500


def taxi_documents(t):
    """Events folded into point payloads of one page each."""
    point = F.when(F.col("event_id") % 17 == 0, F.array(F.col("user_id") / 10.0)).otherwise(
        F.array(F.col("user_id") / 10.0, F.col("value"))
    )
    pages = jn.fold_pages(
        t.events.select("event_id", "ts", point.alias("point")), [], "event_id", _PAGE, {"points": "point", "times": "ts"}
    )
    feature = F.struct(
        F.struct(
            times.iso_seconds(F.array_min("times")).alias("timestamp"), F.size("points").cast("long").alias("taxi_count")
        ).alias("properties"),
        F.struct(F.lit("MultiPoint").alias("type"), F.col("points").alias("coordinates")).alias("geometry"),
    )
    return pages.select(F.to_json(F.struct(F.array(feature).alias("features"))).alias("raw"))


def weather_documents(t):
    views = t.events.select(
        "event_id", "ts",
        F.struct(F.concat(F.lit("AREA "), "user_id").alias("area"), F.col("event_type").alias("forecast")).alias("f"),
    )
    pages = jn.fold_pages(views, [], "event_id", _PAGE, {"forecasts": "f", "times": "ts"})
    first, last = F.array_min("times"), F.array_max("times")
    item = F.struct(
        times.iso_seconds(first).alias("timestamp"),
        F.when(F.col("page") % 2 == 1, times.iso_seconds(last)).alias("update_timestamp"),
        F.struct(times.iso_seconds(first).alias("start"), times.iso_seconds(last).alias("end")).alias("valid_period"),
        F.col("forecasts"),
    )
    items = F.struct(F.array(item).alias("items"))
    raw = F.when(F.col("page") % 3 == 0, F.to_json(F.struct(items.alias("data")))).otherwise(F.to_json(items))
    return pages.select(raw.alias("raw"))


def rainfall_documents(t):
    sid = F.concat(F.lit("S"), "event_id")
    old = F.floor(F.col("event_id") / _PAGE) % 2 == 1
    station = F.when(
        F.col("event_id") % 11 != 0,
        F.struct(
            F.when(~old, sid).alias("id"), F.when(old, sid).alias("deviceId"),
            F.concat(F.lit("Station "), "user_id").alias("name"),
            F.struct(F.col("value").alias("latitude"), (F.col("user_id") / 10.0).alias("longitude")).alias("location"),
        ),
    )
    rows = t.events.select(
        "event_id", "ts", station.alias("station"), F.struct(sid.alias("stationId"), F.col("value").alias("value")).alias("reading")
    )
    pages = jn.fold_pages(rows, [], "event_id", _PAGE, {"stations": "station", "readings": "reading", "times": "ts"})
    body = F.struct(
        F.filter("stations", lambda s: s.isNotNull()).alias("stations"),
        F.array(
            F.struct(times.iso_seconds(F.array_max("times")).alias("timestamp"), F.col("readings").alias("data"))
        ).alias("readings"),
        F.lit("mm").alias("readingUnit"),
    )
    return pages.select(F.to_json(F.struct(body.alias("data"))).alias("raw"))


@query("i1_flatten_taxi", f"""
    WITH p AS (SELECT *, event_id // {_PAGE} AS page FROM events),
         n AS (SELECT event_id, user_id, value, strftime(min(ts) OVER (PARTITION BY page), '%Y-%m-%dT%H:%M:%S') AS stamp,
                      row_number() OVER (PARTITION BY page ORDER BY event_id) AS i, count(*) OVER (PARTITION BY page) AS c FROM p)
    SELECT 'taxi:' || stamp || ':' || i AS record_id, stamp AS api_timestamp, i AS taxi_index, user_id / 10.0 AS longitude,
           value AS latitude, c AS available_taxi_count, 'taxi api' AS source FROM n WHERE event_id % 17 <> 0""")
def flatten_taxi(t):
    return ig.flatten_taxi(taxi_documents(t), "raw", "taxi api")


@query("i1_flatten_weather", f"""
    WITH p AS (SELECT *, event_id // {_PAGE} AS page FROM events),
         s AS (SELECT page, strftime(min(ts), '%Y-%m-%dT%H:%M:%S') AS a, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS b FROM p GROUP BY page),
         r AS (SELECT p.*, a, b, CASE WHEN p.page % 2 = 1 THEN b ELSE a END AS u FROM p JOIN s ON s.page = p.page)
    SELECT 'weather:' || u || ':AREA ' || user_id AS record_id, a AS api_timestamp, u AS api_update_timestamp,
           'AREA ' || user_id AS area, event_type AS forecast, a AS valid_period_start, b AS valid_period_end,
           'weather api' AS source FROM r""")
def flatten_weather(t):
    return ig.flatten_weather(weather_documents(t), "raw", "weather api")


@query("i1_flatten_rainfall", f"""
    WITH p AS (SELECT *, strftime(max(ts) OVER (PARTITION BY event_id // {_PAGE}), '%Y-%m-%dT%H:%M:%S') AS stamp FROM events)
    SELECT 'rainfall:' || stamp || ':S' || event_id AS record_id, stamp AS reading_timestamp, 'S' || event_id AS station_id,
           CASE WHEN event_id % 11 <> 0 THEN 'Station ' || user_id END AS station_name,
           CASE WHEN event_id % 11 <> 0 THEN user_id / 10.0 END AS longitude,
           CASE WHEN event_id % 11 <> 0 THEN value END AS latitude, value AS rainfall_mm, 'rain api' AS source FROM p""")
def flatten_rainfall(t):
    return ig.flatten_rainfall(rainfall_documents(t), "raw", "rain api")


@query("i2_raw_envelope", f"""
    SELECT 'taxi' AS api_name, CAST(200 AS INTEGER) AS status_code, (max(event_id) // {_PAGE}) + 1 AS documents FROM events""")
def raw_envelope(t):
    path = run_dir(t.spark, "landed")
    docs = taxi_documents(t).withColumn("doc", F.sha2("raw", 256))
    docs.write.partitionBy("doc").text(path)
    envelopes = ig.raw_envelopes(t.spark, path, "taxi")
    return (
        envelopes.filter(F.try_parse_json("raw_json").isNotNull() & F.col("downloaded_at").isNotNull())
        .groupBy("api_name", "status_code")
        .agg(F.count_distinct("requested_url").alias("documents"))
    )


@query("i3_schema_drift", """
    SELECT event_id, ts AS api_timestamp, value AS available_taxi_count FROM events""")
def schema_drift(t):
    v1 = t.events.filter(F.col("event_type") != "view").select(
        "event_id", F.col("ts").alias("api_timestamp"), F.col("value").alias("available_taxi_count"))
    v2 = t.events.filter(F.col("event_type") == "view").select(
        "event_id", F.col("ts").alias("reading_time"), F.col("value").alias("taxi_count"))
    return ig.unify_drift([v1, v2], {"api_timestamp": ["reading_time"], "available_taxi_count": ["taxi_count"]})


@query("i4_page_completeness", """
    SELECT r.k AS l_orderkey FROM range(0, (SELECT max(l_orderkey) + 1 FROM lineitem)) r(k)
    WHERE r.k NOT IN (SELECT l_orderkey FROM lineitem)""")
def page_completeness(t):
    return ig.missing_numbers(t.lineitem, "l_orderkey", 0, F.max("l_orderkey"))


@query("i5_page_slicing", """
    SELECT o_orderkey, (row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1) // 20 + 1 AS page FROM orders""")
def page_slicing(t):
    numbered = row_numbers(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey")
    return numbered.select("o_orderkey", (F.floor((F.col("rn") - 1) / 20) + 1).cast("long").alias("page"))


@query("i6_dedupe_records", """
    SELECT event_id, user_id, value FROM events""")
def dedupe_records(t):
    rows = t.events.select("event_id", "user_id", "value")
    again = rows.filter(F.col("value") > 100).withColumn("value", F.col("value") + 1)
    return ig.dedupe_records(rows.union(again), "event_id", [F.col("value")])


@query("i8_incremental_high_water", """
    SELECT 1 AS load, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-16'
    UNION ALL SELECT 2, count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-16'
    UNION ALL SELECT 3, 0""")
def incremental_high_water(t):
    path = run_dir(t.spark, "incremental")
    early = t.events.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    counts = [ig.load_increment(s, "ts", path) for s in (early, t.events, t.events)]
    return literal_table(t.spark, [(i + 1, n) for i, n in enumerate(counts)], "load int, n bigint")


@query("i9_insert_or_ignore", """
    SELECT 'first' AS load, count(*) AS inserted FROM events WHERE ts < TIMESTAMP '2024-01-16'
    UNION ALL SELECT 'second', count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-16'
    UNION ALL SELECT 'total', count(*) FROM events""")
def insert_or_ignore(t):
    path = run_dir(t.spark, "insert-or-ignore")
    rows = t.events.select("event_id", "ts", "value")
    cut, back = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-16", "2024-01-10"))
    later = rows.filter(F.col("ts") >= back)
    first = ig.insert_or_ignore(rows.filter(F.col("ts") < cut), path, ["event_id"], [F.col("value")])
    second = ig.insert_or_ignore(later.union(later), path, ["event_id"], [F.col("value")])
    total = t.spark.read.parquet(path).select("event_id").distinct().count()
    return literal_table(t.spark, [("first", first), ("second", second), ("total", total)], "load string, inserted bigint")


@query("i10_replace_snapshot", """
    SELECT event_id, CASE WHEN day(ts) >= 20 THEN value * 2 ELSE value END AS value, CAST(day(ts) AS BIGINT) AS day FROM events""")
def replace_snapshot(t):
    path = run_dir(t.spark, "snapshots")
    rows = t.events.select("event_id", "value", F.day("ts").alias("day"))
    ig.replace_snapshots(rows, path, ["day"])
    changed = rows.filter(F.col("day") >= 20).withColumn("value", F.col("value") * 2)
    for _ in range(2):
        ig.replace_snapshots(changed, path, ["day"])
    return t.spark.read.parquet(path).select("event_id", "value", F.col("day").cast("long").alias("day"))


@query("i11_run_log", """
    SELECT 'orders' AS source, 'success' AS status, count(*) AS rows, true AS ordered FROM orders
    UNION ALL SELECT 'events', 'success', count(*), true FROM events
    UNION ALL SELECT 'broken', 'failed', 0, true""")
def run_log(t):
    path = run_dir(t.spark, "run-log")
    ig.logged_run(t.spark, path, "orders", t.orders.count)
    ig.logged_run(t.spark, path, "events", t.events.count)
    ig.logged_run(t.spark, path, "broken", lambda: t.events.select("no_such_column").count())
    return t.spark.read.parquet(path).select(
        "source", "status", "rows", (F.col("ended_at") >= F.col("started_at")).alias("ordered")
    )


@query("i12_snapshot_sufficiency", """
    SELECT user_id, event_type, count(DISTINCT date_trunc('day', ts)) AS snapshots,
           count(DISTINCT date_trunc('day', ts)) >= 3 AS sufficient FROM events GROUP BY ALL""")
def snapshot_sufficiency(t):
    return ig.enough_snapshots(t.events, ["user_id", "event_type"], F.date_trunc("day", "ts"), 3)


@query("i13_expected_counts", """
    WITH a AS (SELECT event_type, event_id FROM events UNION ALL SELECT event_type, event_id FROM events WHERE value > 100)
    SELECT event_type, count(*) AS received, count(DISTINCT event_id) AS unique_records,
           count(*) - count(DISTINCT event_id) AS duplicates FROM a GROUP BY event_type""")
def expected_counts(t):
    rows = t.events.select("event_type", "event_id", "value")
    return ig.expected_counts(rows.union(rows.filter(F.col("value") > 100)), "event_type", "event_id")


@query("i14_polymorphic_payload", """
    SELECT event_id AS id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def polymorphic_payload(t):
    row = F.format_string('[{"id": %d, "k": %s}]', "event_id", F.get_json_object("props", "$.k"))
    raw = F.when(F.col("event_id") % 2 == 0, row).otherwise(F.concat(F.lit('{"data": '), row, F.lit("}")))
    return ig.rows_of_payload(t.events.select(raw.alias("raw")), "raw", "struct<id: bigint, k: bigint>")


@query("i15_backfill", """
    SELECT day(ts) AS day, user_id, count(*) AS n FROM events GROUP BY ALL""")
def backfill(t):
    """The table's days in two intervals, the later one first and twice."""
    path = run_dir(t.spark, "backfill")
    date = F.to_date("ts")

    def job(rows):
        return rows.groupBy(date.alias("date"), "user_id").agg(F.count("*").alias("n"))

    first, last = t.events.agg(F.min(date), F.max(date)).first()
    if first is None:
        return t.events.select(F.day("ts").cast("long").alias("day"), "user_id", F.lit(1).cast("long").alias("n"))
    moments = [datetime.combine(d, datetime.min.time()) for d in (first, first + (last - first) / 2, last + timedelta(days=1))]
    for start, end in ((moments[1], moments[2]), (moments[0], moments[1]), (moments[1], moments[2])):
        ig.backfill(
            lambda: t.events, job, "ts", F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"), path, ["date"]
        )
    days = t.spark.read.parquet(path)
    return days.groupBy(F.day("date").cast("long").alias("day"), "user_id").agg(F.sum("n").alias("n"))


@query("k4_document_to_rows", f"""
    SELECT user_id / 10.0 AS longitude, count(*) AS n FROM events WHERE event_id % 17 <> 0 GROUP BY user_id""")
def document_to_rows(t):
    path = run_dir(t.spark, "taxi-docs")
    taxi_documents(t).write.text(path)
    landed = t.spark.read.text(path).withColumnRenamed("value", "raw")
    return ig.flatten_taxi(landed, "raw", "taxi api").groupBy("longitude").agg(F.count("*").alias("n"))
