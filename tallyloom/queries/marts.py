"""Star schema and serving marts over half-hour snapshots of the events."""

from pyspark.sql import functions as F

from tallyloom.functions.times import floor_minutes
from tallyloom.operators import marts as mt
from tallyloom.plans.scratch import run_dir
from tallyloom.queries.registry import query
from tallyloom.sources import files

_BUCKET = "time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01')"
_STAR = f"""
    taxi AS (SELECT {_BUCKET} AS timestamp_30min, 'Area ' || user_id AS area, count(*) AS taxi_count FROM events GROUP BY ALL),
    rain AS (SELECT {_BUCKET} AS timestamp_30min, 'Area ' || user_id AS area, round(avg(value), 8) AS rainfall_mm
             FROM events WHERE event_type = 'error' GROUP BY ALL),
    weather AS (SELECT {_BUCKET} AS timestamp_30min, 'Area ' || user_id AS area, min(props) AS weather_forecast
                FROM events WHERE event_type = 'view' GROUP BY ALL),
    dim AS (SELECT row_number() OVER (ORDER BY area) AS area_id, area FROM
            (SELECT area FROM taxi UNION SELECT area FROM rain UNION SELECT area FROM weather))"""


def _snapshots(t):
    return t.events.select(
        floor_minutes(F.col("ts"), 30).alias("timestamp_30min"),
        F.concat(F.lit("Area "), F.col("user_id").cast("string")).alias("area"),
        "event_type", "value", "props",
    )


def staged_taxi(t):
    return _snapshots(t).groupBy("timestamp_30min", "area").agg(F.count("*").alias("taxi_count"))


def staged_rain(t):
    errors = _snapshots(t).filter(F.col("event_type") == "error")
    return errors.groupBy("timestamp_30min", "area").agg(F.round(F.avg("value"), 8).alias("rainfall_mm"))


def staged_weather(t):
    views = _snapshots(t).filter(F.col("event_type") == "view")
    return views.groupBy("timestamp_30min", "area").agg(F.min("props").alias("weather_forecast"))


def dimension(t):
    return mt.area_dimension([staged_taxi(t), staged_rain(t), staged_weather(t)])


@query("v1_staging_load", f"""
    WITH {_STAR} SELECT timestamp_30min, area, taxi_count FROM taxi""")
def staging_load(t):
    path = run_dir(t.spark, "clean-taxi")
    files.write_csv(staged_taxi(t).select("*", F.lit("x").alias("extra")), path)
    raw = files.read_csv(t.spark, path, "timestamp_30min string, area string, taxi_count string, extra string")
    return mt.stage(raw, {"timestamp_30min": "timestamp_ntz", "area": "string", "taxi_count": "bigint"})


@query("v2_dimension_and_fact", f"""
    WITH {_STAR} SELECT dim.area_id, timestamp_30min, taxi_count FROM taxi JOIN dim ON dim.area = taxi.area""")
def dimension_and_fact(t):
    return mt.to_fact(staged_taxi(t), dimension(t))


@query("v3_area_snapshot", f"""
    WITH {_STAR} SELECT w.timestamp_30min, w.area, dim.area_id, weather_forecast, taxi_count, rainfall_mm
    FROM weather w JOIN dim ON dim.area = w.area
    LEFT JOIN taxi x ON x.area = w.area AND x.timestamp_30min = w.timestamp_30min
    LEFT JOIN rain r ON r.area = w.area AND r.timestamp_30min = w.timestamp_30min""")
def area_snapshot(t):
    dim = dimension(t)
    return mt.area_snapshot(
        mt.to_fact(staged_weather(t), dim), mt.to_fact(staged_taxi(t), dim), mt.to_fact(staged_rain(t), dim), dim
    )


@query("v4_current_snapshot", f"""
    WITH {_STAR} SELECT timestamp_30min, area, taxi_count FROM taxi
    WHERE timestamp_30min = (SELECT max(timestamp_30min) FROM taxi)""")
def current_snapshot(t):
    dim = dimension(t)
    return mt.current_snapshot(mt.to_fact(staged_taxi(t), dim), dim, "taxi_count")


@query("v5_area_series", f"""
    WITH {_STAR} SELECT x.timestamp_30min, x.area, taxi_count, weather_forecast
    FROM taxi x LEFT JOIN weather w ON w.area = x.area AND w.timestamp_30min = x.timestamp_30min
    WHERE upper(x.area) = 'AREA 78'""")
def area_series(t):
    dim = dimension(t)
    found = mt.area_series(mt.to_fact(staged_taxi(t), dim), mt.to_fact(staged_weather(t), dim), dim, " area 78")
    return found.select("timestamp_30min", "area", "taxi_count", "weather_forecast")


@query("v6_freshness", f"""
    WITH {_STAR} SELECT 'taxi' AS source, max(timestamp_30min) AS latest, count(*) AS rows FROM taxi
    UNION ALL SELECT 'rain', max(timestamp_30min), count(*) FROM rain
    UNION ALL SELECT 'weather', max(timestamp_30min), count(*) FROM weather""")
def freshness(t):
    return mt.freshness({"taxi": staged_taxi(t), "rain": staged_rain(t), "weather": staged_weather(t)}, "timestamp_30min")


@query("v7_snapshot_summary", f"""
    WITH {_STAR} SELECT max(timestamp_30min) AS latest, count(DISTINCT timestamp_30min) AS snapshots,
      count(*) FILTER (WHERE timestamp_30min = (SELECT max(timestamp_30min) FROM taxi)) AS rows_at_latest, count(*) AS rows FROM taxi""")
def snapshot_summary(t):
    return mt.snapshot_summary(staged_taxi(t), "timestamp_30min")


@query("v8_city_series", f"""
    WITH {_STAR} SELECT timestamp_30min, CAST(sum(taxi_count) AS BIGINT) AS total FROM taxi GROUP BY timestamp_30min""")
def city_series(t):
    return mt.city_series(staged_taxi(t), "timestamp_30min", "taxi_count")


@query("v9_dashboard_kpis", f"""
    WITH {_STAR} SELECT CAST(sum(taxi_count) AS BIGINT) AS total_taxis, count(DISTINCT area) AS areas,
      (SELECT count(DISTINCT area) FROM rain WHERE rainfall_mm > 60 AND timestamp_30min = (SELECT max(timestamp_30min) FROM rain)) AS raining_areas
    FROM taxi WHERE timestamp_30min = (SELECT max(timestamp_30min) FROM taxi)""")
def dashboard_kpis(t):
    taxi = staged_taxi(t).withColumnRenamed("area", "area_id")
    rain = staged_rain(t).withColumnRenamed("area", "area_id")
    return mt.dashboard_kpis(taxi, rain, "timestamp_30min")


@query("v10_trip_questions", """
    SELECT l_suppkey, count(*) AS trips, count(*) FILTER (WHERE l_tax > 0) AS with_fee,
           round(sum(l_extendedprice), 2) AS revenue, round(avg(l_quantity), 4) AS avg_distance
    FROM lineitem WHERE l_quantity > 0 GROUP BY l_suppkey""")
def trip_questions(t):
    return (
        t.lineitem.filter(F.col("l_quantity") > 0)
        .groupBy("l_suppkey")
        .agg(
            F.count("*").alias("trips"), F.count_if(F.col("l_tax") > 0).alias("with_fee"),
            F.round(F.sum("l_extendedprice"), 2).alias("revenue"), F.round(F.avg("l_quantity"), 4).alias("avg_distance"),
        )
    )
