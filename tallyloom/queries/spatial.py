"""Spatial queries: points from the tables, areas from GeoJSON text."""

import json

from pyspark.sql import functions as F

from tallyloom.plans.literals import literal_table
from tallyloom.functions import text
from tallyloom.operators import joins as jn
from tallyloom.operators import spatial as sp
from tallyloom.queries.registry import query


def _box(x0, y0, x1, y1):
    return [[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]


_FEATURES = [
    ("Alpha ", "Polygon", [_box(-0.4, -0.4, 0.0, 0.0), _box(-0.2, -0.2, -0.1, -0.1)]),
    ("bravo", "Polygon", [_box(0.0, 0.0, 0.4, 0.4)]),
    ("Charlie", "MultiPolygon", [
        [_box(-0.4, 0.05, -0.1, 0.4)],
        [[[0.1, -0.4], [0.4, -0.4], [0.25, -0.1], [0.1, -0.4]]],
    ]),
    ("delta", "Polygon", [_box(-0.05, -0.05, 0.1, 0.1)]),
    ("Echo", "Polygon", [_box(-0.95, -0.95, -0.9, -0.9)]),
    ("pole", "Point", [0.0, 0.0]),
]

_IN = {
    "ALPHA": "(lon >= -0.4 AND lon < 0.0 AND lat >= -0.4 AND lat < 0.0 AND NOT (lon >= -0.2 AND lon < -0.1 AND lat >= -0.2 AND lat < -0.1))",
    "BRAVO": "(lon >= 0.0 AND lon < 0.4 AND lat >= 0.0 AND lat < 0.4)",
    "CHARLIE": """((lon >= -0.4 AND lon < -0.1 AND lat >= 0.05 AND lat < 0.4) OR
        (lat >= -0.4 AND lat < -0.1 AND lon >= (0.25 - 0.1) * (lat - -0.4) / (-0.1 - -0.4) + 0.1
         AND lon < (0.25 - 0.4) * (lat - -0.4) / (-0.1 - -0.4) + 0.4))""",
    "DELTA": "(lon >= -0.05 AND lon < 0.1 AND lat >= -0.05 AND lat < 0.1)",
}
_FIRST = "CASE " + " ".join(f"WHEN {c} THEN '{a}'" for a, c in _IN.items()) + " END"
_VECTOR_POINTS = "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS lon, CAST(embedding[2] AS DOUBLE) AS lat FROM embeddings"
_EVENT_POINTS = """SELECT event_id, ts, user_id, value, CAST(user_id AS DOUBLE) / 150.0 - 0.5 AS lon,
    value / 400.0 - 0.4 AS lat FROM events"""


def polygons(t):
    docs = [
        (json.dumps({"type": "Feature", "properties": {"NAME": n}, "geometry": {"type": k, "coordinates": c}}),)
        for n, k, c in _FEATURES
    ]
    return sp.polygon_table(literal_table(t.spark, docs, "doc string"), "doc", "NAME")


def vector_points(t):
    return t.embeddings.select(
        "vec_id", F.col("embedding")[0].cast("double").alias("lon"), F.col("embedding")[1].cast("double").alias("lat")
    )


def event_points(t):
    return t.events.select(
        "event_id", "ts", "user_id", "value",
        (F.col("user_id").cast("double") / 150.0 - 0.5).alias("lon"), (F.col("value") / 400.0 - 0.4).alias("lat"),
    )


def located_events(t):
    return sp.area_join(event_points(t), polygons(t), "lon", "lat", 0.25, "left", "event_id")


@query("g1_polygon_table", f"""
    WITH p AS ({_VECTOR_POINTS})
    SELECT area, polygons, rings, n FROM (VALUES ('ALPHA', 1, 2), ('BRAVO', 1, 1), ('CHARLIE', 2, 2), ('DELTA', 1, 1), ('ECHO', 1, 1)) AS a(area, polygons, rings)
    JOIN (SELECT 'ALPHA' AS area, count(*) FILTER (WHERE lon BETWEEN -0.4 AND 0.0 AND lat BETWEEN -0.4 AND 0.0) AS n FROM p
     UNION ALL SELECT 'BRAVO', count(*) FILTER (WHERE lon BETWEEN 0.0 AND 0.4 AND lat BETWEEN 0.0 AND 0.4) FROM p
     UNION ALL SELECT 'CHARLIE', count(*) FILTER (WHERE lon BETWEEN -0.4 AND 0.4 AND lat BETWEEN -0.4 AND 0.4) FROM p
     UNION ALL SELECT 'DELTA', count(*) FILTER (WHERE lon BETWEEN -0.05 AND 0.1 AND lat BETWEEN -0.05 AND 0.1) FROM p
     UNION ALL SELECT 'ECHO', count(*) FILTER (WHERE lon BETWEEN -0.95 AND -0.9 AND lat BETWEEN -0.95 AND -0.9) FROM p) USING (area)""")
def polygon_table(t):
    """Shapes per area, and the points that fall into the common box."""
    boxes = sp.area_summary(polygons(t))
    points = vector_points(t)
    rows = [
        points.agg(
            F.count_if(F.col("lon").between(b.min_lon, b.max_lon) & F.col("lat").between(b.min_lat, b.max_lat)).alias("n")
        ).select(F.lit(b.area).alias("area"), F.lit(b.polygons).cast("int").alias("polygons"), F.lit(b.rings).cast("int").alias("rings"), "n")
        for b in boxes.collect()  # one row per literal area
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


@query("g2_point_in_polygon", f"""
    WITH p AS ({_VECTOR_POINTS}) SELECT vec_id, {_IN['ALPHA']} AS inside FROM p""")
def point_in_polygon(t):
    rings = F.from_json(F.lit(json.dumps(_FEATURES[0][2])), "array<array<array<double>>>")
    return vector_points(t).select("vec_id", sp.in_polygon(F.col("lon"), F.col("lat"), rings).alias("inside"))


@query("g3_area_join_first", f"""
    WITH p AS ({_VECTOR_POINTS}) SELECT vec_id, {_FIRST} AS area FROM p""")
def area_join_first(t):
    return sp.area_join(vector_points(t), polygons(t), "lon", "lat", 0.25, "left", "vec_id").select("vec_id", "area")


@query("g3_area_join_all", f"""
    WITH p AS ({_VECTOR_POINTS})""" + " UNION ALL ".join(
    f" SELECT vec_id, '{a}' AS area FROM p WHERE {c}" for a, c in _IN.items()))
def area_join_all(t):
    return sp.area_join(vector_points(t), polygons(t), "lon", "lat", 0.25, "inner").select("vec_id", "area")


@query("j8_spatial_join", f"""
    WITH p AS ({_EVENT_POINTS}) SELECT event_id, {_FIRST} AS area FROM p""")
def spatial_join(t):
    return located_events(t).select("event_id", "area")


@query("g4_count_by_area_and_time", f"""
    WITH p AS (SELECT *, {_FIRST} AS area FROM ({_EVENT_POINTS}))
    SELECT time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01') AS bucket, area, count(*) AS n
    FROM p WHERE area IS NOT NULL GROUP BY ALL""")
def count_by_area_and_time(t):
    bucketed = located_events(t).withColumn("bucket", F.window("ts", "30 minutes")["start"])
    return sp.count_by_area(bucketed, ["bucket"])


@query("g5_mean_by_area", f"""
    WITH p AS (SELECT *, value - 50 AS reading, {_FIRST} AS area FROM ({_EVENT_POINTS}))
    SELECT area, round(avg(reading), 2) AS mean_reading, count(DISTINCT user_id) AS station_count,
           count(DISTINCT CASE WHEN reading > 0 THEN user_id END) AS raining_station_count
    FROM p WHERE area IS NOT NULL GROUP BY area""")
def mean_by_area(t):
    rows = located_events(t).withColumn("reading", F.col("value") - 50)
    return sp.mean_by_area(rows, [], "reading", "user_id").withColumn("mean_reading", F.round("mean_reading", 2))


@query("g6_zero_filled_areas", f"""
    WITH p AS (SELECT *, {_FIRST} AS area FROM ({_EVENT_POINTS}))
    SELECT a.area, COALESCE(n, 0) AS n FROM (VALUES ('ALPHA'), ('BRAVO'), ('CHARLIE'), ('DELTA'), ('ECHO')) a(area)
    LEFT JOIN (SELECT area, count(*) AS n FROM p GROUP BY area) c ON c.area = a.area""")
def zero_filled_areas(t):
    areas = polygons(t).select("area").distinct()
    return jn.merge_with_default(areas, sp.count_by_area(located_events(t), []), ["area"], {"n": 0})


@query("g7_area_attributes", f"""
    WITH p AS (SELECT *, {_FIRST} AS area FROM ({_EVENT_POINTS})),
         c AS (SELECT area, count(*) AS n, round(avg(value), 2) AS mean_value FROM p WHERE area IS NOT NULL GROUP BY area)
    SELECT a.area, COALESCE(n, 0) AS n, mean_value, COALESCE(mean_value > 60, false) AS is_raining,
      CASE WHEN COALESCE(mean_value, 0) / 50 * 12 < 0.5 THEN 'none' WHEN mean_value / 50 * 12 < 2 THEN 'light'
      WHEN mean_value / 50 * 12 < 10 THEN 'moderate' WHEN mean_value / 50 * 12 < 30 THEN 'heavy' ELSE 'violent' END AS class
    FROM (VALUES ('ALPHA'), ('BRAVO'), ('CHARLIE'), ('DELTA'), ('ECHO')) a(area) LEFT JOIN c ON c.area = a.area""")
def area_attributes(t):
    located = located_events(t).filter(F.col("area").isNotNull())
    marts = located.groupBy("area").agg(F.count("*").alias("n"), F.round(F.avg("value"), 2).alias("mean_value"))
    rows = jn.merge_with_default(polygons(t).select("area").distinct(), marts, ["area"], {"n": 0})
    return rows.select(
        "area", "n", "mean_value",
        F.coalesce(F.col("mean_value") > 60, F.lit(False)).alias("is_raining"),
        text.intensity_class(F.col("mean_value") / 50).alias("class"),
    )


@query("g8_dissolve", f"""
    WITH p AS (SELECT *, {_IN['ALPHA']} OR {_IN['CHARLIE']} AS west, {_IN['BRAVO']} OR {_IN['DELTA']} AS east FROM ({_EVENT_POINTS}))
    SELECT CASE WHEN east THEN 'EAST' ELSE 'WEST' END AS area, count(*) AS n FROM p WHERE east OR west GROUP BY 1""")
def dissolve(t):
    parents = literal_table(t.spark, 
        [("ALPHA", "WEST"), ("CHARLIE", "WEST"), ("BRAVO", "EAST"), ("DELTA", "EAST"), ("ECHO", "FAR")], "area string, parent string"
    )
    larger = sp.dissolve(polygons(t), parents)
    located = sp.area_join(event_points(t), larger, "lon", "lat", 0.25, "inner", "event_id")
    return sp.count_by_area(located, [])
