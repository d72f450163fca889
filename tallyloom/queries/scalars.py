"""Scalar, date, math, JSON and array functions."""

from pyspark.sql import functions as F

from tallyloom.functions import documents, text, times, vectors
from tallyloom.operators import cleaning as cl
from tallyloom.operators import joins as jn
from tallyloom.queries.registry import query


@query("f1_blank_to_null", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 7 < 2 THEN NULL ELSE o_orderstatus END AS status FROM orders""")
def blank_to_null(t):
    raw = F.when(F.col("o_orderkey") % 7 == 0, "").when(F.col("o_orderkey") % 7 == 1, "  ").otherwise(F.col("o_orderstatus"))
    return t.orders.select("o_orderkey", cl.blank_to_null(raw).alias("status"))


@query("f2_safe_numeric_cast", """
    SELECT c_custkey, TRY_CAST(CASE WHEN c_custkey % 9 = 0 THEN ' ' ELSE CAST(c_acctbal AS VARCHAR) END AS DOUBLE) AS balance
    FROM customer""")
def safe_numeric_cast(t):
    raw = F.when(F.col("c_custkey") % 9 == 0, " ").otherwise(F.col("c_acctbal").cast("string"))
    return t.customer.select("c_custkey", raw.try_cast("double").alias("balance"))


@query("f3_name_normalisation", """
    SELECT p_partkey,
      array_to_string(list_transform(string_split(lower(p_name), ' '), lambda s: upper(s[1]) || s[2:]), '-') AS title,
      upper(p_name) AS join_name FROM part""")
def name_normalisation(t):
    raw = F.concat(F.lit(" "), F.regexp_replace(F.upper("p_name"), " ", "-"), F.lit("  "))
    return t.part.select(
        "p_partkey", text.title_case(raw).alias("title"),
        text.join_name(F.concat(F.lit(" "), F.col("p_name"))).alias("join_name"),
    )


@query("f4_timestamp_floor", """
    SELECT event_id, time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01') AS bucket FROM events""")
def timestamp_floor(t):
    return t.events.select("event_id", times.floor_minutes(F.col("ts"), 30).alias("bucket"))


@query("f5_calendar_parts", """
    SELECT event_id, year(ts) AS year, month(ts) AS month, day(ts) AS day, hour(ts) AS hour_of_day,
           isodow(ts) - 1 AS day_of_week, CAST(CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend FROM events""")
def calendar_parts(t):
    return t.events.select("event_id", *[c.alias(n) for n, c in times.calendar(F.col("ts")).items()])


@query("f6_parse_and_zone", """
    WITH m AS (SELECT event_id, date_trunc('second', ts) AS s, event_id % 3 AS k FROM events),
         u AS (SELECT event_id, s, CASE k WHEN 0 THEN s WHEN 1 THEN s - INTERVAL 330 MINUTE ELSE s - INTERVAL 8 HOUR END AS utc FROM m)
    SELECT event_id, strftime(utc + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S') || '+08:00' AS local_text,
           utc + INTERVAL 8 HOUR AS local_clock, s AS wall_clock FROM u""")
def parse_and_zone(t):
    zone = text.value_map(F.col("event_id") % 3, {0: "Z", 1: "+05:30"}, "")
    written = t.events.select("event_id", F.concat(times.iso_seconds(F.col("ts")), zone).alias("raw"))
    moment = times.parse_moment(F.col("raw"))
    return written.select(
        "event_id",
        times.local_text(moment).alias("local_text"),
        times.local_clock(moment).alias("local_clock"),
        times.wall_clock(F.col("raw")).alias("wall_clock"),
    )


@query("f7_first_non_empty", """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus
      WHEN o_orderkey % 3 = 1 THEN o_orderpriority ELSE 'unknown' END AS label FROM orders""")
def first_non_empty(t):
    k = F.col("o_orderkey") % 3
    a = F.when(k == 0, F.col("o_orderstatus")).when(k == 1, " ")
    b = F.when(k == 1, F.col("o_orderpriority")).otherwise("")
    return t.orders.select("o_orderkey", text.first_non_empty(a, b, F.lit("unknown")).alias("label"))


@query("f8_payload_hash", """
    SELECT event_id, sha256('{"a":"' || event_type || '","k":' || json_extract_string(props, '$.k')
           || ',"z":{"b":' || user_id || ',"c":' || event_id || '}}') AS payload_hash FROM events""")
def payload_hash(t):
    raw = F.format_string(
        '{"z": {"c": %d, "b": %d},  "k": %s, "a": "%s"}', "event_id", "user_id",
        F.get_json_object("props", "$.k"), "event_type",
    )
    return t.events.select("event_id", documents.payload_hash(raw).alias("payload_hash"))


@query("f9_record_id", """
    SELECT 'taxi:' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || ':' || user_id AS record_id, event_id FROM events""")
def record_id(t):
    made = text.record_id(F.lit("taxi"), times.iso_seconds(F.col("ts")), F.col("user_id"))
    return t.events.select(made.alias("record_id"), "event_id")


@query("f10_value_map", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'other' END AS status FROM orders""")
def value_map(t):
    return t.orders.select(
        "o_orderkey", text.value_map(F.col("o_orderstatus"), {"F": "finished", "O": "open"}, "other").alias("status")
    )


@query("f11_fill_by_column", """
    SELECT o_orderkey, COALESCE(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END, 'unknown') AS status,
           COALESCE(CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END, 0) AS price FROM orders""")
def fill_by_column(t):
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("price"),
    )
    return rows.na.fill({"status": "unknown", "price": 0.0})


@query("f12_math", """
    SELECT event_id, round(sqrt(value * value + user_id * user_id), 4) AS distance,
           CASE WHEN value > 0 THEN round(log2(value), 4) END AS log2_value, round(abs(value - 100), 4) AS gap,
           value / (user_id + 1) AS ratio FROM events""")
def math(t):
    v, u = F.col("value"), F.col("user_id")
    return t.events.select(
        "event_id",
        F.round(F.sqrt(v * v + u * u), 4).alias("distance"),
        F.when(v > 0, F.round(F.log2(v), 4)).alias("log2_value"),
        F.round(F.abs(v - 100), 4).alias("gap"),
        (v / (u + 1)).alias("ratio"),
    )


@query("f12_half_even_round", """
    SELECT p_partkey, CAST(CASE WHEN p_size % 2 = 0 THEN p_size / 2
      ELSE p_size // 2 + CASE WHEN (p_size // 2) % 2 = 1 THEN 1 ELSE 0 END END AS DOUBLE) AS half FROM part""")
def half_even_round(t):
    return t.part.select("p_partkey", F.bround(F.col("p_size") / 2.0, 0).cast("double").alias("half"))


@query("f13_flatten_nested", """
    SELECT p_partkey AS "id", p_name AS "item.name", p_size AS "item.shape.size", p_brand AS "item.shape.brand" FROM part""")
def flatten_nested(t):
    nested = t.part.select(
        F.col("p_partkey").alias("id"),
        F.struct(
            F.col("p_name").alias("name"),
            F.struct(F.col("p_size").alias("size"), F.col("p_brand").alias("brand")).alias("shape"),
        ).alias("item"),
    )
    return documents.flatten(nested)


@query("f14_explode_with_ordinal", """
    SELECT vec_id, CAST(i AS BIGINT) AS item_index, CAST(embedding[i] AS DOUBLE) AS value
    FROM embeddings, unnest(range(1, len(embedding) + 1)) AS r(i)""")
def explode_with_ordinal(t):
    return t.embeddings.select("vec_id", F.posexplode("embedding").alias("pos", "value")).select(
        "vec_id", (F.col("pos") + 1).cast("long").alias("item_index"), F.col("value").cast("double").alias("value")
    )


@query("f15_nested_default", """
    SELECT event_id, CASE WHEN event_id % 4 = 0 THEN -1 ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events""")
def nested_default(t):
    raw = F.when(F.col("event_id") % 4 == 0, "{}").otherwise(F.col("props"))
    parsed = F.from_json(F.concat(F.lit('{"data": '), raw, F.lit("}")), "data struct<k: bigint>")
    return t.events.select("event_id", F.coalesce(parsed["data"]["k"], F.lit(-1)).alias("k"))


@query("f16_structure_preview", """
    SELECT conv_id, turn // 100 AS page, count(*) AS turns, CAST(least(count(*), 2) AS BIGINT) AS shown,
           CASE WHEN length(min_by(text, turn)) > 20 THEN substring(min_by(text, turn), 1, 20) || '...'
                ELSE min_by(text, turn) END AS first_text
    FROM conversations GROUP BY conv_id, turn // 100""")
def structure_preview(t):
    docs = jn.fold_pages(
        t.conversations.select("conv_id", "turn", F.struct("role", "text").alias("item")),
        ["conv_id"], "turn", 100, {"turns_list": "item"},
    ).withColumn("turns", F.size("turns_list").cast("long"))
    short = documents.preview(docs, items=2, chars=20)
    return short.select(
        "conv_id", "page", "turns", F.size("turns_list").cast("long").alias("shown"),
        F.col("turns_list")[0]["text"].alias("first_text"),
    )


@query("f17_json_validity", """
    SELECT event_id, event_id % 50 <> 0 AS valid FROM events""")
def json_validity(t):
    raw = F.when(F.col("event_id") % 50 == 0, F.concat("props", F.lit(' "x'))).otherwise(F.col("props"))
    broken = F.when(F.col("event_id") % 50 == 0, F.substring("props", 1, 4)).otherwise(raw)
    return t.events.select("event_id", documents.is_valid_json(broken).alias("valid"))


@query("f18_json_render", """
    SELECT p_partkey, '{"id":' || p_partkey || ',"name":"' || p_name || '","size":' || p_size || '}' AS compact FROM part""")
def json_render(t):
    body = F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))
    return t.part.select("p_partkey", F.to_json(body).alias("compact"))


_FORECASTS = {
    "click": "Thundery Showers", "view": "Partly Cloudy (Day)", "error": "Light Rain",
    "signup": "Fair (Night)", "purchase": "Moderate Rain",
}


@query("f19_rain_flag", """
    WITH f AS (SELECT event_id, CASE event_type WHEN 'click' THEN 'Thundery Showers' WHEN 'view' THEN 'Partly Cloudy (Day)'
        WHEN 'error' THEN 'Light Rain' WHEN 'signup' THEN 'Fair (Night)' ELSE 'Moderate Rain' END AS forecast FROM events)
    SELECT event_id, CASE WHEN regexp_matches(lower(forecast), 'rain|shower|thunder') THEN 1 ELSE 0 END AS is_rain,
      CAST(CASE forecast WHEN 'Fair (Night)' THEN 0 WHEN 'Partly Cloudy (Day)' THEN 1 WHEN 'Light Rain' THEN 2 ELSE -1 END AS BIGINT) AS category
    FROM f""")
def rain_flag(t):
    forecast = text.value_map(F.col("event_type"), _FORECASTS)
    return t.events.select(
        "event_id", text.rain_flag(forecast).alias("is_rain"),
        text.category_id(forecast, ["Fair (Night)", "Partly Cloudy (Day)", "Light Rain"]).alias("category"),
    )


@query("f20_intensity_class", """
    SELECT event_id, CASE WHEN value / 50 * 12 < 0.5 THEN 'none' WHEN value / 50 * 12 < 2 THEN 'light'
      WHEN value / 50 * 12 < 10 THEN 'moderate' WHEN value / 50 * 12 < 30 THEN 'heavy' ELSE 'violent' END AS class FROM events""")
def intensity_class(t):
    return t.events.select("event_id", text.intensity_class(F.col("value") / 50).alias("class"))


@query("f21_share_class", """
    WITH m AS (SELECT event_id, event_type, value, max(value) OVER (PARTITION BY event_type) AS top FROM events)
    SELECT event_id, CASE WHEN value <= 0 THEN 'empty' WHEN value / greatest(top, 1) < 0.15 THEN 'very low'
      WHEN value / greatest(top, 1) < 0.35 THEN 'low' WHEN value / greatest(top, 1) < 0.60 THEN 'medium'
      WHEN value / greatest(top, 1) < 0.85 THEN 'high' ELSE 'top' END AS class FROM m""")
def share_class(t):
    largest = t.events.groupBy("event_type").agg(F.max("value").alias("top"))
    return t.events.join(largest, "event_type").select(
        "event_id", text.share_class(F.col("value"), F.col("top")).alias("class")
    )


@query("f22_timestamp_text", """
    SELECT event_id, strftime(ts, '%Y%m%d_%H%M%S') AS file_stamp, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM events""")
def timestamp_text(t):
    return t.events.select(
        "event_id", times.file_stamp(F.col("ts")).alias("file_stamp"), times.iso_seconds(F.col("ts")).alias("iso")
    )


@query("f23_arg_max", """
    SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS predicted,
           CAST(list_max(embedding) AS DOUBLE) AS confidence FROM embeddings""")
def arg_max(t):
    return t.embeddings.select(
        "vec_id", vectors.arg_max(F.col("embedding")).alias("predicted"),
        F.array_max("embedding").cast("double").alias("confidence"),
    )


@query("k1_scalar_function", """
    SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'medium' ELSE 'large' END AS size_class FROM part""")
def scalar_function(t):
    size = F.when(F.col("p_size") <= 10, "small").when(F.col("p_size") <= 30, "medium").otherwise("large")
    return t.part.select("p_partkey", size.alias("size_class"))


@query("k2_row_function", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 300000 THEN 'large done'
      WHEN o_orderpriority = '1-URGENT' THEN 'urgent' ELSE 'normal' END AS kind FROM orders""")
def row_function(t):
    kind = (
        F.when((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 300000), "large done")
        .when(F.col("o_orderpriority") == "1-URGENT", "urgent")
        .otherwise("normal")
    )
    return t.orders.select("o_orderkey", kind.alias("kind"))


@query("k3_aggregate_lambda", """
    SELECT l_returnflag, count(*) AS n, round(100 * (1 - avg(CASE WHEN l_discount > 0.05 THEN 1.0 ELSE 0.0 END)), 6) AS error_rate
    FROM lineitem GROUP BY l_returnflag""")
def aggregate_lambda(t):
    hit = F.when(F.col("l_discount") > 0.05, 1.0).otherwise(0.0)
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count("*").alias("n"), F.round(100 * (1 - F.avg(hit)), 6).alias("error_rate")
    )
