"""Streaming jobs run to the end of the given events, and their batch twins."""

from pyspark.sql import functions as F

from tallyloom.plans.literals import literal_table
from tallyloom.plans import timejoin
from tallyloom.plans.scratch import run_dir
from tallyloom.queries.registry import query
from tallyloom.streaming import jobs

_BUCKET = "time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01')"


def event_stream(t):
    return jobs.parquet_stream(t.spark, t.sf_dir, t.events.schema, "events.parquet")


def to_table(t, stream, keys, mode, purpose):
    """Run a stream into a new table and read its current rows."""
    target, marks = run_dir(t.spark, purpose), run_dir(t.spark, f"{purpose}-checkpoint")
    jobs.run(stream, marks, jobs.batch_folder_sink(target), mode)
    return jobs.read_updates(t.spark, target, keys, stream.schema)


@query("t1_tumbling_counts", f"""
    SELECT {_BUCKET} AS bucket, user_id, count(*) AS n FROM events GROUP BY ALL""")
def tumbling_counts(t):
    counts = jobs.tumbling_counts(event_stream(t), "ts", "user_id", "30 minutes", "2 days")
    return to_table(t, counts, ["bucket", "user_id"], "update", "tumbling")


@query("t2_sliding_demand", """
    WITH s AS (SELECT user_id, value, unnest(range(0, 8)) AS k, time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '1970-01-01') AS b FROM events)
    SELECT b - INTERVAL 15 MINUTE * k AS window_start, user_id, count(*) AS n, max(value) AS peak FROM s GROUP BY ALL""")
def sliding_demand(t):
    return jobs.sliding_demand(t.events, "ts", "user_id", "2 hours", "15 minutes", "2 days", "value")


@query("t2_sliding_demand_stream", """
    WITH s AS (SELECT event_type, value, unnest(range(0, 8)) AS k, time_bucket(INTERVAL 15 MINUTE, ts, TIMESTAMP '1970-01-01') AS b FROM events)
    SELECT b - INTERVAL 15 MINUTE * k AS window_start, event_type, count(*) AS n, max(value) AS peak FROM s GROUP BY ALL""")
def sliding_demand_stream(t):
    demand = jobs.sliding_demand(event_stream(t), "ts", "event_type", "2 hours", "15 minutes", "2 days", "value")
    return to_table(t, demand, ["window_start", "event_type"], "update", "sliding")


@query("t3_session_activity", """
    WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 4 HOUR THEN 1 ELSE 0 END AS fresh FROM events),
         i AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS island FROM g)
    SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n FROM i GROUP BY user_id, island""")
def session_activity(t):
    return timejoin.sessions(t.events, ["user_id"], "ts", 4 * 3600)


@query("t4_stream_dedupe", "SELECT event_id, user_id, value FROM events")
def stream_dedupe(t):
    """Events arrive once, and a third of them a second time."""
    landed = run_dir(t.spark, "repeated-events")
    rows = t.events.select("event_id", "ts", "user_id", "value")
    rows.write.parquet(landed)
    rows.filter(F.col("value") > 50).write.mode("append").parquet(landed)
    stream = jobs.parquet_stream(t.spark, landed, rows.schema)
    once = jobs.drop_repeats(stream, "ts", ["event_id"], "60 days")
    return to_table(t, once, ["event_id"], "append", "deduped").drop("ts")


@query("t5_late_routing", """
    WITH m AS (SELECT max(ts) - INTERVAL 1 DAY AS edge FROM events WHERE event_type <> 'purchase')
    SELECT event_id, event_type = 'purchase' AND ts < edge AS late FROM events, m""")
def late_routing(t):
    """Purchases arrive after all other events."""
    landed, on_time, late, marks, checkpoint = (
        run_dir(t.spark, n) for n in ("arrivals", "on-time", "late", "marks", "late-checkpoint")
    )
    rows = t.events.select("event_id", "ts", "event_type")
    sink = jobs.late_router(t.spark, on_time, late, marks, "ts", 86_400)
    for arrival in (rows.filter(F.col("event_type") != "purchase"), rows.filter(F.col("event_type") == "purchase")):
        arrival.write.mode("append").parquet(landed)
        jobs.run(jobs.parquet_stream(t.spark, landed, rows.schema), checkpoint, sink)
    read = t.spark.read.schema("event_id bigint")
    return read.parquet(on_time).select("event_id", F.lit(False).alias("late")).unionByName(
        read.parquet(late).select("event_id", F.lit(True).alias("late"))
    )


@query("t6_idempotent_sink", "SELECT event_id, user_id, CAST(day(ts) AS BIGINT) AS day FROM events")
def idempotent_sink(t):
    """The same stream twice from the start; snapshots are there once."""
    target = run_dir(t.spark, "stream-snapshots")
    stream = event_stream(t).select("event_id", "user_id", F.day("ts").alias("day"))
    for attempt in range(2):
        jobs.run(stream, run_dir(t.spark, "sink-checkpoint"), jobs.snapshot_sink(target, ["day"]))
    return t.spark.read.parquet(target).select("event_id", "user_id", F.col("day").cast("long").alias("day"))


@query("t7_online_features", """
    SELECT user_id, max(ts) AS ts, arg_max(value, ts) AS value, arg_max(event_type, ts) AS event_type FROM events GROUP BY user_id""")
def online_features(t):
    newest = jobs.latest_features(event_stream(t), "user_id", "ts", ["value", "event_type"], "event_id")
    return to_table(t, newest, ["user_id"], "update", "online")


@query("t8_stream_static_join", """
    SELECT event_id, n_name AS area FROM events LEFT JOIN nation ON n_nationkey = user_id % 30""")
def stream_static_join(t):
    areas = t.nation.select(F.col("n_nationkey").cast("long").alias("area_id"), F.col("n_name").alias("area"))
    stream = event_stream(t).select("event_id", (F.col("user_id") % 30).alias("area_id"))
    joined = jobs.with_areas(stream, areas, "area_id").select("event_id", "area")
    return to_table(t, joined, ["event_id"], "append", "with-area")


@query("t9_staleness", """
    SELECT user_id, max(ts) AS latest, round((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 60000000.0, 4) AS age_minutes,
           (epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 60000000.0 > 300 AS stale FROM events GROUP BY user_id""")
def staleness(t):
    found = jobs.staleness(t.events, "user_id", "ts", "2024-01-31", 300)
    return found.withColumn("age_minutes", F.round("age_minutes", 4))


@query("t10_prediction_actual_join", """
    SELECT event_id, value AS prediction, value + user_id AS actual FROM events""")
def prediction_actual_join(t):
    predictions = event_stream(t).select("event_id", F.col("ts").alias("made"), F.col("value").alias("prediction"))
    actuals = event_stream(t).select(
        "event_id", (F.col("ts") + F.expr("interval 30 minutes")).alias("seen"), (F.col("value") + F.col("user_id")).alias("actual")
    )
    joined = jobs.join_actuals(predictions, actuals, "event_id", "made", "seen", "2 days", "2 hours")
    return to_table(t, joined.select("event_id", "prediction", "actual"), ["event_id"], "append", "actuals")


@query("i7_checkpoint_resume", """
    SELECT 'first' AS run, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-16'
    UNION ALL SELECT 'second', count(*) FROM events UNION ALL SELECT 'third', count(*) FROM events""")
def checkpoint_resume(t):
    """Half of the data, then the rest, then nothing new, one checkpoint."""
    landed, target, checkpoint = (run_dir(t.spark, n) for n in ("resume-landed", "resume-target", "resume-checkpoint"))
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    rows, counts = t.events.select("event_id", "ts"), []
    for arrival in (rows.filter(F.col("ts") < cut), rows.filter(F.col("ts") >= cut), None):
        if arrival is not None:
            arrival.write.mode("append").parquet(landed)
        jobs.run(jobs.parquet_stream(t.spark, landed, rows.schema), checkpoint, jobs.batch_folder_sink(target))
        counts.append(t.spark.read.parquet(target).count())
    return literal_table(t.spark, list(zip(("first", "second", "third"), counts)), "run string, n bigint")
