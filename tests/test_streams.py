"""Streams equal their batch twins, and repeated work leaves no copies."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyloom.operators import ingest, models
from tallyloom.operators.estimators import GroupMedianImputer
from tallyloom.plans.scratch import checkpointed, run_dir, shared_root
from tallyloom.session import Tables
from tallyloom.streaming import jobs


@pytest.fixture(scope="module")
def landed(spark):
    """Events in three files, in time order."""
    t = Tables(spark, "/root/testdata/sf0.001")
    path = run_dir(spark, "three-files")
    for low, high in ((1, 10), (11, 20), (21, 31)):
        t.events.filter(F.day("ts").between(low, high)).coalesce(1).write.mode("append").parquet(path)
    return t.events, path


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


def test_tumbling_counts_over_many_batches(spark, landed):
    events, path = landed
    target, marks = run_dir(spark, "out"), run_dir(spark, "marks")
    stream = jobs.tumbling_counts(jobs.parquet_stream(spark, path, events.schema, files_per_batch=1), "ts", "event_type", "30 minutes", "1 day")
    jobs.run(stream, marks, jobs.batch_folder_sink(target), "update")
    got = jobs.read_updates(spark, target, ["bucket", "event_type"], stream.schema)
    want = events.groupBy(F.window("ts", "30 minutes")["start"].alias("bucket"), "event_type").agg(F.count("*").alias("n"))
    assert pairs(got) == pairs(want)


def test_closed_sessions(spark, landed):
    events, path = landed
    target, marks = run_dir(spark, "out"), run_dir(spark, "marks")
    stream = jobs.session_activity(jobs.parquet_stream(spark, path, events.schema, files_per_batch=1), "ts", "event_type", "1 hour", "1 hour")
    jobs.run(stream, marks, jobs.batch_folder_sink(target), "append")
    rows = spark.read.schema(stream.schema).parquet(target).select(*stream.columns)
    # The watermark ends one hour before the newest event.
    edge = events.agg(F.max("ts") - F.expr("interval 1 hour")).first()[0]
    batch = events.groupBy(F.session_window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"))
    want = batch.select("event_type", F.col("w.start"), F.col("w.end"), "n").filter(F.col("end") <= F.lit(edge))
    assert pairs(rows) == pairs(want) and rows.count() > 0


def test_resume_reads_only_new_files(spark, landed):
    events, path = landed
    target, marks = run_dir(spark, "out"), run_dir(spark, "marks")
    for _ in range(2):
        jobs.run(jobs.parquet_stream(spark, path, events.schema), marks, jobs.batch_folder_sink(target))
    assert spark.read.parquet(target).count() == events.count()


def test_replayed_batch_routes_the_same_rows(spark, landed):
    events, _ = landed
    on_time, late, marks = (run_dir(spark, n) for n in ("on", "late", "mk"))
    sink = jobs.late_router(spark, on_time, late, marks, "ts", 3600)
    first, second = events.filter(F.day("ts") > 15), events.filter(F.day("ts") <= 15)
    for batch, number in ((first, 0), (second, 1), (second, 1)):
        sink(batch, number)
    assert spark.read.parquet(on_time).count() == first.count()
    assert spark.read.parquet(late).count() == second.count()


def test_snapshot_replaced_twice(spark, landed):
    events, _ = landed
    target = run_dir(spark, "snap")
    rows = events.select("event_id", F.day("ts").alias("day"))
    for batch in (rows, rows.filter("day > 20"), rows.filter("day > 20")):
        ingest.replace_snapshots(batch, target, ["day"])
    assert pairs(spark.read.parquet(target).select("event_id")) == pairs(rows.select("event_id"))


def test_insert_or_ignore_is_repeatable(spark, landed):
    events, _ = landed
    target = run_dir(spark, "ignore")
    rows = events.select("event_id", "value")
    assert ingest.insert_or_ignore(rows.union(rows), target, ["event_id"], [F.col("value")]) == rows.count()
    assert ingest.insert_or_ignore(rows, target, ["event_id"], [F.col("value")]) == 0


def test_backfill_order_does_not_matter(spark, landed):
    events, _ = landed

    def job(rows):
        return rows.groupBy(F.day("ts").alias("day")).agg(F.count("*").alias("n"))

    def moment(day):
        return F.lit(datetime(2024, 1, day)).cast("timestamp_ntz")

    found = []
    for order in ([(1, 12), (12, 31)], [(12, 31), (1, 12), (12, 31)]):
        target = run_dir(spark, "backfill")
        for low, high in order:
            ingest.backfill(lambda: events, job, "ts", moment(low), moment(high), target, ["day"])
        found.append(pairs(spark.read.parquet(target).select("day", "n")))
    assert found[0] == found[1]


def test_weather_time_falls_back(spark):
    docs = spark.createDataFrame([
        ('{"items": [{"update_timestamp": "u", "forecasts": [{"area": "A", "forecast": "Fair"}]}]}',),
        ('{"data": {"items": [{"timestamp": "t", "valid_period": {"start": "s", "end": "e"}, "forecasts": [{"area": "B"}]}]}}',),
        ('{"items": []}',), ("not json",),
    ], "raw string")
    got = {r["area"]: (r["api_timestamp"], r["api_update_timestamp"], r["valid_period_start"]) for r in ingest.flatten_weather(docs, "raw", "x").collect()}
    assert got == {"A": ("u", "u", None), "B": ("t", "t", "s")}


def test_imputer_learns_from_training_rows_only(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None)], "k string, v double")
    model = GroupMedianImputer(["k"], "v", "f").fit(rows)
    later = spark.createDataFrame([("a", None), ("c", None), ("a", 100.0)], "k string, v double")
    assert sorted(r["f"] for r in model.transform(later).collect()) == [2.0, 2.0, 100.0]


def test_permutation_keeps_every_value(spark):
    rows = spark.range(50).select("id", (F.col("id") * 2).alias("v"))
    mixed = models.permuted(rows, "id", "v", 3).collect()
    assert sorted(r["v"] for r in mixed) == [2 * i for i in range(50)]
    assert sum(r["v"] != 2 * r["id"] for r in mixed) == 50


def test_checkpoints_use_the_configured_folder(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert checkpointed(spark.range(5)).count() == 5
    assert spark.sparkContext.getCheckpointDir().startswith(("file:" + shared_root(spark), shared_root(spark)))
