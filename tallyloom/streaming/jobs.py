"""Streaming forms of the batch jobs.

Every stream is run with ``availableNow`` by default: it takes what has arrived
and stops, and the next run goes on from its checkpoint. Sinks are idempotent:
a repeated batch overwrites its own folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.operators.ingest import replace_snapshots


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.parquet",
                   files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run(stream: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None], mode: str = "append",
        trigger: dict | None = None) -> None:
    """Run until all available input is processed."""
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    query.awaitTermination()


def batch_folder_sink(target: str) -> Callable[[DataFrame, int], None]:
    """Each batch owns a folder, so a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return write


def snapshot_sink(target: str, partition: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """Replace the snapshot partitions that the batch contains."""

    def write(batch: DataFrame, batch_id: int) -> None:
        replace_snapshots(batch, target, partition)

    return write


def read_updates(spark: SparkSession, target: str, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """Current rows of an update-mode stream: per key, those of its last batch."""
    full = T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
    rows = spark.read.schema(full).parquet(target)
    rest = [f.name for f in schema.fields if f.name not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("__r"))
    return last.select(*keys, *[F.col("__r")[c].alias(c) for c in rest])


def event_time(stream: DataFrame, time: str, delay: str) -> DataFrame:
    """Watermark on ``time``; zone-less times are taken as UTC instants, as the
    session time zone says, because watermarks need an instant."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def _clock(column: str) -> Column:
    return F.col(column).cast("timestamp_ntz")


def tumbling_counts(stream: DataFrame, time: str, area: str, width: str, delay: str) -> DataFrame:
    return (
        event_time(stream, time, delay)
        .groupBy(F.window(time, width).alias("w"), area)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(_clock("w.start").alias("bucket"), area, "n")
    )


def sliding_demand(stream: DataFrame, time: str, area: str, width: str, step: str, delay: str, value: str) -> DataFrame:
    return (
        event_time(stream, time, delay)
        .groupBy(F.window(time, width, step).alias("w"), area)
        .agg(F.count(F.lit(1)).alias("n"), F.max(value).alias("peak"))
        .select(_clock("w.start").alias("window_start"), area, "n", "peak")
    )


def session_activity(stream: DataFrame, time: str, key: str, gap: str, delay: str) -> DataFrame:
    """Sessions per key; a stream emits a session once the watermark passes it."""
    return (
        event_time(stream, time, delay)
        .groupBy(F.session_window(time, gap).alias("w"), key)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(key, _clock("w.start").alias("session_start"), _clock("w.end").alias("session_close"), "n")
    )


def drop_repeats(stream: DataFrame, time: str, keys: Sequence[str], delay: str) -> DataFrame:
    return event_time(stream, time, delay).dropDuplicatesWithinWatermark(list(keys))


def late_router(spark: SparkSession, on_time: str, late: str, marks: str, time: str, delay_seconds: int):
    """Sink that sends rows older than the newest time of earlier batches minus
    the delay to a side table. The newest time per batch is kept as a table, so
    a replayed batch sees the same marks and routes the same rows."""

    def newest_before(batch_id: int):
        try:
            seen = spark.read.schema("newest timestamp_ntz, batch bigint").parquet(marks)
        except AnalysisException:
            return None
        return seen.filter(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]

    def write(batch: DataFrame, batch_id: int) -> None:
        newest = newest_before(batch_id)
        edge = F.lit(newest).cast("timestamp_ntz") - F.expr(f"interval {delay_seconds} seconds")
        is_late = F.lit(False) if newest is None else F.coalesce(F.col(time) < edge, F.lit(False))
        kept = batch.persist()  # three writes, one reading of the source
        try:
            kept.filter(~is_late).write.mode("overwrite").parquet(f"{on_time}/batch={batch_id}")
            kept.filter(is_late).write.mode("overwrite").parquet(f"{late}/batch={batch_id}")
            kept.agg(F.max(time).alias("newest")).write.mode("overwrite").parquet(f"{marks}/batch={batch_id}")
        finally:
            kept.unpersist()

    return write


def latest_features(stream: DataFrame, entity: str, time: str, values: Sequence[str], tie: str) -> DataFrame:
    """Newest values per entity, kept as one row of state per entity."""
    newest = F.max(F.struct(F.col(time), F.col(tie), *[F.col(v) for v in values])).alias("__n")
    return stream.groupBy(entity).agg(newest).select(
        entity, F.col("__n")[time].alias(time), *[F.col("__n")[v].alias(v) for v in values]
    )


def with_areas(stream: DataFrame, areas: DataFrame, key: str) -> DataFrame:
    """Stream joined with a static reference table."""
    return stream.join(areas, key, "left")


def join_actuals(predictions: DataFrame, actuals: DataFrame, key: str, made: str, seen: str, delay: str, horizon: str) -> DataFrame:
    """Predictions with the actuals that arrive within the horizon; both sides
    keep state only until their watermarks pass it. A prediction without an
    actual comes out with nulls once the watermark has passed its horizon."""
    p = event_time(predictions, made, delay).alias("p")
    a = event_time(actuals, seen, delay).alias("a")
    within = (
        (F.col(f"p.{key}") == F.col(f"a.{key}"))
        & (F.col(f"a.{seen}") >= F.col(f"p.{made}"))
        & (F.col(f"a.{seen}") <= F.col(f"p.{made}") + F.expr(f"interval {horizon}"))
    )
    rest = [F.col(f"a.{c}") for c in actuals.columns if c != key]
    return p.join(a, within, "left").select("p.*", *rest)


def staleness(df: DataFrame, entity: str, time: str, now, limit_minutes: int) -> DataFrame:
    """Newest time per entity, its age at ``now`` and an alert flag."""
    newest = df.groupBy(entity).agg(F.max(time).alias("latest"))
    age = (F.unix_micros(F.lit(now).cast("timestamp_ntz").cast("timestamp")) - F.unix_micros(F.col("latest").cast("timestamp"))) / F.lit(60e6)
    return newest.withColumn("age_minutes", age).withColumn("stale", age > F.lit(limit_minutes))
