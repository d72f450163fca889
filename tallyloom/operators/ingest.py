"""Payload flattening, drift, and loads that are safe to repeat."""

from __future__ import annotations

import traceback
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.joins import map_of_last
from tallyloom.operators.selection import keep_first
from tallyloom.plans.literals import literal_table

_TAXI = """features array<struct<properties: struct<timestamp: string, taxi_count: bigint>,
                  geometry: struct<coordinates: array<array<double>>>>>"""
_ITEMS = """items array<struct<timestamp: string, update_timestamp: string, valid_period: struct<start: string, end: string>,
               forecasts: array<struct<area: string, forecast: string>>>>"""
_RAIN = """stations array<struct<id: string, deviceId: string, name: string, location: struct<latitude: double, longitude: double>>>,
           readings array<struct<timestamp: string, data: array<struct<stationId: string, value: double>>>>"""


def _colons(fields: str) -> str:
    """Field list of a struct type from a top-level field list."""
    out, depth = [], 0
    for word in fields.split():
        out.append(word + ":" if depth == 0 and word.isidentifier() else word)
        depth += word.count("<") - word.count(">")
    return " ".join(out)


def _payload(raw: str, fields: str) -> Column:
    """Parsed document whose fields sit at the top or below ``data``."""
    nested = F.from_json(F.col(raw), f"data struct<{_colons(fields)}>")["data"]
    return F.coalesce(nested, F.from_json(F.col(raw), fields))


def flatten_taxi(docs: DataFrame, raw: str, source: str) -> DataFrame:
    """One row per coordinate pair, numbered from 1 within its feature.

    Ids of a second or later feature also carry the feature's number.

    A coordinate with fewer than two values keeps its number but gives no row.
    """
    features = docs.select(F.posexplode(F.from_json(F.col(raw), _TAXI)["features"]).alias("f", "feature"))
    rows = features.select(
        "f", F.col("feature.properties").alias("p"), F.posexplode("feature.geometry.coordinates").alias("i", "c")
    ).filter(F.size("c") >= 2)
    index = (F.col("i") + 1).cast("long")
    return rows.select(
        F.concat_ws(":", F.lit("taxi"), "p.timestamp", F.when(F.col("f") > 0, F.col("f") + 1), index).alias("record_id"),
        F.col("p.timestamp").alias("api_timestamp"),
        index.alias("taxi_index"),
        F.col("c")[0].alias("longitude"),
        F.col("c")[1].alias("latitude"),
        F.col("p.taxi_count").alias("available_taxi_count"),
        F.lit(source).alias("source"),
    )


def flatten_weather(docs: DataFrame, raw: str, source: str) -> DataFrame:
    """One row per area forecast of every item; a missing time stamp is
    taken from the other one."""
    rows = docs.select(F.explode(_payload(raw, _ITEMS)["items"]).alias("it")).select("it", F.explode("it.forecasts").alias("f"))
    update = F.coalesce(F.nullif(F.col("it.update_timestamp"), F.lit("")), F.col("it.timestamp"))
    return rows.select(
        F.concat_ws(":", F.lit("weather"), update, "f.area").alias("record_id"),
        F.coalesce(F.nullif(F.col("it.timestamp"), F.lit("")), update).alias("api_timestamp"),
        update.alias("api_update_timestamp"),
        F.col("f.area").alias("area"),
        F.col("f.forecast").alias("forecast"),
        F.col("it.valid_period.start").alias("valid_period_start"),
        F.col("it.valid_period.end").alias("valid_period_end"),
        F.lit(source).alias("source"),
    )


def flatten_rainfall(docs: DataFrame, raw: str, source: str) -> DataFrame:
    """One row per station reading, with the station's name and place."""
    bodies = docs.select(_payload(raw, _RAIN).alias("body"))
    entries = F.transform("body.stations", lambda s: F.named_struct(F.lit("k"), F.coalesce(s["id"], s["deviceId"]), F.lit("v"), s))
    # the map is made ahead of the explode: once a document, not once a reading
    blocks = bodies.select(map_of_last(entries).alias("m"), F.col("body.readings").alias("readings")).select("m", F.explode("readings").alias("r"))
    rows = blocks.select("m", F.col("r.timestamp").alias("ts"), F.explode("r.data").alias("d"))
    station = F.try_element_at(F.col("m"), F.col("d.stationId"))
    return rows.select(
        F.concat_ws(":", F.lit("rainfall"), "ts", "d.stationId").alias("record_id"),
        F.col("ts").alias("reading_timestamp"),
        F.col("d.stationId").alias("station_id"),
        station["name"].alias("station_name"),
        station["location"]["longitude"].alias("longitude"),
        station["location"]["latitude"].alias("latitude"),
        F.col("d.value").alias("rainfall_mm"),
        F.lit(source).alias("source"),
    )


def raw_envelopes(spark: SparkSession, path: str, api_name: str) -> DataFrame:
    """Landed payload files as rows: text plus where and when it came from."""
    return spark.read.option("wholetext", True).text(path).select(
        F.lit(api_name).alias("api_name"),
        F.col("_metadata.file_path").alias("requested_url"),
        F.lit(200).alias("status_code"),
        F.col("_metadata.file_modification_time").alias("downloaded_at"),
        F.col("value").alias("raw_json"),
    )


def import_log(df: DataFrame) -> DataFrame:
    """Rows and load time per file of a scanned source."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("_metadata.file_modification_time").alias("loaded_at")
    )


def unify_drift(frames: Sequence[DataFrame], aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Stack versions of a source and give renamed fields their one name."""
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    for name, old in aliases.items():
        present = [c for c in (name, *old) if c in stacked.columns]
        merged = F.coalesce(*[F.col(c) for c in present])
        stacked = stacked.withColumn("__u", merged).drop(*present).withColumnRenamed("__u", name)
    return stacked


def missing_numbers(landed: DataFrame, number: str, first: int, last: Column | int) -> DataFrame:
    """Numbers of the expected sequence that never arrived."""
    spark = landed.sparkSession
    if not isinstance(last, int):
        last = landed.agg(last).first()[0]
    expected = spark.range(first, int(last) + 1).withColumnRenamed("id", number)
    return expected.join(landed.select(number), number, "left_anti")


def dedupe_records(df: DataFrame, record_id: str, order: Sequence[Column]) -> DataFrame:
    return keep_first(df, [record_id], order)


def newer_than(df: DataFrame, column: str, mark) -> DataFrame:
    """Rows past the stored high-water mark; all rows when there is none."""
    return df if mark is None else df.filter(F.col(column) > F.lit(mark))


def load_increment(source: DataFrame, column: str, target: str) -> int:
    """Append rows from the target's newest time on that it does not hold yet; return how many.

    The batch is written under the mark it starts from, so repeating a load
    that died half-way replaces its own folder and never duplicates rows. Rows
    of the very time of the mark that arrive late are told from loaded ones by
    their whole content; they and later loads from the same mark share a folder.
    """
    spark = source.sparkSession
    try:
        loaded = spark.read.option("basePath", target).parquet(target)
        mark = loaded.agg(F.max(column)).first()[0]
    except AnalysisException:
        mark = None
    batch, label, before = source, "start", 0
    if mark is not None:
        label = mark.strftime("%Y%m%dT%H%M%S%f")
        own, others = (loaded.filter(c) for c in (F.col("since") == label, F.col("since") != label))
        before = own.count()
        at_mark = others.filter(F.col(column) == F.lit(mark)).select(*source.columns)
        batch = newer_than(source, column, mark).unionByName(source.filter(F.col(column) == F.lit(mark)).exceptAll(at_mark))
    if batch.isEmpty():
        return 0
    folder = f"{target}/since={label}"
    batch.write.mode("overwrite").parquet(folder)
    return spark.read.parquet(folder).count() - before


def insert_or_ignore(batch: DataFrame, target: str, keys: Sequence[str], order: Sequence[Column]) -> int:
    """Append rows whose key is new to the target; return how many.

    The batch keeps one row per key, then an anti join drops known keys.
    """
    spark = batch.sparkSession
    unique = keep_first(batch, keys, order)
    try:
        known = spark.read.parquet(target)
    except AnalysisException:
        known = None
    fresh = unique if known is None else unique.join(known.select(*keys), list(keys), "left_anti")
    before = 0 if known is None else known.count()
    fresh.write.mode("append").parquet(target)
    return spark.read.parquet(target).count() - before


def replace_snapshots(batch: DataFrame, target: str, partition: Sequence[str]) -> None:
    """Replace exactly the partitions that occur in the batch.

    Delete-and-insert as one commit: a rerun writes the same partitions again.
    """
    batch.hint("rebalance", *partition).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*partition).parquet(target)


def backfill(
    read: Callable[[], DataFrame], job: Callable[[DataFrame], DataFrame], time: str, start, end,
    target: str, partition: Sequence[str],
) -> None:
    """Recompute [start, end) into its own partitions; order and repeats do
    not matter. Intervals must align with the partitions."""
    rows = read().filter((F.col(time) >= F.lit(start)) & (F.col(time) < F.lit(end)))
    replace_snapshots(job(rows), target, partition)


def logged_run(spark: SparkSession, log: str, source: str, job: Callable[[], int]) -> bool:
    """Run a job and append start, end, status, rows and message to the log.

    A failure is logged as well and reported by the return value.
    """
    started = spark.sql("SELECT current_timestamp()").first()[0]
    try:
        rows, status, message = job(), "success", ""
    except Exception as error:
        rows, status = 0, "failed"
        message = "".join(traceback.format_exception_only(error)).strip()
    entry = literal_table(
        spark, [(source, started, status, rows, message)],
        "source string, started_at timestamp, status string, rows bigint, message string",
    ).withColumn("ended_at", F.current_timestamp())
    entry.write.mode("append").parquet(log)
    return status == "success"


def enough_snapshots(df: DataFrame, keys: Sequence[str], snapshot: Column, least: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(snapshot).alias("snapshots")).withColumn(
        "sufficient", F.col("snapshots") >= F.lit(least)
    )


def expected_counts(df: DataFrame, source: str, record_id: str) -> DataFrame:
    """Rows, unique records and surplus copies per source."""
    return df.groupBy(source).agg(
        F.count(F.lit(1)).alias("received"), F.count_distinct(record_id).alias("unique_records")
    ).withColumn("duplicates", F.col("received") - F.col("unique_records"))


def rows_of_payload(docs: DataFrame, raw: str, row_type: str, wrapper: str = "data") -> DataFrame:
    """Rows of a payload that is either a list or an object around a list."""
    rows = F.when(
        F.ltrim(F.col(raw)).startswith("["), F.from_json(F.col(raw), f"array<{row_type}>")
    ).otherwise(F.from_json(F.col(raw), f"{wrapper} array<{row_type}>")[wrapper])
    return docs.select(F.inline(rows))
