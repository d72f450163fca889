"""Star schema over area snapshots, and the marts that are served from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import join_name
from tallyloom.operators.selection import at_or_latest
from tallyloom.plans.ordering import surrogate_keys


def stage(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Select and cast to declared types; text that does not fit becomes null."""
    return df.select(*[F.col(c).try_cast(kind).alias(c) for c, kind in columns.items()])


def area_dimension(staged: Sequence[DataFrame]) -> DataFrame:
    """Distinct areas of all sources, numbered in name order."""
    areas = staged[0].select("area")
    for frame in staged[1:]:
        areas = areas.union(frame.select("area"))
    return surrogate_keys(areas, "area", "area_id")


def to_fact(staged: DataFrame, dimension: DataFrame) -> DataFrame:
    """Replace the area name by its key."""
    return staged.join(dimension, "area").drop("area")


def area_snapshot(weather: DataFrame, taxi: DataFrame, rain: DataFrame, dimension: DataFrame) -> DataFrame:
    """Three facts side by side per area and time, weather leading."""
    keys = ["area_id", "timestamp_30min"]
    return weather.join(taxi, keys, "left").join(rain, keys, "left").join(dimension, "area_id")


def current_snapshot(fact: DataFrame, dimension: DataFrame, measure: str, requested=None) -> DataFrame:
    """The requested or latest snapshot with area names, largest first."""
    rows = at_or_latest(fact, F.col("timestamp_30min"), requested).join(dimension, "area_id")
    return rows.select("timestamp_30min", "area", measure).orderBy(F.col(measure).desc(), "area")


def area_series(fact: DataFrame, weather: DataFrame, dimension: DataFrame, area: str) -> DataFrame:
    """Series of one area, any case, with the weather of the same time."""
    wanted = dimension.filter(join_name(F.col("area")) == area.strip().upper())
    keys = ["area_id", "timestamp_30min"]
    return fact.join(wanted, "area_id").join(weather, keys, "left").orderBy("timestamp_30min")


def freshness(sources: Mapping[str, DataFrame], time: str) -> DataFrame:
    """Latest time and row count per source."""
    out = None
    for name, frame in sources.items():
        row = frame.agg(F.max(time).alias("latest"), F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("source"), "latest", "rows"
        )
        out = row if out is None else out.unionByName(row)
    return out


def snapshot_summary(fact: DataFrame, time: str) -> DataFrame:
    """Latest time, snapshots, rows at the latest one, all rows.

    Counts per time first, so the table is read once.
    """
    per_time = fact.groupBy(time).agg(F.count(F.lit(1)).alias("n"))
    return per_time.agg(
        F.max(time).alias("latest"), F.count(F.lit(1)).alias("snapshots"),
        F.max_by("n", time).alias("rows_at_latest"), F.sum("n").alias("rows"),
    )


def city_series(fact: DataFrame, time: str, measure: str) -> DataFrame:
    return fact.groupBy(time).agg(F.sum(measure).alias("total"))


def dashboard_kpis(taxi: DataFrame, rain: DataFrame, time: str) -> DataFrame:
    """City total, areas and raining areas at the latest snapshot of each."""
    taxi_now = at_or_latest(taxi, F.col(time), None)
    rain_now = at_or_latest(rain, F.col(time), None)
    raining = rain_now.agg(F.count_distinct(F.when(F.col("rainfall_mm") > 60, F.col("area_id"))).alias("r")).scalar()
    return taxi_now.agg(
        F.sum("taxi_count").alias("total_taxis"), F.count_distinct("area_id").alias("areas")
    ).withColumn("raining_areas", raining)
