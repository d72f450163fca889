"""Feature store access, drift, calibration, fairness and triggers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.aggregates import value_counts
from tallyloom.plans.ordering import exact_quantiles
from tallyloom.plans.timejoin import micros, point_in_time_join


@dataclass(frozen=True)
class FeatureView:
    """Named features of an entity, as SQL expressions over one source."""

    name: str
    entity: str
    event_time: str
    features: Mapping[str, str] = field(default_factory=dict)

    def select(self, source: DataFrame) -> DataFrame:
        return source.select(self.entity, self.event_time, *[F.expr(e).alias(n) for n, e in self.features.items()])


@dataclass(frozen=True)
class FeatureService:
    """A fixed list and order of features that a model reads from a view."""

    name: str
    view: FeatureView
    features: Sequence[str]

    def historical(self, entities: DataFrame, source: DataFrame, at: str, ttl_seconds: int | None = None) -> DataFrame:
        """Feature values as they were known at each entity row's time."""
        return point_in_time_join(
            entities, self.view.select(source), [self.view.entity], at, self.view.event_time,
            list(self.features), ttl_seconds=ttl_seconds,
        )

    def materialise(self, source: DataFrame) -> DataFrame:
        """Newest values per entity; combines before the shuffle."""
        view = self.view
        newest = F.max_by(F.struct(view.event_time, *self.features), view.event_time).alias("__n")
        rows = view.select(source).groupBy(view.entity).agg(newest)
        return rows.select(view.entity, *[F.col("__n")[c].alias(c) for c in (view.event_time, *self.features)])

    def online(self, requests: DataFrame, store: DataFrame) -> DataFrame:
        """Look up entities in the online table, columns in service order."""
        entity = self.view.entity
        return requests.join(store.select(entity, *self.features), entity, "left").select(
            *requests.columns, *self.features
        )


def skew_check(offline: DataFrame, online: DataFrame, entity: str, features: Sequence[str], tolerance: float) -> DataFrame:
    """Entities whose offline and online values differ, per feature."""
    both = offline.alias("a").join(online.alias("b"), F.col(f"a.{entity}") == F.col(f"b.{entity}"), "full")
    counts = []
    for name in features:
        a, b = F.col(f"a.{name}").cast("double"), F.col(f"b.{name}").cast("double")
        differs = F.when(a.isNull() & b.isNull(), False).otherwise(
            F.coalesce(F.abs(a - b) > F.lit(tolerance), F.lit(True))
        )
        counts.append(F.count_if(differs).alias(name))
    wide = both.agg(F.count(F.lit(1)).alias("entities"), *counts)
    return wide.unpivot(["entities"], list(features), "feature", "mismatches")


def feature_freshness(df: DataFrame, time: str, features: Sequence[str], now) -> DataFrame:
    """Age of the newest row and null rate per feature."""
    wide = df.agg(
        F.max(time).alias("latest"),
        *[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in features],
    )
    age = (micros(F.lit(now).cast("timestamp_ntz")) - micros("latest")) / F.lit(60e6)
    return wide.withColumn("age_minutes", age).unpivot(["latest", "age_minutes"], list(features), "feature", "null_rate")


def numeric_drift(reference: DataFrame, current: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """PSI, KL, JS, binned Wasserstein distance and mean shift in deviations.

    Bin edges are exact quantiles of the reference; each part is then reduced
    to one count per bin, and everything else runs on those few rows.
    """
    names = {f"e{i}": i / bins for i in range(bins + 1)}
    edges = exact_quantiles(reference, column, names).select(F.array(*names).alias("e")).scalar()
    inner = F.slice("__edges", 2, bins - 1)
    value = F.col(column).cast("double")
    bin_no = F.aggregate(inner, F.lit(0), lambda n, e: n + F.when(value > e, 1).otherwise(0))

    def shares(df: DataFrame, name: str) -> DataFrame:
        known = df.filter(F.col(column).isNotNull()).withColumn("__edges", edges)
        return known.groupBy(bin_no.alias("bin")).agg(F.count(F.lit(1)).alias(name))

    spark = reference.sparkSession
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    joined = grid.join(shares(reference, "r"), "bin", "left").join(shares(current, "c"), "bin", "left").na.fill(0)
    whole = Window.partitionBy()
    upto = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # ``bins`` rows
    stats = joined.select(
        "bin",
        F.greatest(F.col("r") / F.sum("r").over(whole), F.lit(1e-6)).alias("r"),
        F.greatest(F.col("c") / F.sum("c").over(whole), F.lit(1e-6)).alias("c"),
        (F.sum("r").over(upto) / F.sum("r").over(whole)).alias("fr"),
        (F.sum("c").over(upto) / F.sum("c").over(whole)).alias("fc"),
    ).withColumn("m", (F.col("r") + F.col("c")) / 2)
    r, c, m = F.col("r"), F.col("c"), F.col("m")
    width = F.get(edges, F.col("bin") + 1) - F.get(edges, F.col("bin"))
    moments = reference.agg(F.struct(F.avg(column).alias("mean"), F.stddev_samp(column).alias("sd")).alias("s")).scalar()
    mean_now = current.agg(F.avg(column).alias("m")).scalar()
    measures = stats.agg(
        F.sum((c - r) * F.log(c / r)).alias("psi"),
        F.sum(c * F.log(c / r)).alias("kl"),
        F.sum((c * F.log(c / m) + r * F.log(r / m)) / 2).alias("js"),
        F.sum(F.abs(F.col("fc") - F.col("fr")) * width).alias("wasserstein"),
    )
    return measures.withColumn("z", (mean_now - moments["mean"]) / F.nullif(moments["sd"], F.lit(0.0)))


def category_shift(reference: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """Shares per category before and after; a new category has share 0 before."""
    before = value_counts(reference, column).select(column, F.col("share").alias("reference_share"))
    after = value_counts(current, column).select(column, F.col("share").alias("current_share"))
    joined = before.join(after, column, "full")
    status = F.when(F.col("reference_share").isNull(), "new").when(F.col("current_share").isNull(), "gone").otherwise("kept")
    return joined.withColumn("status", status).na.fill(0.0).withColumn(
        "shift", F.col("current_share") - F.col("reference_share")
    )


def prediction_drift(df: DataFrame, keys: Sequence[Column], score: str, high: float) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean"), F.var_samp(score).alias("variance"),
        F.avg(F.when(F.col(score) >= F.lit(high), 1.0).otherwise(0.0)).alias("high_share"),
    )


def performance_slices(df: DataFrame, slices: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """Error measures overall and by each slice key alone, in one aggregation."""
    y, p = F.col(actual), F.col(predicted)
    error = p - y
    sets = [[], *[[F.col(s)] for s in slices]]
    return df.groupingSets(sets, *[F.col(s) for s in slices]).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.when(y != 0, F.abs(error / F.nullif(y, F.lit(0.0))))).alias("mape"),
        F.try_divide(F.sum(F.abs(error)), F.sum(F.abs(y))).alias("wape"),
        (F.avg(p) - F.avg(y)).alias("bias"),
        F.avg(F.when(error < 0, 1.0).otherwise(0.0)).alias("under_rate"),
        F.avg(F.when(error > 0, 1.0).otherwise(0.0)).alias("over_rate"),
    )


def calibration_table(df: DataFrame, score: str, label: str, bands: int = 10) -> DataFrame:
    """Mean score against observed rate per equal score band."""
    band = F.least(F.floor(F.col(score) * bands), F.lit(bands - 1)).cast("long")
    return df.groupBy(band.alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(score).alias("mean_score"), F.avg(F.col(label).cast("double")).alias("rate")
    )


def probability_scores(df: DataFrame, score: str, label: str) -> DataFrame:
    """Brier score and log loss."""
    p = F.greatest(F.least(F.col(score), F.lit(1 - 1e-15)), F.lit(1e-15))
    y = F.col(label).cast("double")
    return df.agg(
        F.avg((F.col(score) - y) ** 2).alias("brier"),
        F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"),
    )


def fairness(df: DataFrame, group: str, approved: Column, label: str) -> DataFrame:
    """Approval, error rates and gaps to the best or lowest group."""
    y = F.col(label) == 1
    rates = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.when(approved, 1.0).otherwise(0.0)).alias("approval_rate"),
        F.avg(F.when(~y, F.when(approved, 1.0).otherwise(0.0))).alias("fpr"),
        F.avg(F.when(y, F.when(approved, 0.0).otherwise(1.0))).alias("fnr"),
    )
    best = rates.agg(
        F.struct(F.max("approval_rate").alias("a"), F.min("fpr").alias("p"), F.min("fnr").alias("n")).alias("s")
    ).scalar()
    return rates.select(
        "*",
        F.try_divide(F.col("approval_rate"), best["a"]).alias("impact_ratio"),
        (F.col("fpr") - best["p"]).alias("fpr_gap"),
        (F.col("fnr") - best["n"]).alias("fnr_gap"),
    )


def retrain_runs(hourly: DataFrame, hour: str, mae: str, window: int, limit: float, least: int) -> DataFrame:
    """Runs of at least ``least`` hours whose rolling MAE is over the limit.

    Works on one row per hour; the time span bounds its size.
    """
    recent = Window.orderBy(hour).rowsBetween(-(window - 1), 0)
    order = Window.orderBy(hour)
    flagged = hourly.withColumn("__over", F.avg(mae).over(recent) > F.lit(limit))
    grouped = flagged.withColumn(
        "__run", F.row_number().over(order) - F.sum(F.col("__over").cast("int")).over(order)
    )
    return (
        grouped.filter("__over")
        .groupBy("__run")
        .agg(F.min(hour).alias("start"), F.max(hour).alias("end"), F.count(F.lit(1)).alias("hours"))
        .filter(F.col("hours") >= F.lit(least))
        .drop("__run")
    )


def canary_split(key: str, percent: int, seed: int = 0) -> Column:
    """Candidate for a stable share of keys, champion for the rest."""
    return F.when(F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(100)) < percent, "candidate").otherwise("champion")


def compare_models(df: DataFrame, actual: str, predictions: Mapping[str, str], keys: Sequence[str] = ()) -> DataFrame:
    """MAE of several models on the same rows, and the best of them."""
    maes = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.abs(F.col(c) - F.col(actual))).alias(m) for m, c in predictions.items()],
    )
    best = reduce(
        lambda a, b: F.least(a, b), [F.struct(F.col(m).alias("v"), F.lit(m).alias("m")) for m in predictions]
    ) if len(predictions) > 1 else F.struct(F.lit(0.0).alias("v"), F.lit(next(iter(predictions))).alias("m"))
    return maes.withColumn("best", best["m"])


def best_runs(runs: DataFrame, keys: Sequence[str], metric: str, run_id: str) -> DataFrame:
    """Per data and feature version: runs, mean metric and the best run."""
    return runs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("runs"), F.avg(metric).alias("mean_metric"),
        F.min(metric).alias("best_metric"), F.min_by(run_id, F.struct(metric, run_id)).alias("best_run"),
    )


def stale_fallback(df: DataFrame, prediction: str, age: Column, limit: float, baseline: str) -> DataFrame:
    """Baseline instead of a missing or stale-featured prediction, marked."""
    degraded = F.col(prediction).isNull() | F.coalesce(age > F.lit(limit), F.lit(True))
    return df.withColumns({
        "served": F.when(degraded, F.col(baseline)).otherwise(F.col(prediction)), "degraded": degraded,
    })


def group_baseline(history: DataFrame, rows: DataFrame, levels: Sequence[Sequence[str]], target: str, out: str) -> DataFrame:
    """Historical mean by the first level that has data, then the overall mean."""
    joined, found = rows, []
    for i, keys in enumerate(levels):
        means = history.groupBy(*keys).agg(F.avg(target).alias(f"__b{i}"))
        joined = joined.join(means, list(keys), "left")
        found.append(F.col(f"__b{i}"))
    overall = history.agg(F.avg(target).alias("m")).scalar()
    return joined.withColumn(out, F.coalesce(*found, overall)).drop(*[f"__b{i}" for i in range(len(levels))])
