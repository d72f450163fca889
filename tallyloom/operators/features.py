"""Feature preparation: splits, scaling, encoding, selection, lags."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.plans import timejoin
from tallyloom.plans.nullsafe import join_on
from tallyloom.plans.ordering import exact_quantiles, row_numbers


def lag_demand(df: DataFrame, keys: Sequence[str], time: str, spans: Mapping[str, int]) -> DataFrame:
    """Rows of the key in the last spans, and in the same hour one day before."""
    longest = max(spans.values())
    rows = timejoin.trailing_window(
        df, keys, time, longest,
        lambda frame: {name: F.count(F.lit(1)).over(frame(s)) for name, s in spans.items()},
    ).withColumn("__hour", F.floor(timejoin.micros(time) / F.lit(3_600_000_000)).cast("long"))
    hourly = df.groupBy(
        *keys, (F.floor(timejoin.micros(time) / F.lit(3_600_000_000)).cast("long") + 24).alias("__hour")
    ).agg(F.count(F.lit(1)).alias("same_hour_yesterday"))
    return (
        rows.join(hourly, [*keys, "__hour"], "left")
        .na.fill(0, ["same_hour_yesterday"])
        .drop("__hour")
    )


def stratified_split(
    df: DataFrame, label: str, order: Column, tie: str, shares: Mapping[str, float], out: str = "part"
) -> DataFrame:
    """Exact split per label value: the first floor(share * n) rows of the label
    in the given order go to the first part, and so on; the last takes the rest.

    ``order`` should scatter the rows, such as a hash of the key with a seed.
    """
    numbered = row_numbers(
        df.withColumn("__o", order), "__o", tie, [label], out="__rn", with_total="__n"
    )
    part, edge, names = None, F.lit(0.0), list(shares)
    for name in names[:-1]:
        edge = edge + F.lit(shares[name])
        inside = F.col("__rn") <= F.floor(edge * F.col("__n") + F.lit(1e-9))
        part = F.when(inside, name) if part is None else part.when(inside, name)
    return numbered.withColumn(out, part.otherwise(names[-1])).drop("__o", "__rn", "__n")


def fold_ids(df: DataFrame, label: str, order: Column, tie: str, folds: int, out: str = "fold") -> DataFrame:
    """Stratified fold number 0..folds-1, dealt round robin per label."""
    numbered = row_numbers(df.withColumn("__o", order), "__o", tie, [label], out="__rn")
    return numbered.withColumn(out, ((F.col("__rn") - 1) % folds).cast("int")).drop("__o", "__rn")


def seeded_order(key: str, seed: int) -> Column:
    """Reproducible scatter of a key, as an exact double."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 52)).cast("double")


def fit_imputer(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """One row: exact medians and smallest most frequent values of ``train``."""
    row = None
    for name in numeric:
        found = exact_quantiles(train, name, {f"fill_{name}": 0.5})
        row = found if row is None else row.withColumn(f"fill_{name}", found.scalar())
    for name in categorical:
        counts = train.filter(F.col(name).isNotNull()).groupBy(name).agg(F.count(F.lit(1)).alias("n"))
        top = counts.agg(F.min_by(name, F.struct(-F.col("n"), F.col(name))).alias(f"fill_{name}"))
        row = top if row is None else row.withColumn(f"fill_{name}", top.scalar())
    return row


def apply_imputer(df: DataFrame, fitted: DataFrame) -> DataFrame:
    """Fill nulls from the one-row result of ``fit_imputer``."""
    names = [c.removeprefix("fill_") for c in fitted.columns]
    return df.withColumns(
        {n: F.coalesce(F.col(n), fitted.select(f"fill_{n}").scalar()) for n in names}
    )


def scale(df: DataFrame, train: DataFrame, column: str, method: str) -> Column:
    """Scaled column with statistics of ``train``: standard (population
    deviation), minmax or robust (median and quartile range)."""
    if method == "standard":
        stats = train.agg(F.struct(F.avg(column).alias("shift"), F.stddev_pop(column).alias("width")).alias("s"))
    elif method == "minmax":
        stats = train.agg(
            F.struct(F.min(column).alias("shift"), (F.max(column) - F.min(column)).alias("width")).alias("s")
        )
    elif method == "robust":
        q = exact_quantiles(train, column, {"q1": 0.25, "q2": 0.5, "q3": 0.75})
        stats = q.select(F.struct(F.col("q2").alias("shift"), (F.col("q3") - F.col("q1")).alias("width")).alias("s"))
    else:
        raise ValueError(f"unknown scaling {method!r}")
    fitted = stats.scalar()
    width = fitted["width"]
    return (F.col(column) - fitted["shift"]) / F.when(width == 0, F.lit(1.0)).otherwise(width)


def one_hot(df: DataFrame, column: str, categories: Sequence[str]) -> DataFrame:
    """0/1 column per known category; an unknown or missing value is all zero."""
    return df.withColumns(
        {f"{column}_{c}": F.coalesce((F.col(column) == F.lit(c)).cast("int"), F.lit(0)) for c in categories}
    )


def label_codes(df: DataFrame, column: str, out: str) -> DataFrame:
    """Codes from 0 in alphabetical order of the values."""
    from tallyloom.plans.ordering import surrogate_keys

    codes = surrogate_keys(df, column, "__code")
    return df.join(codes, column, "left").withColumn(out, (F.col("__code") - 1).cast("double")).drop("__code")


def ordinal(column: Column, levels: Sequence[str]) -> Column:
    """Position of the value in ``levels``, null when it is not there."""
    position = F.array_position(F.array(*[F.lit(v) for v in levels]), column)
    return F.when(position > 0, (position - 1).cast("double"))


def chi_square_scores(df: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Chi-square of non-negative feature sums per class against the sums
    expected from the class shares. One aggregation, then k x features rows."""
    sums = df.groupBy(label).agg(
        F.count(F.lit(1)).cast("double").alias("__n"), *[F.sum(F.col(f).cast("double")).alias(f) for f in features]
    )
    long = sums.unpivot([label, "__n"], list(features), "feature", "observed")
    total_n = sums.select(F.sum("__n")).scalar()
    whole = Window.partitionBy("feature")
    expected = F.sum("observed").over(whole) * F.col("__n") / total_n
    return (
        long.withColumn("__e", expected)
        .groupBy("feature")
        .agg(F.sum(F.try_divide((F.col("observed") - F.col("__e")) ** 2, F.col("__e"))).alias("chi2"))
    )


def select_top_percent(scores: DataFrame, percent: float) -> DataFrame:
    """Best share of features by score; ties by name. One row per feature."""
    place = F.row_number().over(Window.orderBy(F.col("chi2").desc_nulls_last(), "feature"))
    keep = F.floor(scores.select(F.count(F.lit(1))).scalar() * F.lit(percent / 100.0))
    return scores.withColumn("__p", place).filter(F.col("__p") <= keep).drop("__p")


def redundant_features(correlations: DataFrame, limit: float) -> DataFrame:
    """Second feature of each pair whose absolute correlation passes ``limit``."""
    return (
        correlations.filter(F.abs("r") > F.lit(limit))
        .groupBy(F.col("b").alias("feature"))
        .agg(F.max(F.abs("r")).alias("strongest"))
    )


def winsorize(df: DataFrame, column: str, upper: float, out: str) -> DataFrame:
    """Cut values above the exact upper percentile down to it."""
    cap = exact_quantiles(df, column, {"cap": upper}).scalar()
    return df.withColumn(out, F.least(F.col(column), cap))


def add_noise(df: DataFrame, columns: Sequence[str], level: float, seed: int, key: str) -> DataFrame:
    """Gaussian noise of ``level`` deviations, drawn from the row key.

    Two hashed uniforms give a normal draw, so a retried task repeats it.
    """
    changed = {}
    spread = df.agg(F.struct(*[F.stddev_pop(c).alias(c) for c in columns]).alias("s")).scalar()  # one scan for all columns
    for i, name in enumerate(columns):
        u1, u2 = (
            (F.pmod(F.xxhash64(F.col(key), F.lit(seed), F.lit(i), F.lit(j)), F.lit(1 << 40)) + 0.5) / float(1 << 40)
            for j in (0, 1)
        )
        normal = F.sqrt(-2 * F.log(u1)) * F.cos(F.lit(2 * 3.141592653589793) * u2)
        changed[name] = F.col(name) + normal * spread[name] * F.lit(level)
    return df.withColumns(changed)


def class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weight n / (k * n_class) for every row."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__c"))
    total = counts.select((F.sum("__c") / F.count(F.lit(1))).alias("t")).scalar()
    weights = counts.select(label, (total / F.col("__c")).alias(out))
    return join_on(df, weights, [label])


def decay_weight(age_days: Column, half_life_days: float) -> Column:
    """Weight that halves with every half-life of age."""
    return F.exp(-F.log(F.lit(2.0)) * age_days / F.lit(float(half_life_days)))


def target_encode(df: DataFrame, column: str, target: str, fold: str, smoothing: float, out: str) -> DataFrame:
    """Category mean of the target over the other folds, drawn to their mean.

    Sums per (category, fold) are small; the other folds follow by subtraction.
    """
    cell = df.groupBy(column, fold).agg(
        F.sum(target).alias("__s"), F.count(F.lit(1)).alias("__c")
    )
    per_category = cell.groupBy(column).agg(F.sum("__s").alias("__cs"), F.sum("__c").alias("__cc"))
    per_fold = cell.groupBy(fold).agg(F.sum("__s").alias("__fs"), F.sum("__c").alias("__fc"))
    every = cell.agg(F.struct(F.sum("__s").alias("s"), F.sum("__c").alias("c")).alias("a")).scalar()
    rest = (
        join_on(join_on(cell, per_category, [column]), per_fold, [fold])
        .withColumn("__prior", F.try_divide(every["s"] - F.col("__fs"), every["c"] - F.col("__fc")))
        .withColumn("__s1", F.col("__cs") - F.col("__s"))
        .withColumn("__c1", F.col("__cc") - F.col("__c"))
    )
    encoded = rest.select(
        column, fold,
        ((F.col("__s1") + F.lit(smoothing) * F.col("__prior")) / (F.col("__c1") + F.lit(smoothing))).alias(out),
    )
    return join_on(df, encoded, [column, fold])


def fit_categories(train: DataFrame, column: str, limit: int = 1_000) -> list[str]:
    """Sorted categories of the training rows; more than ``limit`` is an error,
    since each becomes a column."""
    rows = train.select(column).filter(F.col(column).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{column} has more than {limit} categories")
    return sorted(r[0] for r in rows)


def bin_class(column: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first edge that is not below the value, else the last."""
    out = F.lit(labels[-1])
    for edge, name in reversed(list(zip(edges, labels))):
        out = F.when(column <= F.lit(edge), F.lit(name)).otherwise(out)
    return out
