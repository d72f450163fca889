"""Profiles, quality checks, imputation and rejects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.plans.nullsafe import join_on
from tallyloom.plans.literals import literal_table
from tallyloom.operators.aggregates import value_counts
from tallyloom.plans.ordering import exact_quantiles


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def blank_to_null(column: str | Column) -> Column:
    """Text of nothing but white space becomes null; other text is unchanged."""
    col = F.col(column) if isinstance(column, str) else column
    return F.when(~col.rlike(r"^\s*$"), col)


def normalise_nulls(df: DataFrame, sentinels: Mapping[str, Sequence] | None = None) -> DataFrame:
    """NaN, blank text and per-column sentinel values become null."""
    changed: dict[str, Column] = {}
    for name in text_columns(df):
        changed[name] = blank_to_null(name)
    for name in float_columns(df):
        changed[name] = F.when(~F.isnan(name), F.col(name))
    for name, values in (sentinels or {}).items():
        base = changed.get(name, F.col(name))
        changed[name] = F.when(~F.col(name).isin(list(values)), base)
    return df.withColumns(changed)


def profile_columns(df: DataFrame, exact: bool = True) -> DataFrame:
    """One row per column: distinct values with null, nulls, blanks, missing.

    One aggregation over all columns, then an unfold of its single row. Exact
    distinct counts shuffle every value once per column; for very large tables
    ``exact=False`` counts them with HyperLogLog in a single narrow pass.
    """
    texts = set(text_columns(df))
    measures = [F.count(F.lit(1)).alias("__n")]
    entries = []
    for i, name in enumerate(df.columns):
        col = F.col(name)
        is_blank = col.rlike(r"^\s*$") if name in texts else F.lit(False)
        distinct = F.count_distinct(col) if exact else F.approx_count_distinct(col)
        measures += [
            distinct.alias(f"d{i}"),
            F.count_if(col.isNull()).alias(f"z{i}"),
            F.count_if(is_blank).alias(f"b{i}"),
        ]
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                F.col("__n").alias("rows"),
                (F.col(f"d{i}") + F.when(F.col(f"z{i}") > 0, 1).otherwise(0)).alias("distinct_values"),
                F.col(f"z{i}").alias("null_count"),
                F.col(f"b{i}").alias("blank_count"),
                (F.col(f"z{i}") + F.col(f"b{i}")).alias("missing_count"),
                (100.0 * F.try_divide(F.col(f"z{i}"), F.col("__n"))).alias("null_percent"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*entries)))


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key; null keys equal each other."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def quality_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row count, duplicate keys and nulls per column, as one table."""
    nulls = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns]
    )
    names = ["rows", "duplicate_rows", *[f"null_{c}" for c in df.columns]]
    wide = nulls.withColumn("duplicate_rows", duplicate_rows(df, keys).scalar())
    return wide.unpivot([], names, "check", "value")


def with_group_median(df: DataFrame, keys: Sequence[str], column: str, out: str) -> DataFrame:
    """Attach each group's exact median to its rows."""
    medians = exact_quantiles(df, column, {out: 0.5}, keys)
    return df.join(medians, list(keys), "left")


def impute_group_median(df: DataFrame, keys: Sequence[str], column: str, flag: str) -> DataFrame:
    """Fill with the group median, then the global one, and flag filled rows."""
    overall = exact_quantiles(df, column, {"__all": 0.5}).scalar()
    filled = with_group_median(df, keys, column, "__group")
    return filled.select(
        *[c for c in df.columns if c != column],
        F.coalesce(F.col(column), F.col("__group"), overall).alias(column),
        F.col(column).isNull().cast("int").alias(flag),
    )


def impute_constants(df: DataFrame, constants: Mapping[str, object], means: Sequence[str] = ()) -> DataFrame:
    """Fill with given constants, or with the column mean."""
    changed = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in constants.items()}
    for name in means:
        changed[name] = F.coalesce(F.col(name), df.select(F.avg(name)).scalar())
    return df.withColumns(changed)


def split_rejects(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the reason of the first broken rule, null for a good row."""
    reason = F.lit(None).cast("string")
    for name, ok in reversed(list(rules.items())):
        reason = F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)).otherwise(reason)
    return df.withColumn("reject_reason", reason)


def outlier_counts(df: DataFrame, keys: Sequence[str], column: str, width: float) -> DataFrame:
    """Rows outside mean +- ``width`` sample deviations of their group."""
    stats = df.groupBy(*keys).agg(F.avg(column).alias("__m"), F.stddev_samp(column).alias("__s"))
    return (
        join_on(df, stats, list(keys))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.abs(F.col(column) - F.col("__m")) > F.lit(width) * F.col("__s")).alias("outliers"),
        )
    )


def column_roles(profile: DataFrame, high_cardinality: int = 50) -> DataFrame:
    """Identifier, constant, high-cardinality or ordinary, from a profile."""
    ratio = F.try_divide(F.col("distinct_values"), F.col("rows"))
    role = (
        F.when(F.col("distinct_values") <= 1, "constant")
        .when(ratio == 1.0, "identifier")
        .when(F.col("distinct_values") > high_cardinality, "high_cardinality")
        .otherwise("ordinary")
    )
    return profile.select("column", ratio.alias("unique_ratio"), role.alias("role"))


def duplicate_impact(df: DataFrame, deduped: DataFrame, label: str) -> DataFrame:
    """Class shares before and after deduplication and their difference."""
    before = value_counts(df, label).select(label, F.col("n").alias("n_before"), F.col("share").alias("before"))
    after = value_counts(deduped, label).select(label, F.col("n").alias("n_after"), F.col("share").alias("after"))
    joined = before.join(after, label, "full").na.fill(0)
    return joined.withColumn("difference", F.abs(F.col("before") - F.col("after")))


def key_alignment(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Row counts of two tables and keys that only one of them has."""
    l, r = left.select(key).distinct(), right.select(key).distinct()
    both = l.withColumn("__l", F.lit(1)).join(r.withColumn("__r", F.lit(1)), key, "full")
    return both.agg(
        F.count_if(F.col("__l").isNotNull() & F.col("__r").isNotNull()).alias("matched"),
        F.count_if(F.col("__r").isNull()).alias("left_only"),
        F.count_if(F.col("__l").isNull()).alias("right_only"),
    )


def schema_differences(df: DataFrame, declared: T.StructType, renames: Mapping[str, str] | None = None) -> DataFrame:
    """Declared against actual fields: missing, renamed, retyped, unexpected.

    ``renames`` maps a known old name to its declared name.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    wanted = {f.name: f.dataType.simpleString() for f in declared.fields}
    old_names = {new: old for old, new in (renames or {}).items() if old in actual}
    rows = []
    for name, kind in wanted.items():
        if name in actual:
            status = "ok" if actual[name] == kind else "retyped"
            rows.append((name, status, kind, actual[name]))
        elif name in old_names:
            rows.append((name, "renamed", kind, old_names[name]))
        else:
            rows.append((name, "missing", kind, None))
    known = set(wanted) | set(old_names.values())
    rows += [(n, "unexpected", None, k) for n, k in actual.items() if n not in known]
    return literal_table(df.sparkSession, rows, "field string, status string, declared string, actual string")


def match_rate(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Share of left rows whose key occurs on the right."""
    keys = right.select(key).distinct().withColumn("__hit", F.lit(1))
    return left.join(keys, key, "left").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("__hit").alias("matched"),
        F.try_divide(F.count("__hit"), F.count(F.lit(1))).alias("match_rate"),
    )


def volume_drop(df: DataFrame, bucket: Column, history: int, limit: float) -> DataFrame:
    """Row count per time bucket, z-score against the buckets before it.

    The window runs over bucket counts, whose number the time span bounds.
    """
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    prior = Window.orderBy("bucket").rowsBetween(-history, -1)
    mean, sd = F.avg("n").over(prior), F.stddev_samp("n").over(prior)
    scored = counts.withColumn("z", F.try_divide(F.col("n") - mean, F.when(sd > 0, sd)))
    return scored.withColumn("dropped", F.coalesce(F.col("z") < F.lit(-limit), F.lit(False)))
