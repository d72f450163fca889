"""Global and per-group order without one-task windows.

A window without partition keys moves the whole table into one task, and a
window over a hot key moves that key's rows into one task. The functions here
cut the order into *cells*: ranges of the order column whose bounds come from
an approximate quantile sketch. Bounds are plain literals in the plan, so a
retried task always recomputes the same cell, and any bounds give the right
result; they only decide how even the cells are. Work inside a cell is an
ordinary window, and the prefix over cells is a table with at most one row per
(group, cell).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.plans.literals import literal_table
from tallyloom.plans.nullsafe import join_on
from tallyloom.plans.scratch import checkpointed, materialised

CELL = "__cell"
_QUANTILE_CELLS = 256


def default_cells(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _splits(bounds: Sequence[float], isolate: Sequence[float] = ()) -> list[float]:
    points = {float(b) for b in bounds if math.isfinite(b)}
    points |= {math.nextafter(float(v), math.inf) for v in isolate}
    return [-math.inf, *(sorted(points) or [0.0]), math.inf]


def _bucket(df: DataFrame, column: str, out: str, splits: list[float]) -> DataFrame:
    """Cell of each value; NaN has the cell after the last one, null the one after that."""
    celled = Bucketizer(
        splits=splits, inputCol=column, outputCol=out, handleInvalid="keep"
    ).transform(df)
    return celled.withColumn(out, F.coalesce(out, F.lit(float(len(splits)))))


def with_cells(
    df: DataFrame, order: str, tie: str | None = None, cells: int | None = None
) -> DataFrame:
    """Add the cell number of ``order`` (numeric); cells rise with the order.

    An order value that fills several quantiles gets a cell of its own; that
    cell, and those of null and NaN, are cut again along ``tie``.
    """
    parts = cells or default_cells(df.sparkSession)
    probabilities = [i / parts for i in range(1, parts)]
    names = [order] if tie is None else [order, tie]
    found = df.approxQuantile(names, probabilities, 1.0 / (4 * parts))
    bounds = found[0]
    hot = sorted({b for b in bounds if bounds.count(b) > 1})
    celled = _bucket(df, order, "__b", _splits(bounds, hot))
    if tie is None:
        return celled.withColumn(CELL, F.col("__b").cast("long")).drop("__b")
    ties = _splits(found[1])
    celled = _bucket(celled, tie, "__s", ties)
    value = F.col(order).cast("double")
    crowded = value.isin(hot) | value.isNull() | F.isnan(value)
    inner = F.when(crowded, F.col("__s").cast("long")).otherwise(0)
    return celled.withColumn(
        CELL, F.col("__b").cast("long") * F.lit(len(ties) + 1) + inner
    ).drop("__b", "__s")


def _prefix(
    celled: DataFrame, sums: Mapping[str, Column], keys: Sequence[str], totals: bool, keep: bool = False
) -> DataFrame:
    per_cell = celled.groupBy(*keys, CELL).agg(*[c.alias(f"__a_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*keys).orderBy(CELL).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*keys).orderBy(CELL).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    picked = [
        F.coalesce(F.sum(f"__a_{n}").over(before), F.lit(0)).alias(f"__before_{n}") for n in sums
    ]
    if totals:
        picked += [F.sum(f"__a_{n}").over(everything).alias(f"total_{n}") for n in sums]
    own = [f"__a_{n}" for n in sums] if keep else []
    return per_cell.select(*keys, CELL, *own, *picked)


def row_numbers(
    df: DataFrame,
    order: str,
    tie: str,
    keys: Sequence[str] = (),
    out: str = "rn",
    with_total: str | None = None,
    cells: int | None = None,
) -> DataFrame:
    """Exact row_number by (``order``, ``tie``), whole table or per group."""
    celled = with_cells(df, order, tie, cells)
    prefix = _prefix(celled, {"n": F.count(F.lit(1))}, keys, with_total is not None)
    local = Window.partitionBy(*keys, CELL).orderBy(
        F.col(order).asc_nulls_last(), F.col(tie).asc_nulls_last()
    )
    numbered = join_on(celled.withColumn("__in_cell", F.row_number().over(local)), prefix, [*keys, CELL])
    result = numbered.withColumn(out, (F.col("__in_cell") + F.col("__before_n")).cast("long"))
    if with_total is not None:
        result = result.withColumn(with_total, F.col("total_n").cast("long")).drop("total_n")
    return result.drop("__in_cell", "__before_n", CELL)


def running_sums(
    df: DataFrame,
    order: str,
    sums: Mapping[str, str],
    keys: Sequence[str] = (),
    totals: bool = False,
    cells: int | None = None,
) -> DataFrame:
    """Running sums over rows that are already unique per (keys, ``order``).

    ``sums`` maps an output column to the summed column; ``totals`` adds
    ``total_<output>`` columns. Pre-aggregate by the order value first, so a
    hot value is one row here.
    """
    celled = with_cells(df, order, None, cells)
    prefix = _prefix(celled, {o: F.sum(c) for o, c in sums.items()}, keys, totals)
    local = (
        Window.partitionBy(*keys, CELL)
        .orderBy(F.col(order).asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = celled.select("*", *[F.sum(c).over(local).alias(f"__in_{o}") for o, c in sums.items()])
    stepped = join_on(inside, prefix, [*keys, CELL])
    for name in sums:
        stepped = stepped.withColumn(name, F.col(f"__in_{name}") + F.col(f"__before_{name}"))
    return stepped.drop(CELL, *[f"__in_{o}" for o in sums], *[f"__before_{o}" for o in sums])


def exact_quantiles(
    df: DataFrame,
    column: str,
    probabilities: Mapping[str, float],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Exact interpolated quantiles per group.

    The built-in exact percentile keeps every distinct value of a group in one
    task. Here rows are only counted per (group, cell) first, which combines
    before the shuffle; the counts tell which few cells hold the wanted
    positions, and only the values of those cells are shuffled and ordered.
    """
    values = df.select(*keys, F.col(column).cast("double").alias("__v")).filter(F.col("__v").isNotNull())
    celled = with_cells(values, "__v", None, max(_QUANTILE_CELLS, default_cells(df.sparkSession)))
    prefix = _prefix(celled, {"n": F.count(F.lit(1))}, keys, True, keep=True)
    exact = [(F.col("total_n") - 1) * F.lit(float(p)) for p in probabilities.values()]
    located = prefix.withColumns({
        "__pos": F.array(*[side(e).cast("long") for e in exact for side in (F.floor, F.ceil)]),
        "__share": F.array(*[e - F.floor(e) for e in exact]),
    })
    # One condition over an array: many alternatives over aliased columns
    # would make the optimizer infer a constraint for each combination.
    holds = F.exists("__pos", lambda p: (p >= F.col("__before_n")) & (p < F.col("__before_n") + F.col("__a_n")))
    targets = _small(located.filter(holds).select(*keys, CELL, "__before_n", "__pos", "__share"), keys)
    wanted = join_on(celled, targets.select(*keys, CELL), [*keys, CELL], "left_semi")
    counts = join_on(wanted.groupBy(*keys, CELL, "__v").agg(F.count(F.lit(1)).alias("__n")), targets, [*keys, CELL])
    upto = Window.partitionBy(*keys, CELL).orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stepped = counts.withColumn("__to", F.col("__before_n") + F.sum("__n").over(upto))
    at = [
        F.max(F.when((F.col("__pos")[i] >= F.col("__to") - F.col("__n")) & (F.col("__pos")[i] < F.col("__to")), F.col("__v"))).alias(f"__q{i}")
        for i in range(2 * len(probabilities))
    ]
    found = stepped.groupBy(*keys).agg(*at, F.first("__share").alias("__share"))
    low, high = ([F.col(f"__q{2 * i + side}") for i in range(len(probabilities))] for side in (0, 1))
    return found.select(
        *keys,
        *[(low[i] + (high[i] - low[i]) * F.col("__share")[i]).alias(name) for i, name in enumerate(probabilities)],
    )


def _small(targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target cells as a table of known size.

    Spark broadcasts it only below its threshold, and then the values outside
    the target cells never move. Without groups there are at most two cells per
    wanted quantile; with groups the table is written once and read back.
    """
    if keys:
        return materialised(targets, "cells")
    rows = targets.collect()
    if not rows:
        return targets
    cells = literal_table(
        targets.sparkSession, [(r[CELL], r["__before_n"]) for r in rows], f"{CELL} bigint, __before_n bigint"
    )
    # Without groups every row carries the same positions.
    return cells.withColumns({
        "__pos": F.lit(rows[0]["__pos"]).cast("array<bigint>"), "__share": F.lit(rows[0]["__share"]).cast("array<double>"),
    })


def average_ranks(df: DataFrame, column: str, sums: Mapping[str, Column], keys: Sequence[str] = ()) -> DataFrame:
    """One row per (group and) distinct value with its average rank and extra aggregates."""
    per_value = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"), *[c.alias(k) for k, c in sums.items()])
    stepped = running_sums(per_value, column, {"upto": "n"}, keys)
    return stepped.withColumn("avg_rank", F.col("upto") - (F.col("n") - 1) / F.lit(2.0))


def surrogate_keys(df: DataFrame, column: str, out: str) -> DataFrame:
    """Number distinct values of any orderable type from 1 in their order.

    Values are range-partitioned and checkpointed, so that partition numbers
    stay fixed, then numbered by partition offset plus local row number.
    """
    distinct = df.select(column).filter(F.col(column).isNotNull()).distinct()
    ranged = checkpointed(
        distinct.repartitionByRange(column).withColumn(CELL, F.spark_partition_id().cast("long"))
    )
    prefix = _prefix(ranged, {"n": F.count(F.lit(1))}, (), False)
    local = Window.partitionBy(CELL).orderBy(column)
    return ranged.join(prefix, CELL).select(
        (F.row_number().over(local) + F.col("__before_n")).cast("long").alias(out), column
    )


def ranks(df: DataFrame, order: str, cells: int | None = None) -> DataFrame:
    """Add ``rank`` and ``dense_rank`` by ``order`` (numeric) over all rows; nulls rank last.

    Only the distinct values are ranked, so that a tied value is one row.
    """
    per_value = df.groupBy(F.col(order).alias("__value")).agg(F.count(F.lit(1)).alias("__n"), F.lit(1).alias("__one"))
    stepped = running_sums(per_value, "__value", {"__upto": "__n", "__distinct": "__one"}, cells=cells)
    ranked = stepped.select(
        F.col("__value").alias(order), (F.col("__upto") - F.col("__n") + 1).cast("long").alias("rank"), F.col("__distinct").cast("long").alias("dense_rank")
    )
    return join_on(df, ranked, [order])


def ntile(rn: Column, total: Column, buckets: int) -> Column:
    """ntile from a row number and the row count; earlier buckets take the rest."""
    size, extra = F.floor(total / F.lit(buckets)), total % F.lit(buckets)
    edge = extra * (size + 1)
    return F.when(rn <= edge, F.ceil(rn / (size + 1))).otherwise(
        extra + F.ceil((rn - edge) / F.greatest(size, F.lit(1)))
    ).cast("long")
