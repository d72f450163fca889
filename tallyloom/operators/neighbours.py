"""Exact nearest neighbours, and what is built on them."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.operators.pairs import block_size, distances, matrix, nearest, numbers_of, packed
from tallyloom.plans.ordering import row_numbers
from tallyloom.plans.workers import importable


def _matrix(series: pd.Series) -> np.ndarray:
    return np.stack(series.to_numpy()).astype("float64") if len(series) else np.zeros((0, 1))


_FOUND = pa.schema([("__q", pa.int64()), ("__r", pa.int64()), ("__d", pa.float64())])


def _by_cell(values: dict[int, int]) -> Column:
    """Lookup of a small per-cell number by the cell column."""
    entries = F.create_map(*[F.lit(x) for pair in values.items() for x in pair])
    return F.coalesce(F.try_element_at(entries, F.col("__cell")), F.lit(0))


def knn_join(
    queries: DataFrame,
    references: DataFrame,
    query_id: str,
    reference_id: str,
    vector: str,
    k: int,
    exclude_self: bool = False,
    pivots: int = 32,
    block_rows: int | None = None,
) -> DataFrame:
    """The ``k`` nearest references of every query: id, distance, rank.

    References are assigned to the nearest of a few pivots. Per query, the
    pivots give an upper bound for the k-th distance, and by the triangle
    inequality only cells that can hold something nearer are searched. Small
    cells are searched together, large ones are cut: both sides meet in blocks
    of about ``block_rows`` (by default a sixteenth of the larger side, while that fits a
    task), so a hot cell is spread over many tasks and a query travels once a
    block, not once a cell. A block returns at most ``k`` rows per query. Rows without a vector, or with a null, NaN or infinity
    inside it, are no references and as queries have no neighbours; vectors
    must be of one length.
    """
    importable(references.sparkSession)
    whole = F.col("__v").isNotNull() & ~F.exists("__v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    refs = references.select(F.col(reference_id).alias("__r"), numbers_of(references, vector).alias("__v")).filter(whole)
    asks = queries.select(F.col(query_id).alias("__q"), numbers_of(queries, vector).alias("__v")).filter(whole)
    centers = refs.orderBy(F.xxhash64("__r"), "__r").limit(pivots).collect()  # ``pivots`` rows
    if not centers:
        empty = asks.filter(F.lit(False)).select(F.col("__q").alias(query_id))
        return empty.select(query_id, F.lit(None).cast("bigint").alias("neighbour"),
                            F.lit(None).cast("double").alias("distance"), F.lit(None).cast("long").alias("rank"))
    points = np.array([c["__v"] for c in centers])

    @F.pandas_udf("struct<cell:int,gap:double>")
    def nearest_pivot(vectors: pd.Series) -> pd.DataFrame:
        d = distances(_matrix(vectors), points)
        cell = d.argmin(axis=1) if len(d) else np.zeros(0, int)
        return pd.DataFrame({"cell": cell.astype("int32"), "gap": d[np.arange(len(d)), cell]})

    placed = refs.withColumn("__p", nearest_pivot("__v")).select(
        "__r", "__v", F.col("__p.cell").alias("__cell"), F.col("__p.gap").alias("__gap")
    )
    need = k + 1 if exclude_self else k
    closest = Window.partitionBy("__cell").orderBy("__gap")
    per_cell = placed.groupBy("__cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("__gap").alias("low"), F.max("__gap").alias("high")
    ).collect()  # one row per pivot
    close = (
        placed.select("__cell", "__gap")
        .withColumn("__i", F.row_number().over(closest))
        .filter(F.col("__i") <= need)
        .collect()  # at most pivots x (k + 1) rows
    )
    low, high = np.full(len(points), np.inf), np.full(len(points), -np.inf)
    for row in per_cell:
        low[row["__cell"]], high[row["__cell"]] = row["low"], row["high"]
    near_cell = np.array([row["__cell"] for row in close])
    near_gap = np.array([row["__gap"] for row in close])
    block_rows = block_rows or block_size(max(asks.count(), sum(row["n"] for row in per_cell)), points.shape[1])

    shared = packed({row["__cell"]: row["n"] for row in per_cell}, block_rows)
    bins = np.array([shared.get(c, 0) for c in range(len(points))])

    @F.pandas_udf("array<int>")
    def bins_to_search(vectors: pd.Series) -> pd.Series:
        d = distances(_matrix(vectors), points)
        if not len(d):
            return pd.Series([], dtype=object)
        reach = d[:, near_cell] + near_gap
        bound = np.partition(reach, need - 1, axis=1)[:, need - 1] if reach.shape[1] >= need else np.full(len(d), np.inf)
        bound = bound * (1 + 1e-9) + 1e-12
        usable = np.isfinite(low)
        useful = usable & (d - high <= bound[:, None]) & (low - d <= bound[:, None])
        return pd.Series([np.unique(bins[row]).astype("int32").tolist() for row in useful])

    routed = asks.withColumn("__cell", F.explode(bins_to_search("__v")))
    asked = {r["__cell"]: r["count"] for r in routed.groupBy("__cell").count().collect()}  # at most one per pivot
    held: dict[int, int] = {}
    for row in per_cell:
        held[shared[row["__cell"]]] = held.get(shared[row["__cell"]], 0) + row["n"]
    r_blocks = {c: -(-n // block_rows) for c, n in held.items()}
    q_blocks = {c: -(-n // block_rows) for c, n in asked.items()}

    def spread(own: str, own_blocks: dict, other_blocks: dict, own_name: str, other_name: str, df: DataFrame) -> DataFrame:
        total, others = _by_cell(own_blocks), _by_cell(other_blocks)
        return df.withColumn(own_name, F.pmod(F.xxhash64(own), F.greatest(total, F.lit(1))).cast("int")).withColumn(
            other_name, F.explode(F.when(others > 0, F.sequence(F.lit(0), others - 1)).otherwise(F.array().cast("array<int>")))
        )

    left = spread("__q", q_blocks, r_blocks, "__qb", "__rb", routed)
    binned = placed.select("__r", F.col("__v").alias("__rv"), _by_cell(shared).alias("__cell"))
    right = spread("__r", r_blocks, q_blocks, "__rb", "__qb", binned)

    def search(q: pa.Table, r: pa.Table) -> pa.Table:
        asking, names = q.column("__q").to_numpy(), r.column("__r").to_numpy()
        if not len(asking) or not len(names):
            i, j, d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        else:
            i, j, d = nearest(matrix(q.column("__v")), matrix(r.column("__rv")), names, k, asking if exclude_self else None)
        return pa.table({"__q": asking[i], "__r": names[j], "__d": d}, schema=_FOUND)

    keys = ["__cell", "__rb", "__qb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "__q bigint, __r bigint, __d double")
    order = Window.partitionBy("__q").orderBy("__d", "__r")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(
        F.col("__q").alias(query_id), F.col("__r").alias("neighbour"), F.col("__d").alias("distance"),
        F.col("rank").cast("long").alias("rank"),
    )


def knn_vote(found: DataFrame, labels: DataFrame, query_id: str, reference_id: str, label: str) -> DataFrame:
    """Majority label of the neighbours, the smaller label on a tie."""
    named = found.join(labels.select(F.col(reference_id).alias("neighbour"), label), "neighbour")
    votes = named.groupBy(query_id, label).agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy(query_id).agg(F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("predicted"))


def smote(df: DataFrame, row_id: str, label: str, minority, features: Sequence[str], k: int, seed: int) -> DataFrame:
    """Synthetic minority rows until both classes have the same size.

    Each lies between a minority row and one of its ``k`` nearest minority
    rows. Choices come from hashes of the row id, so retries repeat them.
    """
    own = df.filter(F.col(label) == F.lit(minority)).select(row_id, F.array(*[F.col(f).cast("double") for f in features]).alias("__x"))
    sizes = df.agg(F.count_if(F.col(label) == F.lit(minority)).alias("m"), F.count_if(F.col(label) != F.lit(minority)).alias("o")).first()
    need = max(0, sizes["o"] - sizes["m"])
    each, extra = divmod(need, max(1, sizes["m"]))
    numbered = row_numbers(
        own.withColumn("__o", F.pmod(F.xxhash64(row_id, F.lit(seed)), F.lit(1 << 52)).cast("double")), "__o", row_id, out="__n"
    ).drop("__o")
    copies = F.lit(each) + F.when(F.col("__n") <= extra, 1).otherwise(0)
    drawn = numbered.withColumn(
        "__copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>")))
    )
    near = knn_join(own, own, row_id, row_id, "__x", k, exclude_self=True)
    per_row = near.groupBy(row_id).agg(F.max("rank").alias("__have"))
    pick = F.pmod(F.xxhash64(row_id, "__copy", F.lit(seed), F.lit(1)), F.col("__have")) + 1
    share = F.pmod(F.xxhash64(row_id, "__copy", F.lit(seed), F.lit(2)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    chosen = drawn.join(per_row, row_id).withColumn("rank", pick).withColumn("__u", share).join(near.drop("distance"), [row_id, "rank"])
    other = own.select(F.col(row_id).alias("neighbour"), F.col("__x").alias("__y"))
    mixed = F.zip_with("__x", "__y", lambda x, y: (y - x))
    rows = chosen.join(other, "neighbour").withColumn("__d", mixed)
    return rows.select(
        F.col(row_id).alias("base_id"), "neighbour", F.col("__copy").alias("copy"), F.col("__u").alias("share"),
        F.lit(minority).alias(label),
        *[(F.col("__x")[i] + F.col("__u") * F.col("__d")[i]).alias(f) for i, f in enumerate(features)],
    )
