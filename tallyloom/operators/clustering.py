"""Clustering: Lloyd steps, silhouettes, density clusters on a grid."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.vectors import squared_l2
from tallyloom.operators.pairs import CHUNK, PAIRS, block_size, distances, matrix, numbers_of
from tallyloom.plans.graph import connected_components
from tallyloom.plans.literals import literal_table
from tallyloom.plans.scratch import checkpointed
from tallyloom.plans.workers import importable


def _as_array(few: DataFrame, item: Column, most: int) -> DataFrame:
    """One row with all items as an array; beyond ``most`` of them the query ends with an error, as the array goes to every task."""
    too_many = F.raise_error(F.lit(f"more than {most} clusters"))
    return few.select(item.alias("c")).limit(most + 1).select(F.when(F.count(F.lit(1)) <= most, F.collect_list("c")).otherwise(too_many).alias("cs"))


def assign_to_centers(df: DataFrame, vector: str, centers: DataFrame, cluster: str, center: str, most_centers: int = 10_000) -> DataFrame:
    """Nearest center per row (lowest number on a tie) and squared distance.

    The centers, at most ``most_centers``, travel as one array value, so rows are not shuffled.
    """
    few = _as_array(centers, F.struct(F.col(cluster).alias("k"), F.col(center).alias("c")), most_centers)
    options = F.transform("__cs", lambda c: F.struct(squared_l2(F.col(vector), c["c"]).alias("d"), c["k"].alias("k")))
    placed = df.withColumn("__cs", few.scalar()).withColumn("__best", F.array_min(options)).drop("__cs")
    return placed.select("*", F.col("__best.k").alias(cluster), F.col("__best.d").alias("squared_distance")).drop("__best")


def cluster_means(df: DataFrame, vector: str, cluster: str) -> DataFrame:
    """Size and mean vector per cluster, combined before the shuffle."""
    as_vector = array_to_vector(F.col(vector).cast("array<double>"))
    stats = Summarizer.metrics("count", "mean").summary(as_vector).alias("s")
    return df.groupBy(cluster).agg(stats).select(
        cluster, F.col("s.count").alias("n"), vector_to_array("s.mean").alias("center")
    )


def elbow(df: DataFrame, vector: str, ks: Sequence[int], seed: int) -> DataFrame:
    """Within-cluster sum of squares per number of clusters."""
    features = df.select(array_to_vector(F.col(vector).cast("array<double>")).alias("features")).cache()
    rows = []
    for k in ks:
        if k == 1:
            whole = features.agg(Summarizer.metrics("count", "variance").summary(F.col("features")).alias("s")).first()["s"]
            rows.append((1, float(sum(whole["variance"].toArray()) * (whole["count"] - 1))))
        else:
            rows.append((k, float(KMeans(k=k, seed=seed).fit(features).summary.trainingCost)))
    features.unpersist()
    return literal_table(df.sparkSession, rows, "k int, inertia double")


def silhouette_squared(df: DataFrame, row_id: str, vector: str, cluster: str, most_clusters: int = 10_000) -> DataFrame:
    """Exact silhouette per row with squared Euclidean distance.

    The mean squared distance to a cluster follows from its size, mean and
    sum of squared norms, so the cost is linear in rows. These figures of at
    most ``most_clusters`` clusters travel as one array value.
    """
    as_vector = array_to_vector(F.col(vector).cast("array<double>"))
    stats = df.groupBy(cluster).agg(Summarizer.metrics("count", "mean", "normL2").summary(as_vector).alias("s")).select(
        F.struct(
            F.col(cluster).alias("k"), F.col("s.count").cast("double").alias("n"), vector_to_array("s.mean").alias("m"),
            F.aggregate(vector_to_array("s.normL2"), F.lit(0.0), lambda a, x: a + x * x).alias("q"),
        ).alias("c")
    )
    few = _as_array(stats, F.col("c"), most_clusters).scalar()
    x = F.col(vector).cast("array<double>")
    own_norm = F.aggregate("__x", F.lit(0.0), lambda a, v: a + v * v)

    def mean_distance(c: Column) -> Column:
        dot = F.aggregate(F.zip_with("__x", c["m"], lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        return F.col("__n") + c["q"] / c["n"] - 2 * dot

    rows = df.select(row_id, cluster, x.alias("__x"), few.alias("__cs")).withColumn("__n", own_norm)
    far = F.transform("__cs", lambda c: F.struct(c["k"].alias("k"), c["n"].alias("n"), mean_distance(c).alias("d")))
    rows = rows.withColumn("__d", far)
    own = F.filter("__d", lambda c: c["k"] == F.col(cluster))[0]
    rows = rows.select(
        row_id, cluster, own["n"].alias("__size"),
        F.when(own["n"] > 1, own["d"] * own["n"] / (own["n"] - 1)).alias("a"),
        F.array_min(F.transform(F.filter("__d", lambda c: c["k"] != F.col(cluster)), lambda c: c["d"])).alias("b"),
    )
    return rows.select(row_id, cluster, _silhouette(F.col("a"), F.col("b")).alias("silhouette"))


_SUMS = pa.schema([("__i", pa.int64()), ("__k", pa.int64()), ("__c", pa.int64()), ("__s", pa.float64())])


def _told(names: np.ndarray, clusters: np.ndarray, others: np.ndarray, summed: np.ndarray) -> pa.Table:
    own = [np.repeat(x, len(others)) for x in (names, clusters)]
    return pa.table([*own, np.tile(others, len(names)), summed.ravel()], schema=_SUMS)


def _silhouette(a: Column, b: Column) -> Column:
    return F.when(a.isNull(), 0.0).otherwise(F.try_divide(b - a, F.greatest(a, b)))


def silhouette_euclidean(df: DataFrame, row_id: str, vector: str, cluster: str, block_rows: int | None = None) -> DataFrame:
    """Exact silhouette per row with plain Euclidean distance.

    This distance has no short form, so the work grows with the square of the
    rows. It is split into blocks of about ``block_rows`` (by default a sixteenth of the
    rows, while that fits a task); every two blocks meet once, for the rows of
    both, and give one sum per row and cluster, never pairs. Prefer
    ``silhouette_squared`` on large tables. Rows without a cluster or a vector,
    or with a null inside it, count in no mean and have no silhouette; vectors
    must be of one length.
    """
    importable(df.sparkSession)
    every_row = df.select(F.col(row_id).alias("__i"), F.col(cluster).cast("bigint").alias("__k"), numbers_of(df, vector).alias("__v"))
    whole = F.col("__k").isNotNull() & F.col("__v").isNotNull() & ~F.exists("__v", lambda x: x.isNull())
    whole = F.coalesce(whole, F.lit(False))
    rows = every_row.filter(whole)
    told = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("__v")).alias("width")).first()
    blocks = max(1, -(-told["n"] // (block_rows or block_size(told["n"], told["width"] or 0))))
    own = rows.withColumn("__o", F.pmod(F.xxhash64("__i"), F.lit(blocks)).cast("int"))
    dealt = own.withColumn("__e", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        "__i", "__k", "__v", "__o", F.least("__o", "__e").alias("__a"), F.greatest("__o", "__e").alias("__b"))

    def sums(both: pa.Table) -> pa.Table:
        both = both.sort_by([("__o", "ascending"), ("__k", "ascending")])
        names, clusters, vectors = both.column("__i").to_numpy(), both.column("__k").to_numpy(), matrix(both.column("__v"))
        owners = both.column("__o").to_numpy()
        met, cut = both.column("__a")[0] != both.column("__b")[0], int(np.searchsorted(owners, owners[-1]))
        if met and not cut:
            return _SUMS.empty_table()  # the other block has no rows
        first, second = (slice(0, cut), slice(cut, None)) if met else (slice(None), slice(None))
        a, b, of_a, of_b = vectors[first], vectors[second], clusters[first], clusters[second]
        starts_a, starts_b = (np.flatnonzero(np.append(True, c[1:] != c[:-1])) for c in (of_a, of_b))
        to_b, to_a = np.zeros((len(a), len(starts_b))), np.zeros((len(starts_a), len(b)))
        step = max(1, PAIRS // min(len(b), CHUNK))
        for at in range(0, len(a), step):
            group = np.flatnonzero(np.append(True, of_a[at:at + step][1:] != of_a[at:at + step][:-1]))
            rank_a = np.searchsorted(starts_a, at + group, side="right") - 1
            for start in range(0, len(b), CHUNK):
                d = distances(a[at:at + step], b[start:start + CHUNK])
                some = of_b[start:start + CHUNK]
                cuts = np.flatnonzero(np.append(True, some[1:] != some[:-1]))
                rank_b = np.searchsorted(starts_b, start + cuts, side="right") - 1
                to_b[at:at + step, rank_b] += np.add.reduceat(d, cuts, axis=1)
                if met:
                    to_a[rank_a, start:start + CHUNK] += np.add.reduceat(d, group, axis=0)
        parts = [_told(names[first], of_a, of_b[starts_b], to_b)]
        if met:
            parts.append(_told(names[second], of_b, of_a[starts_a], to_a.T))
        return pa.concat_tables(parts)

    partial = dealt.groupBy("__a", "__b").applyInArrow(sums, "__i bigint, __k bigint, __c bigint, __s double")
    sizes = rows.groupBy(F.col("__k").alias("__c")).agg(F.count(F.lit(1)).alias("__n"))
    means = partial.groupBy("__i", "__k", "__c").agg(F.sum("__s").alias("__s")).join(sizes, "__c")
    mine = F.col("__c") == F.col("__k")
    both = means.groupBy("__i", "__k").agg(
        F.max(F.when(mine & (F.col("__n") > 1), F.col("__s") / (F.col("__n") - 1))).alias("a"),
        F.min(F.when(~mine, F.col("__s") / F.col("__n"))).alias("b"),
    )
    told = both.select("__i", "__k", _silhouette(F.col("a"), F.col("b")).alias("silhouette"))
    return told.unionByName(every_row.filter(~whole).select("__i", "__k", F.lit(None).cast("double").alias("silhouette"))).select(
        F.col("__i").alias(row_id), F.col("__k").alias(cluster), "silhouette"
    )


_MAX_LEVEL = 16


def dbscan(df: DataFrame, row_id: str, x: str, y: str, eps: float, min_points: int) -> DataFrame:
    """Exact density clusters in the plane: cluster (lowest core id, -1 for
    noise) and kind (core, border, noise).

    Grid cells have the diagonal ``eps``, so points of one cell are neighbours
    of each other. A cell with ``min_points`` points has only core points and
    is never paired up inside. Only points of thinner cells are compared one by
    one, and there are fewer than ``min_points`` of them per cell, so no point
    meets more than a fixed number of them, however hot its cell is.
    """
    width = eps / math.sqrt(2.0)
    points = df.select(
        F.col(row_id).cast("bigint").alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")
    ).withColumns({"cx": F.floor(F.col("x") / F.lit(width)), "cy": F.floor(F.col("y") / F.lit(width))})
    sizes = points.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("__n"))
    points = checkpointed(
        points.join(sizes, ["cx", "cy"]).withColumn("dense", F.col("__n") >= min_points).drop("__n")
    )
    around = [(dx, dy) for dx in range(-2, 3) for dy in range(-2, 3)]
    thin = points.filter(~F.col("dense")).select(
        F.col("id").alias("p"), F.col("x").alias("px"), F.col("y").alias("py"),
        F.inline(F.array(*[F.struct((F.col("cx") + dx).alias("cx"), (F.col("cy") + dy).alias("cy")) for dx, dy in around])),
    )
    near = (F.col("px") - F.col("x")) ** 2 + (F.col("py") - F.col("y")) ** 2 <= F.lit(eps * eps)
    thin_core = (
        thin.join(points, ["cx", "cy"]).filter(near).groupBy("p").agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= min_points).select(F.col("p").alias("id"), F.lit(True).alias("thin_core"))
    )
    marked = checkpointed(
        points.join(thin_core, "id", "left")
        .withColumn("core", F.col("dense") | F.coalesce("thin_core", F.lit(False)))
        .drop("thin_core")
    )
    core = marked.filter("core")
    links = _linked_cells(core, width, eps)
    cell = F.struct("cx", "cy")
    joined = connected_components(links, "a", "b")
    with_cell = core.select("id", cell.alias("node"), "cx", "cy")
    rooted = with_cell.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = rooted.groupBy("component").agg(F.min("id").alias("cluster"))
    cell_names = checkpointed(
        rooted.select("component", "cx", "cy").distinct().join(names, "component").select("cx", "cy", "cluster")
    )
    core_named = core.join(cell_names, ["cx", "cy"])
    core_out = core_named.select("id", "cluster", F.lit("core").alias("kind"))
    lone = thin.join(marked.filter(~F.col("core")).select(F.col("id").alias("p")), "p", "left_semi")
    border = lone.join(core_named, ["cx", "cy"]).filter(near).groupBy("p").agg(F.min("cluster").alias("cluster"))
    rest = (
        marked.filter(~F.col("core")).select("id").join(border.withColumnRenamed("p", "id"), "id", "left")
        .select("id", F.coalesce("cluster", F.lit(-1)).alias("cluster"),
                F.when(F.col("cluster").isNull(), "noise").otherwise("border").alias("kind"))
    )
    return core_out.unionByName(rest).withColumnRenamed("id", row_id)


def _boxes(core: DataFrame, keys: Sequence[str]) -> DataFrame:
    return core.groupBy(*keys).agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
        F.min(F.struct("x", "y")).alias("one"),
    )


def _linked_cells(core: DataFrame, width: float, eps: float) -> DataFrame:
    """Pairs of cells that hold two core points within ``eps`` of each other.

    Boxes of points decide most pairs: too far apart, or near enough in their
    farthest corners. Pairs that are neither are looked at again in boxes of a
    quarter of the size, so point pairs are compared only when their box has
    shrunk to the points themselves.
    """
    limit = F.lit(eps * eps)

    def side(prefix: str, df: DataFrame, own: Sequence[str]) -> DataFrame:
        return df.select(*[F.col(c).alias(prefix + c) for c in (*own, "x0", "x1", "y0", "y1", "one")])

    def judged(pairs: DataFrame) -> DataFrame:
        gap_x = F.greatest(F.col("ax0") - F.col("bx1"), F.col("bx0") - F.col("ax1"), F.lit(0.0))
        gap_y = F.greatest(F.col("ay0") - F.col("by1"), F.col("by0") - F.col("ay1"), F.lit(0.0))
        far_x = F.greatest(F.col("ax1") - F.col("bx0"), F.col("bx1") - F.col("ax0"))
        far_y = F.greatest(F.col("ay1") - F.col("by0"), F.col("by1") - F.col("ay0"))
        sample = (F.col("aone.x") - F.col("bone.x")) ** 2 + (F.col("aone.y") - F.col("bone.y")) ** 2
        linked = (far_x * far_x + far_y * far_y <= limit) | (sample <= limit)
        return pairs.withColumn("linked", linked).filter(F.col("linked") | (gap_x * gap_x + gap_y * gap_y <= limit))

    ahead = [(dx, dy) for dx in range(0, 3) for dy in range(-2, 3) if (dx, dy) > (0, 0)]
    cells = _boxes(core, ["cx", "cy"])
    a = side("a", cells, ["cx", "cy"]).withColumn("__to", F.explode(F.array(*[
        F.struct((F.col("acx") + dx).alias("cx"), (F.col("acy") + dy).alias("cy")) for dx, dy in ahead])))
    b = side("b", cells, ["cx", "cy"])
    pair_keys = ["acx", "acy", "bcx", "bcy"]
    first = a.join(b, (F.col("__to.cx") == F.col("bcx")) & (F.col("__to.cy") == F.col("bcy"))).drop("__to")
    state = checkpointed(judged(first).select(*pair_keys, "linked"))
    links = state.filter("linked").select(*pair_keys)
    open_pairs = state.filter(~F.col("linked")).select(*pair_keys, *[F.lit(0).cast("long").alias(c) for c in ("apx", "apy", "bpx", "bpy")])
    points = core.withColumns({"px": F.lit(0).cast("long"), "py": F.lit(0).cast("long")})
    for level in range(1, _MAX_LEVEL + 1):
        if open_pairs.isEmpty():
            break
        size = width / 4**level
        own = ["cx", "cy", "px", "py", "sx", "sy"]
        fine = points.withColumns({"sx": F.floor(F.col("x") / F.lit(size)), "sy": F.floor(F.col("y") / F.lit(size))})
        boxes = _boxes(fine, own)
        pairs = open_pairs.join(side("a", boxes, own), ["acx", "acy", "apx", "apy"]).join(
            side("b", boxes, own), ["bcx", "bcy", "bpx", "bpy"])
        state = checkpointed(judged(pairs).select(*pair_keys, "asx", "asy", "bsx", "bsy", "linked"))
        found = state.filter("linked").select(*pair_keys).distinct()
        links = links.unionByName(found)
        open_pairs = state.filter(~F.col("linked")).join(found, pair_keys, "left_anti").select(
            *pair_keys, F.col("asx").alias("apx"), F.col("asy").alias("apy"), F.col("bsx").alias("bpx"), F.col("bsy").alias("bpy"))
        points = fine.drop("px", "py").withColumnsRenamed({"sx": "px", "sy": "py"})
    else:
        # Boxes are now 4^16 times smaller than a cell: compare what is left.
        left = points.select(*[F.col(c).alias("a" + c) for c in ("cx", "cy", "px", "py", "x", "y")])
        right = points.select(*[F.col(c).alias("b" + c) for c in ("cx", "cy", "px", "py", "x", "y")])
        last = open_pairs.join(left, ["acx", "acy", "apx", "apy"]).join(right, ["bcx", "bcy", "bpx", "bpy"])
        close = (F.col("ax") - F.col("bx")) ** 2 + (F.col("ay") - F.col("by")) ** 2 <= limit
        links = links.unionByName(last.filter(close).select(*pair_keys).distinct())
    return links.select(
        F.struct(F.col("acx").alias("cx"), F.col("acy").alias("cy")).alias("a"),
        F.struct(F.col("bcx").alias("cx"), F.col("bcy").alias("cy")).alias("b"),
    )


def eps_sweep(df: DataFrame, row_id: str, x: str, y: str, eps_values: Sequence[float], min_points: int) -> DataFrame:
    """Clusters, core, border and noise points per radius."""
    out = None
    for eps in eps_values:
        found = dbscan(df, row_id, x, y, eps, min_points).agg(
            F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("clusters"),
            *[F.count_if(F.col("kind") == k).alias(k) for k in ("core", "border", "noise")],
        ).select(F.lit(float(eps)).alias("eps"), "*")
        out = found if out is None else out.unionByName(found)
    return out
