"""Density clusters of whole vectors, in any number of dimensions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.pairs import CHUNK, PAIRS, block_size, matrix, numbers_of, packed, squares
from tallyloom.plans.graph import connected_components
from tallyloom.plans.scratch import materialised
from tallyloom.plans.workers import importable

#: Home vectors looked at at once.
_TILE = max(1, PAIRS // CHUNK)


def within(a: np.ndarray, b: np.ndarray, eps: float) -> np.ndarray:
    """Which pairs are at most ``eps`` apart; close calls are settled by the differences themselves."""
    limit = eps * eps
    apart = squares(a, b)
    slack = 1e-9 * (limit + float((a * a).sum(axis=1).max(initial=0)) + float((b * b).sum(axis=1).max(initial=0)))
    near = apart <= limit
    i, j = np.nonzero(np.abs(apart - limit) <= slack)
    for at in range(0, len(i), 65536):
        some = slice(at, at + 65536)
        near[i[some], j[some]] = ((a[i[some]] - b[j[some]]) ** 2).sum(axis=1) <= limit
    return near


class _Reach:
    """Which home vectors lie at most ``eps`` from others, as ``within`` says.

    Products in single precision, about the homes' middle, decide all but close
    calls; where too many would be close, those in double precision do.
    """

    def __init__(self, homes: np.ndarray, eps: float):
        self.homes, self.eps, self.limit = homes, eps, eps * eps
        self.middle = homes.mean(axis=0)
        moved = homes - self.middle
        lengths = (moved * moved).sum(axis=1)
        self.longest = float(lengths.max(initial=0))
        with np.errstate(over="ignore", invalid="ignore"):
            self.table = np.column_stack([-2 * moved, lengths, np.ones(len(moved))]).astype(np.float32)

    def of(self, others: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        """For one chunk of others: which home rows are near which of the chunk's rows."""
        moved = others - self.middle
        lengths = (moved * moved).sum(axis=1)
        longest = self.longest + float(lengths.max(initial=0))
        slack = (others.shape[1] + 16) * 2.0 ** -22 * (longest + self.limit)
        if not (slack <= 0.01 * self.limit and longest < 1e30 and self.limit > 1e-30):
            return lambda rows, columns: within(self.homes[rows], others[columns], self.eps)
        table = np.column_stack([moved, np.ones(len(moved)), lengths]).astype(np.float32)
        low, high = np.float32(self.limit - slack), np.float32(self.limit + slack)

        def near(rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
            apart = self.table[rows] @ (table if len(columns) == len(table) else table[columns]).T
            sure = apart <= low
            i, j = np.nonzero((apart <= high) ^ sure)
            if len(i):
                sure[i, j] = ((self.homes[rows[i]] - others[columns[j]]) ** 2).sum(axis=1) <= self.limit
            return sure

        return near


def _homes(centers: np.ndarray):
    """The nearest center of each vector, and how far it is."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                far = np.maximum(squares(matrix(batch.column(0)), centers), 0)
                home = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(home, pa.int32()), pa.array(np.sqrt(far[np.arange(len(home)), home]))], names=["cell", "far"])

    return run


def _dealer(centers: np.ndarray, eps: float, radius: np.ndarray, shared: np.ndarray):
    """Each vector at home in the cell of its nearest center, and a guest where it may have neighbours; cells by the numbers they share.

    The plane half-way between two centers parts their cells, so a vector
    farther than ``eps`` from it has no neighbour beyond.
    """
    apart = np.sqrt(np.maximum(squares(centers, centers), 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            far = np.maximum(squares(matrix(batch.column(2)), centers), 0)
            home = far.argmin(axis=1)
            rows = np.arange(len(home))
            with np.errstate(divide="ignore", invalid="ignore"):
                beyond = (far - far[rows, home][:, None]) / (2 * apart[home])
            reach = (beyond <= eps + 1e-6 * (1 + eps)) & (np.sqrt(far) <= radius + eps * (1 + 1e-6) + 1e-6)
            reach[rows, home] = True
            cells = [np.unique(shared[row]).tolist() for row in reach]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared[home], pa.int32()), pa.array(cells, pa.list_(pa.int32()))], names=["p", "w", "v", "home", "cells"])

    return run


def _numbers(cell: Column, values: dict[int, float | int]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[cell]


def _met(points: DataFrame, others: DataFrame, columns: Sequence[str], sizes: dict[int, tuple[int, int]], block_rows: int, step: Callable, schema: str) -> DataFrame:
    """Runs ``step(cell, home rows)`` for every block of a cell's home rows, and meets it with every block of the others that come to the cell.

    Blocks have about ``block_rows`` rows, so a crowded cell is spread over
    many tasks; home rows come first, the others follow as a stream.
    """
    a, b = ({c: -(-n[k] // block_rows) for c, n in sizes.items()} for k in (0, 1))
    mine = F.pmod(F.xxhash64("p"), _numbers(F.col("cell"), a)).cast("int")
    other = F.pmod(F.xxhash64("p", F.lit(1)), _numbers(F.col("cell"), b)).cast("int")
    every_a, every_b = (F.explode(F.sequence(F.lit(0), (_numbers(F.col("cell"), n) - 1).cast("int"))) for n in (a, b))
    left = points.withColumn("cell", F.col("home")).select("cell", mine.alias("i"), every_b.alias("j"), F.lit(0).alias("side"), *columns)
    guests = others.withColumn("cell", F.explode("cells"))
    right = guests.select("cell", every_a.alias("i"), other.alias("j"), F.lit(1).alias("side"), *columns)
    dealt = left.unionByName(right).repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, homes, work = None, [], None
        for batch in batches:
            keys = np.column_stack([batch.column(k).to_numpy() for k in range(4)])
            cuts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))).tolist() if len(keys) else []
            for at, end in zip(cuts, [*cuts[1:], len(keys)]):
                rows = pa.RecordBatch.from_arrays(batch.columns[4:], names=list(columns)).slice(at, end - at)
                if tuple(keys[at, :3]) != now:
                    if work:
                        yield from work.close()
                    now, homes, work = tuple(keys[at, :3]), [], None
                if keys[at, 3] == 0:
                    homes.append(rows)
                elif homes:
                    work = work or step(now[0], pa.Table.from_batches(homes).combine_chunks().to_batches()[0])
                    work.meet(rows)
        if work:
            yield from work.close()

    return dealt.mapInArrow(run, schema)


class _Count:
    """Neighbours (rows, itself among them) of each home vector, counted no further than ``least``."""

    def __init__(self, homes: pa.RecordBatch, eps: float, least: int):
        self.ids, self.reach, self.least = homes.column(0), _Reach(matrix(homes.column(2)), eps), least
        self.found = np.zeros(len(self.ids), np.int64)

    def meet(self, others: pa.RecordBatch) -> None:
        weights, vectors = others.column(1).to_numpy(), matrix(others.column(2))
        for start in range(0, len(weights), CHUNK):
            near, some = self.reach.of(vectors[start:start + CHUNK]), weights[start:start + CHUNK]
            every, single = np.arange(len(some)), (some == 1).all()
            short = np.flatnonzero(self.found < self.least)
            for at in range(0, len(short), _TILE):
                rows = short[at:at + _TILE]
                hit = near(rows, every)
                self.found[rows] += np.count_nonzero(hit, axis=1) if single else np.where(hit, some, 0).sum(axis=1)

    def close(self) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([self.ids, pa.array(self.found)], names=["p", "n"])


class _Link:
    """Links among core vectors, one per vector and not per pair, and the core neighbours of the other home vectors.

    A core vector that is linked to a group of home vectors is not held
    against the others of that group. Core pairs of two cells are met in the
    lower one only.
    """

    def __init__(self, cell: int, homes: pa.RecordBatch, eps: float):
        self.cell, self.ids, self.reach = cell, homes.column(0).to_numpy(), _Reach(matrix(homes.column(2)), eps)
        core = homes.column(3).to_numpy(zero_copy_only=False)
        self.core, self.lone = np.flatnonzero(core), np.flatnonzero(~core)
        self.first = np.arange(len(self.ids))  # the least place of each one's group
        self.links: list[tuple[np.ndarray, np.ndarray, bool]] = []

    def meet(self, others: pa.RecordBatch) -> None:
        core = others.column(3).to_numpy(zero_copy_only=False)
        ids, vectors, ahead = others.column(0).to_numpy()[core], matrix(others.column(2))[core], others.column(4).to_numpy()[core] >= self.cell
        for start in range(0, len(ids), CHUNK):
            some = slice(start, start + CHUNK)
            near, names = self.reach.of(vectors[some]), ids[some]
            every = np.arange(len(names))
            for at in range(0, len(self.lone), _TILE):
                rows = self.lone[at:at + _TILE]
                row, column = np.nonzero(near(rows, every))
                self.links.append((self.ids[rows[row]], names[column], True))
            self.join(near, names, every[ahead[some]])

    def join(self, near: Callable, names: np.ndarray, columns: np.ndarray) -> None:
        """Each of the others joins the groups of the home vectors near it, which become one."""
        linked = np.full(len(names), -1)  # a home vector each has joined
        roots = self.first[self.core]
        # large groups first, each group's vectors side by side
        order = self.core[np.lexsort((roots, -np.bincount(roots, minlength=1)[roots]))] if len(roots) else self.core
        for at in range(0, len(order), _TILE):
            rows = order[at:at + _TILE]
            groups = self.first[rows]
            active = columns
            if (groups == groups[0]).all():
                active = columns[(linked[columns] < 0) | (self.first[linked[columns]] != groups[0])]
            if not len(active):
                continue
            row, column = np.nonzero(near(rows, active))
            if not len(row):
                continue
            home, other = rows[row], active[column]
            fresh = linked[other] < 0
            linked[other[fresh]] = home[fresh]
            self.unite(linked[other], home)
        some = np.flatnonzero(linked >= 0)
        if len(some):
            self.links.append((names[some], self.ids[linked[some]], False))

    def unite(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            one, two = self.first[a], self.first[b]
            apart = one != two
            if not apart.any():
                return
            a, b, one, two = a[apart], b[apart], one[apart], two[apart]
            np.minimum.at(self.first, np.maximum(one, two), np.minimum(one, two))
            while (self.first[self.first] != self.first).any():
                self.first = self.first[self.first]

    def close(self) -> Iterator[pa.RecordBatch]:
        for a, b, border in [*self.links, (self.ids[self.core], self.ids[self.first[self.core]], False)]:
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), border))], names=["a", "b", "border"])


def dbscan_vectors(df: DataFrame, row_id: str, vector: str, eps: float, min_points: int, pivots: int = 64, block_rows: int | None = None) -> DataFrame:
    """Exact density clusters over all components: ``cluster`` (lowest core id, -1 for noise) and ``kind`` (core, border, noise).

    Equal vectors are one vector with a weight, however often they come. The
    others fall into the cells of ``pivots`` of them, picked by hash; a vector
    is also looked at in the cells that may hold a neighbour of it. Small cells
    are met together, large ones cut, in blocks of about ``block_rows`` (by
    default a sixteenth of the vectors, while that fits a task). A vector is counted no further than
    ``min_points``, and a block gives one link per vector, so dense regions
    make no lists of pairs. A border row goes to the lowest of the clusters it
    touches. Rows without a vector, or with a null or NaN inside it, are noise;
    vectors must be of one length. Where ``eps`` is as wide as the cells (few
    clusters, many dimensions) every cell is met by all rows: work then
    grows with the square of the distinct vectors, in blocks.
    """
    importable(df.sparkSession)
    rows = df.select(F.col(row_id).cast("bigint").alias("id"), numbers_of(df, vector).alias("v"))
    whole = F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x))
    rows = rows.withColumn("v", F.when(whole, F.col("v")))
    points = materialised(rows.filter("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("p"), F.count(F.lit(1)).alias("w")).select("p", "w", "v"), "density-points")
    centers = [r["v"] for r in points.orderBy(F.xxhash64("p"), "p").limit(pivots).select("v").collect()]  # ``pivots`` rows
    if not centers:
        return rows.select(F.col("id").alias(row_id), F.lit(-1).cast("bigint").alias("cluster"), F.lit("noise").alias("kind"))
    centers = np.array(centers)
    at_home = points.select("v").mapInArrow(_homes(centers), "cell int, far double")
    told = at_home.groupBy("cell").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect()  # one row a pivot
    block_rows = block_rows or block_size(sum(r["n"] for r in told), centers.shape[1])
    numbers = packed({r["cell"]: r["n"] for r in told}, block_rows)
    radius, shared = np.full(len(centers), -np.inf), np.zeros(len(centers), np.int32)
    for r in told:
        radius[r["cell"]], shared[r["cell"]] = r["far"], numbers[r["cell"]]
    kind = dict(points.dtypes)["v"]
    cells = materialised(points.mapInArrow(_dealer(centers, eps, radius, shared), f"p bigint, w bigint, v {kind}, home int, cells array<int>"), "density-cells")
    mine = {r["home"]: r["count"] for r in cells.groupBy("home").count().collect()}
    sizes = {r["cell"]: (mine.get(r["cell"], 0), r["count"]) for r in cells.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect()}

    counts = _met(cells, cells, ["p", "w", "v"], sizes, block_rows, lambda cell, homes: _Count(homes, eps, min_points), "p bigint, n bigint")
    core = materialised(counts.groupBy("p").agg((F.sum("n") >= min_points).alias("core")), "density-core")
    marked = materialised(cells.join(core, "p"), "density-marked")
    met = _met(marked, marked.filter("core"), ["p", "w", "v", "core", "home"], sizes, block_rows, lambda cell, homes: _Link(cell, homes, eps), "a bigint, b bigint, border boolean")
    links = materialised(met, "density-links")
    joined = connected_components(links.filter("NOT border"), "a", "b")
    named = core.filter("core").join(joined, F.col("p") == F.col("node"), "left").select("p", F.coalesce("component", "p").alias("cluster"))
    border = links.filter("border").join(named, F.col("b") == F.col("p")).groupBy("a").agg(F.min("cluster").alias("cluster"))
    found = named.select("p", "cluster", F.lit("core").alias("kind")).unionByName(border.select(F.col("a").alias("p"), "cluster", F.lit("border").alias("kind")))
    of_vector = points.join(found, "p").select("v", "cluster", "kind")
    return rows.join(of_vector, "v", "left").select(
        F.col("id").alias(row_id), F.coalesce("cluster", F.lit(-1)).alias("cluster"), F.coalesce("kind", F.lit("noise")).alias("kind"))


def eps_sweep_vectors(df: DataFrame, row_id: str, vector: str, eps_values: Sequence[float], min_points: int) -> DataFrame:
    """Clusters, core, border and noise rows per radius, over all components."""
    out = None
    for eps in eps_values:
        found = dbscan_vectors(df, row_id, vector, eps, min_points).agg(
            F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("clusters"),
            *[F.count_if(F.col("kind") == k).alias(k) for k in ("core", "border", "noise")],
        ).select(F.lit(float(eps)).alias("eps"), "*")
        out = found if out is None else out.unionByName(found)
    return out
