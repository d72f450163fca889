"""Distances between two blocks of vectors, at the speed of matrix products and exact where it matters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pairs looked at at once, so that a step's memory does not follow its blocks.
PAIRS = 262_144
#: Rows of the other side looked at at once.
CHUNK = 2_048
#: Blocks that all rows are cut into, while a block is no larger than so many bytes of doubles.
BLOCKS, BLOCK_BYTES = 16, 64 << 20


def block_size(rows: int, numbers: int, least: int = 500) -> int:
    """Rows of a block. Every block meets every other one, so a row travels once a block: their number
    is fixed, and what travels grows with the rows and not with their square, until a block would not fit a task."""
    most = max(1, BLOCK_BYTES // (8 * max(1, numbers)))
    return max(1, min(max(least, -(-rows // BLOCKS)), most))


def packed(sizes: dict[int, int], room: int) -> dict[int, int]:
    """Small cells share a number while they fit into ``room`` together."""
    out, number, used = {}, 0, 0
    for cell, n in sorted(sizes.items()):
        if used and used + n > room:
            number, used = number + 1, 0
        out[cell] = number
        used += n
    return out


def numbers_of(df: DataFrame, vector: str) -> Column:
    """The vector as it is where its numbers are floats, which take half the room on their way; as doubles otherwise."""
    kind = df.select(vector).schema[0].dataType
    kept = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return F.col(vector) if kept else F.col(vector).cast("array<double>")


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of an Arrow list column without nulls as doubles; lists of several lengths are refused."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0))
    sizes = pc.min_max(pc.list_value_length(column)).as_py()
    if sizes["min"] != sizes["max"]:
        raise ValueError(f"vectors of {sizes['min']} and {sizes['max']} numbers")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), sizes["min"]).astype(np.float64, copy=False)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances from dot products: fast, but rounded at the scale of the vectors' own lengths."""
    return (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)


def exact(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray, step: int = 65_536) -> np.ndarray:
    """Distances of the pairs ``(i, j)`` from the differences themselves, so that equal distances come out equal."""
    out = np.empty(len(i))
    for at in range(0, len(i), step):
        some = slice(at, at + step)
        out[some] = np.sqrt(((a[i[some]] - b[j[some]]) ** 2).sum(axis=1))
    return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances; those that are short beside the vectors come from differences, as products would round them away."""
    scale = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)
    out = scale - 2 * (a @ b.T)
    i, j = np.nonzero(~(out > 1e-6 * scale))
    out = np.sqrt(np.maximum(out, 0))
    out[i, j] = exact(a, b, i, j)
    return out


def nearest(a: np.ndarray, b: np.ndarray, names: np.ndarray, k: int, own: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` nearest rows of ``b`` of each row of ``a``, the lower name first on equal distances: places in a, in b, distances.

    Products pick all pairs that may be among them, with room for rounding;
    exact distances settle which are. ``b`` is gone through in chunks, and what
    lies beyond the k-th distance so far is left out. A pair of ``own`` (names
    of a's rows) with the same name is none.
    """
    found = []
    lengths = (b * b).sum(axis=1)
    longest = float(lengths.max(initial=0))
    # so many of the least hold the k nearest, whichever of them are the row itself
    least = k + (int(np.unique(names, return_counts=True)[1].max(initial=0)) if own is not None else 0)
    ahead = np.column_stack([-2 * a, np.ones(len(a))])
    beyond = np.column_stack([b, lengths])
    step = max(1, PAIRS // max(1, min(len(b), CHUNK)))
    for at in range(0, len(a), step):
        some = a[at:at + step]
        length = (some * some).sum(axis=1)
        room = 1e-9 * (length + longest)
        limit = np.full(len(some), np.inf)
        i, j, d = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for start in range(0, len(b), CHUNK):
            near = ahead[at:at + step] @ beyond[start:start + CHUNK].T  # squares, less the length of a's row
            if least < near.shape[1] and np.isinf(limit).any():
                limit = np.minimum(limit, np.partition(near, least - 1, axis=1)[:, least - 1] + length + room)
            # not "at most": what overflows is settled by the differences
            row, place = np.nonzero(~(near > (limit + room - length)[:, None]))
            place += start
            if own is not None:
                other = own[at + row] != names[place]
                row, place = row[other], place[other]
            if not len(row):
                continue
            i, j, d = np.concatenate([i, row]), np.concatenate([j, place]), np.concatenate([d, exact(some, b, row, place)])
            order = np.lexsort((names[j], d, i))
            i, j, d = i[order], j[order], d[order]
            rank = np.arange(len(i)) - np.searchsorted(i, i)
            kept = (rank < k) & np.isfinite(d)
            i, j, d, rank = i[kept], j[kept], d[kept], rank[kept]
            last = rank == k - 1
            limit[i[last]] = np.minimum(limit[i[last]], d[last] ** 2 + room[i[last]])
        found.append((at + i, j, d))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*found))
