"""N-gram Jaccard self-join: MinHash banding, verified on full n-gram sets.

1. Texts with one and the same set of word n-grams become one representative.
2. Each representative's MinHash signature is cut into bands; a shuffle on band
   hashes links every member of a bucket to the bucket's first member, never to
   each other. Linked representatives form candidate groups.
3. A candidate group is cut into blocks of bounded size; each pair of blocks is
   one cell, in which all pairs are verified on their full sets by counting
   common n-grams. A cell returns each document's number of links and its tree
   edge within the cell, so that pairs are never listed.
4. The tree edges connect to classes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import appended, bounded_batches, fields, packed
from tallyloom.llm.decontaminate import terms
from tallyloom.plans.graph import connected_components
from tallyloom.plans.scratch import materialised, run_dir

SIGNED = fields(n_shingles="long", fingerprint="binary", bands="list_long")
LINKED = fields(rid="long", root="long", links="long")

_PRIME = np.uint64(0x9E3779B97F4A7C15)


def banding(threshold: float, recall: float, most_hashes: int = 192) -> tuple[int, int]:
    """Bands and rows: the longest bands (fewest false candidates) that find a pair at ``threshold`` with at least ``recall``."""
    best = (most_hashes, 1)
    for rows in range(1, most_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold ** rows)))
        if bands * rows <= most_hashes:
            best = (bands, rows)
    return best


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(body: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; fewer than ``n`` words make one n-gram."""
    words = terms(body)
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
    width = min(n, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        out = out * _PRIME + hashes[k:k + len(out)]
    return np.unique(_mixed(out))


def band_hashes(grams: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit hash per band of the MinHash signature."""
    seeds = _mixed(np.arange(1, bands * rows + 1, dtype=np.uint64) * _PRIME)
    lowest = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), 2048):
        part = (grams[at:at + 2048, None] ^ seeds) * (seeds | np.uint64(1))
        lowest = np.minimum(lowest, part.min(axis=0))
    out = np.arange(1, bands + 1, dtype=np.uint64)
    for row in lowest.reshape(bands, rows).T:
        out = _mixed(out * _PRIME + row)
    return out.view(np.int64)


def common_counts(sets: list[np.ndarray], dense_from: int = 48, most_pairs: int = 2_000_000) -> np.ndarray:
    """Matrix of the number of common n-grams of all sets of one cell.

    N-grams that many sets hold are counted by matrix products, the others by
    the few pairs of sets that hold them.
    """
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    sizes = np.diff(np.append(starts, len(values)))
    counts = np.zeros((n, n), np.int32)
    often = np.flatnonzero(sizes >= dense_from)
    for at in range(0, len(often), 1024):
        part = often[at:at + 1024]
        held = np.zeros((n, len(part)), np.float32)
        where = np.concatenate([np.arange(starts[k], starts[k] + sizes[k]) for k in part])
        held[owner[where], np.repeat(np.arange(len(part)), sizes[part])] = 1
        counts += (held @ held.T).astype(np.int32)
    flat = counts.reshape(-1)
    for size in np.unique(sizes[(sizes > 1) & (sizes < dense_from)]):
        groups = starts[sizes == size]
        step = max(1, most_pairs // int(size * size))
        for at in range(0, len(groups), step):
            members = owner[groups[at:at + step, None] + np.arange(size)]
            pairs = (members[:, :, None] * n + members[:, None, :]).reshape(-1)
            flat += np.bincount(pairs, minlength=n * n).astype(np.int32)
    np.fill_diagonal(counts, [len(s) for s in sets])
    return counts


def verify_cell(rids: np.ndarray, blocks: np.ndarray, copies: np.ndarray, sets: list[np.ndarray], same: bool, threshold: Fraction) -> list[tuple[int, int, int]]:
    """(document, root of its tree in this cell, documents linked to it) for documents with links in this cell."""
    common = common_counts(sets)
    sizes = np.array([len(s) for s in sets])
    linked = common * (threshold.denominator + threshold.numerator) >= threshold.numerator * (sizes[:, None] + sizes[None, :])
    np.fill_diagonal(linked, False)
    if not same:
        linked &= blocks[:, None] != blocks[None, :]
    number = linked @ copies
    root = np.arange(len(rids))
    while True:
        lowest = np.minimum(root, np.where(linked, root[None, :], len(rids)).min(axis=1, initial=len(rids)))
        lowest = lowest[lowest]
        if (lowest == root).all():
            break
        root = lowest
    at = np.flatnonzero(linked.any(axis=1))
    return [(int(rids[k]), int(rids[root[k]]), int(number[k])) for k in at]


def jaccard_classes(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, n: int = 5, threshold: float = 0.8,
    recall: float = 0.9999, block_docs: int = 1024, block_grams: int = 400_000,
) -> DataFrame:
    """``row`` with ``class_id`` (smallest id of its class), ``n_links`` (other documents at ``threshold`` or above) and ``is_head``.

    One row per input row; ``is_head`` marks one row of each class, the one of
    smallest id. Texts of the same n-gram set have similarity 1. A null text or
    one without words is a class of its own without links; a null id counts as
    the largest, and a class of null ids only has a null ``class_id``; repeated
    rows are members like others. ``recall`` holds for a pair right at the
    threshold and rises with similarity; pairs within a candidate group are all
    verified, so that the recall of the result lies above it.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    bands, rows = banding(threshold, recall)

    def sign(bodies: list[bytes | None]) -> list[pa.Array]:
        sizes, prints, hashes = [], [], []
        for body in bodies:
            grams = shingles(body, n)
            sizes.append(len(grams))
            prints.append(hashlib.md5(grams.tobytes(), usedforsecurity=False).digest() if len(grams) else None)
            hashes.append(band_hashes(grams, bands, rows) if len(grams) else None)
        return [pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(hashes, pa.list_(pa.int64()))]

    signed = appended(packed(docs, text), ["body"], sign, SIGNED)
    kept = docs.columns if keep is None else keep
    path = run_dir(spark, "ngram-signatures")  # holds each text once, whether or not it is returned
    signed.select(F.monotonically_increasing_id().alias("rid"), "row", *SIGNED.names).write.option("compression", "zstd").parquet(path)
    signed = spark.read.parquet(path).withColumns({"id": F.col("row")[doc_id], "body": F.col("row")[text].cast("binary")})

    head = F.struct(F.col("id").isNull().alias("no_id"), F.col("id").alias("id"), F.col("rid").alias("rid"))
    sets = signed.filter("fingerprint IS NOT NULL").groupBy("fingerprint").agg(F.min("rid").alias("rid"), F.min(head).alias("head"), F.count("*").alias("copies"))
    sets = materialised(sets, "ngram-sets")

    in_band = signed.join(sets.select("rid"), "rid").select("rid", F.explode("bands").alias("band"))
    first = in_band.groupBy("band").agg(F.min("rid").alias("first"), F.count("*").alias("members")).filter("members > 1")
    edges = in_band.join(first.select("band", "first"), "band").filter("rid <> first").select("rid", "first").distinct()
    groups = materialised(connected_components(edges, "rid", "first").withColumnRenamed("node", "rid"), "ngram-groups")

    links = materialised(_verified(signed, sets, groups, n, Fraction(str(threshold)), block_docs, block_grams), "ngram-links")
    classes = connected_components(links.select("rid", "root"), "rid", "root").withColumnRenamed("node", "rid")
    counted = links.groupBy("rid").agg(F.sum("links").alias("links"))
    sets = sets.join(classes, "rid", "left").join(counted, "rid", "left").withColumn("component", F.coalesce("component", "rid"))
    heads = sets.groupBy("component").agg(F.min("head").alias("class_head"))
    sets = sets.join(heads, "component").select("fingerprint", "class_head", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    kept_row = F.struct(*[F.col("row")[c].alias(c) for c in kept]).alias("row")
    return signed.select("rid", "id", kept_row, "fingerprint").join(sets, "fingerprint", "left").select(
        "row", F.when(F.col("fingerprint").isNull(), F.col("id")).otherwise(F.col("class_head.id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce(F.col("class_head.rid") == F.col("rid"), F.lit(True)).alias("is_head"),
    )


def _verified(signed: DataFrame, sets: DataFrame, groups: DataFrame, n: int, threshold: Fraction, block_docs: int, block_grams: int) -> DataFrame:
    members = groups.join(sets.select("rid", "copies"), "rid").join(signed.select("rid", "n_shingles", "body"), "rid")
    shape = groups.join(signed.select("rid", "n_shingles"), "rid").groupBy("component").agg(F.count("*").alias("docs"), F.sum("n_shingles").alias("grams"))
    shape = shape.select("component", F.greatest(F.ceil(F.col("docs") / block_docs), F.ceil(F.col("grams") / block_grams)).cast("int").alias("blocks"))
    members = members.join(shape, "component").select(
        F.struct("rid", "component", "copies", "blocks", F.pmod(F.xxhash64("rid"), F.col("blocks").cast("long")).cast("int").alias("block")).alias("row"), "body")

    def sets_of(bodies: list[bytes | None]) -> list[pa.Array]:
        return [pa.array([shingles(body, n).tobytes() for body in bodies], pa.binary())]

    members = appended(members, ["body"], sets_of, fields(grams="binary")).select("row.*", "grams")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    cells = members.select("*", other).select(
        "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "rid", "block", "copies", "grams")
    # as many tasks as the documents behind it, however little the cells' bytes suggest
    cells = cells.repartition(int(signed.sparkSession.conf.get("spark.sql.shuffle.partitions")), "component", "i", "j").sortWithinPartitions("component", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, []
        for batch in batches:
            columns = batch.to_pydict()
            for *key, rid, block, copies, grams in zip(*(columns[c] for c in ("component", "i", "j", "rid", "block", "copies", "grams"))):
                if key != cell:
                    if len(held) > 1:
                        yield _answer(cell, held, threshold)
                    cell, held = key, []
                held.append((rid, block, copies, np.frombuffer(grams, np.uint64)))
        if len(held) > 1:
            yield _answer(cell, held, threshold)

    return cells.mapInArrow(run, LINKED)


def _answer(cell: list[int], held: list[tuple], threshold: Fraction) -> pa.RecordBatch:
    rids, blocks, copies, sets = zip(*held)
    found = verify_cell(np.array(rids), np.array(blocks), np.array(copies), list(sets), cell[1] == cell[2], threshold)
    columns = list(zip(*found)) or [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=LINKED.names)


def one_per_class(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that head their class, with their columns."""
    return jaccard_classes(docs, doc_id, text, **options).filter("is_head").select("row.*")
