"""Language-model scoring: context-tree weighting learned from, and applied to, all documents.

Documents are dealt into blocks of bounded size. A block asks each part of the
model, in one packet of sorted keys, for what its texts hold: byte contexts and
tokens. The packets also carry the training counts. A part merges the counts
of all its packets, weights its trees (a part has whole trees from the second
context byte on; the few levels above are summed up from all parts), and
answers each packet. A block then adds up the answers per document. Packets,
not rows per byte, are shuffled; no part or block grows with the corpus but in
number, and the model is never in one place.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tallyloom.llm.common import bounded_batches, fields, packed
from tallyloom.llm.weighting import Level, added, grow, key_pieces, log10_probability
from tallyloom.plans.scratch import run_dir

SCORES = fields(n_tokens="long", n_known="long", train_tokens="long", base_score="double", score="double", bits_per_byte="double")

_DOC, _GRAMS, _TOKENS = 0, 1, 2
_CLOSE = xxhash.xxh3_64_intdigest(b" ") & ~1  # the end of a text as a token: no word has a space
_PACKET = fields(block="long", part="int", kind="int", keys="binary", counts="binary")
_STATS = fields(part="int", kind="int", keys="binary", counts="binary", nodes="binary", zeros="binary", ones="binary", weighted="binary", distinct="long", total="long")


def squeeze(keys: np.ndarray) -> bytes:
    return zstandard.compress(np.diff(keys, prepend=np.uint64(0)).astype("<u8").tobytes(), 1)


def spread(body: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(body), "<u8"), dtype=np.uint64)


class Hashes(dict):
    """63-bit hashes of words, the lowest bit free; remembers those of up to ``most`` words."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        hashed = self[word] = xxhash.xxh3_64_intdigest(word) & ~1
        return hashed


def tokens_of(body: bytes, hashes: Hashes) -> np.ndarray:
    """Hashes of the words, then the end."""
    words = body.split()
    return np.fromiter([*map(hashes.__getitem__, words), _CLOSE], np.uint64, len(words) + 1)


class Answers:
    """Values of sorted distinct keys, found by a slot of a hash; a key whose slot another one took is searched for."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, self.values = keys, values
        bits = max(8, (4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.zeros(1 << bits, np.int32)
        self.slots[self.place(keys)] = np.arange(len(keys), dtype=np.int32)

    def place(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys that are all known."""
        at = self.slots[self.place(keys)]
        missed = np.flatnonzero(self.keys[at] != keys)
        at[missed] = np.searchsorted(self.keys, keys[missed])
        return self.values[at]


class Gathered:
    """Distinct keys with their training counts, merged whenever enough have come in."""

    def __init__(self, most: int = 4_000_000):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held, self.most = 0, most

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.held += len(keys)
        if self.held > self.most:
            self.parts = [self.sum()]
            self.held = len(self.parts[0][0])
            self.most = max(self.most, 2 * self.held)

    def sum(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return added(np.concatenate([k for k, _ in self.parts]), np.concatenate([c for _, c in self.parts]))


def part_of(keys: np.ndarray, kind: int, depth: int, parts: int) -> np.ndarray:
    """By the two nearest context bytes, so that all deeper nodes of a tree are in one part; tokens by their hash."""
    near = keys >> np.uint64(8 * (depth - 1)) if kind == _GRAMS else keys >> np.uint64(1)
    return ((near * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(parts)


def score_documents(
    docs: DataFrame, training: Column, text: str = "text", keep: list[str] | None = None, depth: int = 5, block_bytes: int = 12_000_000, part_bytes: int = 16_000_000,
    most_parts: int = 1024, most_tasks: int = 100_000,
) -> DataFrame:
    """``row`` with token counts, the add-one unigram score, and the context-tree score with its code length per byte.

    One row per input row, learned from the rows where ``training`` holds.
    Null and empty texts have no words: one end token and one end byte. Without
    training rows N and V are 0 and all bytes are even. Repeated rows count as
    often as they come; a text of any length is scored whole (it can make a
    block of its own). Tokens are told apart by 63-bit hashes.

    The model has a part for every ``part_bytes`` of text, up to ``most_parts``: by
    then the distinct contexts of a few bytes no longer grow with the text.
    The last step has four partitions a block, up to ``most_tasks``, so that few
    tasks get a second one; a task works on one block at a time.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    size = docs.agg(F.sum(F.octet_length(docs[text]))).first()[0] or 0
    parts = max(1, min(most_parts, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // part_bytes))))
    kept = docs.columns if keep is None else keep
    frame = packed(docs.withColumn("_training", F.coalesce(training, F.lit(False))), text, [*kept, "_training"])
    frame = frame.select(F.struct(*[F.col("row")[c].alias(c) for c in kept]).alias("row"), "body", F.col("row._training").alias("training"))
    # packets have no document, so these columns can be null
    out = StructType([*_PACKET.fields, *[StructField(f.name, f.dataType, True) for f in frame.schema]])
    path = run_dir(spark, "scoring-packets")
    frame.mapInArrow(_cutter(depth, parts, block_bytes, frame.schema), out).write.option("compression", "zstd").parquet(path)
    cut = spark.read.schema(out).parquet(path)
    packets = cut.filter(F.col("kind") != _DOC).select(*_PACKET.names)

    stats_path = run_dir(spark, "scoring-counts")
    dealt = packets.repartition(parts, "part").sortWithinPartitions("part", "kind")
    dealt.mapInArrow(_summer(depth), _STATS).write.option("compression", "zstd").parquet(stats_path)
    stats = spark.read.schema(_STATS).parquet(stats_path)
    total = stats.agg(F.coalesce(F.sum("distinct"), F.lit(0)).alias("distinct"), F.coalesce(F.sum("total"), F.lit(0)).alias("total")).first()
    shared = spark.sparkContext.broadcast(_upper_levels(stats))

    # A part's counts come before its packets; answers go back to the blocks.
    none = F.lit(None).cast("binary")
    asked = packets.select("part", "kind", F.lit(1).alias("turn"), "block", "keys", none.alias("counts"))
    told = stats.filter("keys IS NOT NULL").select("part", "kind", F.lit(0).alias("turn"), F.lit(None).cast("long").alias("block"), "keys", "counts")
    answers = asked.unionByName(told).repartition(parts, "part").sortWithinPartitions("part", "kind", "turn").mapInArrow(_answerer(depth, shared), _PACKET)

    texts = cut.filter(F.col("kind") == _DOC).select("block", F.lit(9).alias("kind"), none.alias("keys"), none.alias("counts"), "row", "body")
    replies = answers.select("block", "kind", "keys", "counts", F.lit(None).cast(frame.schema["row"].dataType).alias("row"), none.alias("body"))
    blocks = cut.select("block").distinct().count()
    both = replies.unionByName(texts).repartition(max(1, min(most_tasks, 4 * blocks)), "block").sortWithinPartitions("block", "kind")
    return both.mapInArrow(_adder(depth, int(total["total"]), int(total["distinct"])), StructType([frame.schema["row"], *SCORES.fields]))


def _cutter(depth: int, parts: int, block_bytes: int, schema: StructType):
    """Deals texts into blocks; gives them on with their block, and each block's packets."""
    row_type = None

    def packets(block: int, grams: Gathered, tokens: Gathered) -> Iterator[dict]:
        for kind, gathered in ((_GRAMS, grams), (_TOKENS, tokens)):
            keys, counts = gathered.sum()
            part = part_of(keys, kind, depth, parts)
            order = np.lexsort((keys, part))
            keys, counts, part = keys[order], counts[order], part[order]
            for p, at in zip(*np.unique(part, return_index=True)):
                end = at + int(np.searchsorted(part[at:], p, side="right"))
                yield {"block": block, "part": int(p), "kind": kind, "keys": squeeze(keys[at:end]), "counts": zstandard.compress(counts[at:end].astype("<i8").tobytes(), 1)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nonlocal row_type
        block, size, grams, tokens, hashes = None, 0, Gathered(), Gathered(), Hashes()

        def flush() -> Iterator[pa.RecordBatch]:
            made = list(packets(block, grams, tokens))
            if made:
                columns = [pa.array([m[f.name] for m in made], kind) for f, kind in zip(_PACKET, (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.nulls(len(made), t) for t in row_type]], names=[*_PACKET.names, *schema.names])

        for batch in batches:
            row_type = [f.type for f in batch.schema]
            if block is None:
                block = int.from_bytes(os.urandom(8), "little") >> 1
            bodies = [(b or b"").lower() for b in batch.column(1).to_pylist()]
            for learned in (True, False):
                mine = [b for b, t in zip(bodies, batch.column(2).to_pylist()) if t is learned]
                if mine:
                    for gathered, pieces in ((grams, key_pieces(mine, depth)), (tokens, [np.concatenate([tokens_of(b, hashes) for b in mine])])):
                        for keys in pieces:
                            keys, counts = np.unique(keys, return_counts=True)
                            gathered.add(keys, counts if learned else np.zeros(len(keys), np.int64))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * n, pa.int64()), pa.nulls(n, pa.int32()), pa.array([_DOC] * n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
                 batch.column(0), pa.array(bodies, batch.schema.field(1).type), batch.column(2)], names=[*_PACKET.names, *schema.names])
            size += sum(map(len, bodies))
            if size >= block_bytes:
                yield from flush()
                block, size, grams, tokens = None, 0, Gathered(), Gathered()
        if block is not None:
            yield from flush()

    return run


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict]:
    for batch in batches:
        columns = batch.to_pydict()
        for values in zip(*(columns[c] for c in names)):
            yield dict(zip(names, values))


def _summer(depth: int):
    """Merged training counts of each part, and its trees' nodes at depth two."""
    def told(part: int, kind: int, gathered: Gathered) -> pa.RecordBatch:
        keys, counts = gathered.sum()
        keys, counts = keys[counts > 0], counts[counts > 0]
        row = dict.fromkeys(_STATS.names)
        row |= {"part": part, "kind": kind, "keys": squeeze(keys), "counts": zstandard.compress(counts.astype("<i8").tobytes(), 1)}
        if kind == _TOKENS:
            row |= {"distinct": len(keys), "total": int(counts.sum())}
        elif len(keys):
            top = grow(keys, counts, depth, 2)[2]
            # one row per part for each of the nearest bytes' nodes, already summed up
            nodes = top.nodes >> np.uint64(16) << np.uint64(8) | top.nodes & np.uint64(0xFF)
            order = np.argsort(nodes, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(nodes[order]) != 0))
            sums = [np.add.reduceat(x[order], first) for x in (top.zeros, top.ones, top.log_weighted)]
            row |= {"nodes": nodes[order][first].astype("<u8").tobytes(), "zeros": sums[0].astype("<i8").tobytes(), "ones": sums[1].astype("<i8").tobytes(), "weighted": sums[2].astype("<f8").tobytes()}
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 6, pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([row[c]], k) for c, k in zip(_STATS.names, kinds)], names=_STATS.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, gathered = None, Gathered()
        for r in _groups(batches, ["part", "kind", "keys", "counts"]):
            if (r["part"], r["kind"]) != now:
                if now is not None:
                    yield told(*now, gathered)
                now, gathered = (r["part"], r["kind"]), Gathered()
            counts = np.frombuffer(zstandard.decompress(r["counts"]), "<i8")
            keys = spread(r["keys"])
            gathered.add(keys[counts > 0], counts[counts > 0])
        if now is not None:
            yield told(*now, gathered)

    return run


def _upper_levels(stats: DataFrame) -> dict[int, Level]:
    """Depths 0 and 1: at most 256 x 255 nodes, however much was learned; summed over the parts one after the other."""
    one = {}
    nodes, sums = np.zeros(0, np.uint64), np.zeros((3, 0))
    for r in stats.filter("nodes IS NOT NULL").select("part", "nodes", "zeros", "ones", "weighted").orderBy("part").toLocalIterator():
        values = np.vstack([np.frombuffer(r[c], "<i8").astype(float) for c in ("zeros", "ones")] + [np.frombuffer(r["weighted"], "<f8")])
        both, columns = np.concatenate([nodes, np.frombuffer(r["nodes"], "<u8")]), np.hstack([sums, values])
        order = np.argsort(both, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(both[order]) != 0))
        nodes, sums = both[order][first], np.add.reduceat(columns[:, order], first, axis=1)
    one[1] = Level(nodes, sums[0].astype(np.int64), sums[1].astype(np.int64))
    one[1].weigh(sums[2])
    one[0] = one[1].up()
    one[0].weigh(np.bincount(one[1].parents(one[0]), weights=one[1].log_weighted, minlength=len(one[0].nodes)))
    return one


def _answerer(depth: int, shared):
    """Answers every packet: log10 probabilities of byte contexts, training counts of tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known, values, levels = None, np.zeros(0, np.uint64), np.zeros(0), None
        for r in _groups(batches, ["part", "kind", "turn", "block", "keys", "counts"]):
            if (r["part"], r["kind"]) != now:
                now, known, values, levels = (r["part"], r["kind"]), np.zeros(0, np.uint64), np.zeros(0), None
            keys = spread(r["keys"])
            if r["turn"] == 0:
                known = keys
                values = np.frombuffer(zstandard.decompress(r["counts"]), "<i8").astype(float)
                if r["kind"] == _GRAMS:
                    levels = grow(known, values.astype(np.int64), depth, 2) | shared.value
                    values = log10_probability(known, levels, depth)
                continue
            at = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
            seen = known[at] == keys if len(known) else np.zeros(len(keys), bool)
            answer = np.zeros(len(keys))
            answer[seen] = values[at[seen]]
            if r["kind"] == _GRAMS and not seen.all():
                levels = levels or grow(known, values.astype(np.int64), depth, 2) | shared.value
                answer[~seen] = log10_probability(keys[~seen], levels, depth)
            kind = "<f4" if r["kind"] == _GRAMS else "<i8"
            row = (r["block"], r["part"], r["kind"], r["keys"], zstandard.compress(answer.astype(kind).tobytes(), 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=_PACKET.names)

    return run


def _adder(depth: int, total: int, distinct: int):
    """Adds up a block's answers per text; they come before the texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, answers, tables, hashes = None, {}, {}, Hashes()
        for batch in batches:
            names = batch.schema.names
            blocks, kinds = batch.column(names.index("block")).to_pylist(), batch.column(names.index("kind")).to_pylist()
            keys, counts, bodies = (batch.column(names.index(c)) for c in ("keys", "counts", "body"))
            made, rows = [], []
            for k, (b, kind) in enumerate(zip(blocks, kinds)):
                if b != block:
                    block, answers, tables = b, {}, {}
                if kind != 9:
                    body = zstandard.decompress(counts[k].as_py())
                    answers.setdefault(kind, []).append((spread(keys[k].as_py()), np.frombuffer(body, "<f4" if kind == _GRAMS else "<i8")))
                    continue
                if not tables:
                    for which, found in answers.items():
                        order = np.argsort(all_keys := np.concatenate([x for x, _ in found]))
                        tables[which] = Answers(all_keys[order], np.concatenate([y for _, y in found])[order])
                    answers = {}
                body = bodies[k].as_py()
                score = sum(float(tables[_GRAMS].of(p).astype(float).sum()) for p in key_pieces([body], depth))
                seen = tables[_TOKENS].of(tokens_of(body, hashes))
                base = float(np.log10((seen + 1) / (total + distinct + 1)).sum())
                made.append((len(seen), int((seen > 0).sum()), total, base, score, -score * math.log2(10) / (len(body) + 1)))
                rows.append(k)
            if rows:
                columns = list(zip(*made))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(names.index("row")).take(pa.array(rows)), *[pa.array(c, pa.int64()) for c in columns[:3]], *[pa.array(c, pa.float64()) for c in columns[3:]]],
                    names=["row", *SCORES.names])

    return run

