"""Benchmark decontamination: suffix arrays over shards of training text.

Each task strings documents together into shards of a bounded number of words,
sorts the suffixes of each shard and binary-searches every suffix of every
benchmark item in it. Found intervals give all verbatim occurrences with their
places; each is then extended to its longest match. Nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tallyloom.llm.common import TERM_BYTES, bounded_batches, fields, packed

_TERM = re.compile(TERM_BYTES)

FOUND = fields(
    n_words="long", hits=ArrayType(fields(start="long", end="long")), items="list_string", longest="long", longest_item="string", longest_start="long",
)
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def terms(body: bytes | None) -> list[bytes]:
    return _TERM.findall(body.lower()) if body else []


class TestSuffixes:
    """Every suffix of every item that starts a window, as packed search keys."""

    __test__ = False

    def __init__(self, items: list[tuple[str | None, bytes | None]], window: int):
        self.window, self.names = window, sorted({i for i, _ in items if i is not None})
        number = {name: k for k, name in enumerate(self.names)}
        self.vocabulary: dict[bytes, int] = {}
        words, starts, widths, owners = [], [], [], []
        for name, body in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in terms(body)]
            width = min(window, len(ids))
            if ids:
                here = range(len(words), len(words) + len(ids) - width + 1)
                starts += here
                widths += [width] * len(here)
                owners += [number.get(name, -1)] * len(here)
                words += [*ids, 0]
        self.bits = max(1, len(self.vocabulary).bit_length())
        self.words = np.array(words + [0] * (window + 64), np.int64)
        self.starts, self.widths, self.owners = np.array(starts, np.int64), np.array(widths, np.int64), np.array(owners, np.int64)
        self.shortest = int(self.widths.min()) if starts else 0
        top = (1 << self.bits) - 1
        self.low = self.keys(self.words, self.starts, self.widths, 0)
        self.high = self.keys(self.words, self.starts, self.widths, top)

    def keys(self, words: np.ndarray, starts: np.ndarray, widths: np.ndarray | None = None, fill: int = 0) -> list[np.ndarray]:
        """The first ``window`` words at each start, packed into unsigned integers that sort as the words do."""
        per_key = 63 // self.bits
        out = []
        for first in range(0, self.window, per_key):
            key = np.zeros(len(starts), np.int64)
            for k in range(first, first + per_key):
                word = words[starts + k] if k < self.window else np.zeros(len(starts), np.int64)
                if widths is not None:
                    word = np.where(k < widths, word, fill)
                key = key << self.bits | word
            out.append(key)
        return out


def suffix_array(words: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, list[np.ndarray]]:
    """Starts of the shard's suffixes in sorted order, with their keys.

    A suffix can match only if the shortest window's worth of words at its
    start is known to the benchmark; the others need no place in the array.
    """
    run = np.cumsum(words == 0)
    starts = np.flatnonzero(words[: len(words) - tests.window])
    starts = starts[run[starts + tests.shortest - 1] == run[starts]]
    keys = tests.keys(words, starts)
    order = np.lexsort(keys[::-1])
    return starts[order], [k[order] for k in keys]


def first_not_below(keys: list[np.ndarray], wanted: list[np.ndarray], beyond: bool) -> np.ndarray:
    """Binary search of all wanted keys at once: first place whose key is not below (or, ``beyond``, is above)."""
    low, high = np.zeros(len(wanted[0]), np.int64), np.full(len(wanted[0]), len(keys[0]), np.int64)
    while (open_ := low < high).any():
        middle = np.minimum((low + high) // 2, len(keys[0]) - 1)
        below, tied = np.zeros(len(low), bool), np.ones(len(low), bool)
        for have, want in zip(keys, wanted):
            at = have[middle]
            below |= tied & (at < want)
            tied &= at == want
        if beyond:
            below |= tied
        low, high = np.where(open_ & below, middle + 1, low), np.where(open_ & ~below, middle, high)
    return low


def occurrences(words: np.ndarray, tests: TestSuffixes) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place in the shard, number of the test suffix) of all verbatim window matches."""
    if not tests.shortest:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    array, keys = suffix_array(words, tests)
    if not len(array):
        return array, array
    first, last = first_not_below(keys, tests.low, False), first_not_below(keys, tests.high, True)
    counts = np.maximum(last - first, 0)
    suffixes = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(suffixes)) - np.repeat(np.cumsum(counts) - counts, counts)
    return array[first[suffixes] + within], suffixes


def longest_matches(words: np.ndarray, tests: TestSuffixes, places: np.ndarray, suffixes: np.ndarray) -> np.ndarray:
    """Length of each match, carried on word by word as far as both sides agree."""
    lengths = tests.widths[suffixes].copy()
    going = np.arange(len(places))
    while len(going):
        a, b = places[going] + lengths[going], tests.starts[suffixes[going]] + lengths[going]
        same = words[np.minimum(a, len(words) - 1)] == tests.words[np.minimum(b, len(tests.words) - 1)]
        same &= tests.words[np.minimum(b, len(tests.words) - 1)] > 0
        going = going[same]
        lengths[going] += 1
    return lengths


def search_shard(documents: list[list[int]], tests: TestSuffixes) -> list[tuple[list[tuple[int, int]], list[str], int, str | None, int | None]]:
    """Per document: hit spans, names of the items found, and the longest match with its item and place."""
    offsets = np.cumsum([0, *[len(d) + 1 for d in documents]])
    words = np.zeros(offsets[-1] + tests.window + tests.shortest + 1, np.int64)
    for start, ids in zip(offsets, documents):
        words[start:start + len(ids)] = ids
    places, suffixes = occurrences(words, tests)
    lengths = longest_matches(words, tests, places, suffixes)
    owner = np.searchsorted(offsets, places, side="right") - 1
    order = np.lexsort((places, owner))
    places, suffixes, lengths, owner = places[order], suffixes[order], lengths[order], owner[order]
    bounds = np.searchsorted(owner, np.arange(len(documents) + 1))
    out = []
    for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
        if a == b:
            out.append(([], [], 0, None, None))
            continue
        starts = places[a:b] - offsets[k]
        ends = np.maximum.accumulate(starts + tests.widths[suffixes[a:b]])
        cut = np.flatnonzero(np.append(True, starts[1:] > ends[:-1]))
        spans = list(zip(starts[cut].tolist(), ends[np.append(cut[1:] - 1, len(ends) - 1)].tolist()))
        names = [tests.names[i] for i in np.unique(tests.owners[suffixes[a:b]]) if i >= 0]
        best = np.lexsort((tests.owners[suffixes[a:b]], starts, -lengths[a:b]))[0]
        item = tests.owners[suffixes[a + best]]
        out.append((spans, names, int(lengths[a + best]), tests.names[item] if item >= 0 else None, int(starts[best])))
    return out


def merged(old: list[dict], new: list[tuple[int, int]]) -> list[tuple[int, int]]:
    spans: list[tuple[int, int]] = []
    for start, end in sorted([(s["start"], s["end"]) for s in old] + new):
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    return spans


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", keep: list[str] | None = None,
    window: int = 10, shard_words: int = 1_000_000, block_bytes: int = 16_000_000,
) -> DataFrame:
    """``row``, ``n_words``, ``hits`` (word spans covered by windows), ``items`` (ids found, sorted as text) and the longest match.

    One row per input row. The benchmark goes to the tasks in blocks of at most
    about ``block_bytes`` of text (one item at least); each block is searched
    in the same pass over the documents, so a larger benchmark only adds
    blocks. Null and empty texts have no words and match nothing; an item
    without words is never found; an item of fewer words than the window is one
    window; an item whose id is null is searched but not named. Repeated items
    and repeated documents are all reported.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    items = benchmark.select(benchmark[item_id].cast("string").alias("name"), benchmark[item_text].cast("binary").alias("body")).filter("length(body) > 0")
    size = items.agg(F.sum(F.length("body"))).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    frame = packed(docs, text, keep)
    frame = frame.select("row", "body", *[F.lit(None).cast(f.dataType).alias(f.name) for f in FOUND])
    for block in range(blocks):
        part = items if blocks == 1 else items.filter(F.pmod(F.xxhash64("name", "body"), F.lit(blocks)) == block)
        tests = spark.sparkContext.broadcast(TestSuffixes([(r.name, bytes(r.body)) for r in part.toLocalIterator()], window))
        frame = frame.mapInArrow(_searcher(tests, shard_words), frame.schema)
    return frame.drop("body")


def _searcher(broadcast, shard_words: int):
    def flush(batches: list[pa.RecordBatch], documents: list[list[int]]) -> Iterator[pa.RecordBatch]:
        found = search_shard(documents, broadcast.value)
        at = 0
        for batch in batches:
            mine, sizes = found[at:at + batch.num_rows], [len(d) for d in documents[at:at + batch.num_rows]]
            at += batch.num_rows
            old = {c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in FOUND.names}
            better = [m[2] > (o or 0) for m, o in zip(mine, old["longest"])]
            pick = lambda k, name: [m[k] if b else o for m, b, o in zip(mine, better, old[name])]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                pa.array([[{"start": s, "end": e} for s, e in merged(o or [], m[0])] for m, o in zip(mine, old["hits"])], _SPANS),
                pa.array([sorted({*m[1], *(o or [])}) for m, o in zip(mine, old["items"])], pa.list_(pa.string())),
                pa.array([b or 0 for b in pick(2, "longest")], pa.int64()), pa.array(pick(3, "longest_item"), pa.string()), pa.array(pick(4, "longest_start"), pa.int64()),
            ], names=["row", "body", *FOUND.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = broadcast.value.vocabulary.get
        held: list[pa.RecordBatch] = []
        documents: list[list[int]] = []
        words = 0
        for batch in batches:
            held.append(batch)
            for body in batch.column(1).to_pylist():
                documents.append(np.fromiter([known(w, 0) for w in terms(body)], np.int32))
                words += len(documents[-1])
            if words >= shard_words:
                yield from flush(held, documents)
                held, documents, words = [], [], 0
        if held:
            yield from flush(held, documents)

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = 10) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, with their columns."""
    return find_benchmark(docs, benchmark, text, window=window).filter("size(hits) = 0").select("row.*")
