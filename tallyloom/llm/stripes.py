"""Source divergence audit by in-mapper stripes.

Partitions fold whole documents into hash stripes, one per language and term:
the term's document frequency and its count per source. A task that holds too
much emits its stripes and starts anew; stripes of one key are merged after the
shuffle. Each merged stripe then gives its share of every divergence directly:
to the pairs of sources of which at least one has the term, and to the terms
that stand out in a source. Terms that neither source of a pair has all give
the same value, so they are counted, not visited.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import bounded_batches, fields
from tallyloom.plans.scratch import materialised

#: Lower-cases A-Z, keeps a-z and all bytes beyond ASCII, and turns the rest into spaces.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_STRIPES = fields(lang="string", term="binary", documents="long", sources="list_string", counts="list_long")
_PARTS = fields(lang="string", source="string", part="string", item="binary", value="long")
_KINDS = [pa.string(), pa.binary(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
_PART_KINDS = [pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64()]
#: The term of the stripe that lists a language's sources, with their numbers of documents.
_GROUPS = b""
SCALE = 1_000_000_000


def pieces(body: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """The text with terms set apart by spaces, in pieces of about ``size`` bytes that cut no term."""
    rest = b""
    for at in range(0, len(body), size):
        rest += body[at:at + size].translate(_TERMS)
        if at + size < len(body):
            cut = rest.rfind(b" ") + 1
            yield rest[:cut]
            rest = rest[cut:]
    yield rest


def term_counts(body: bytes) -> Counter[bytes]:
    found: Counter[bytes] = Counter()
    for piece in pieces(body):
        found.update(piece.split())
    return found


def share(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * counts / total)`` for counts up to the total, exactly: long division in three digits of a thousand."""
    counts, total = np.broadcast_arrays(np.asarray(counts, np.uint64), np.asarray(total, np.uint64))
    whole, rest = counts // total, counts % total
    for _ in range(3):
        rest = rest * np.uint64(1000)
        whole, rest = whole * np.uint64(1000) + rest // total, rest % total
    return whole.astype(np.int64) + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _fold(most: int):
    """Stripes of a task's documents, emitted whenever ``most`` cells are held and at the end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes: dict[str, dict[bytes, dict]] = {}
        held = 0
        for batch in batches:
            for lang, source, body in zip(*(batch.column(k).to_pylist() for k in range(3))):
                found = stripes.setdefault(lang, {})
                counts = term_counts(body)
                counts[_GROUPS] = 1
                for term, n in counts.items():
                    stripe = found.get(term)
                    if stripe is None:
                        found[term] = {None: 1, source: n}  # under None: the documents
                        held += 2
                    else:
                        stripe[None] += 1
                        if source in stripe:
                            stripe[source] += n
                        else:
                            stripe[source] = n
                            held += 1
                if held >= most:
                    yield from _emit(stripes)
                    stripes, held = {}, 0
        yield from _emit(stripes)

    return run


def _emit(stripes: dict[str, dict[bytes, dict]], rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    for lang, found in stripes.items():
        each = iter(found.items())
        while some := list(islice(each, rows)):
            documents = [stripe.pop(None) for _, stripe in some]
            columns = [[lang] * len(some), [t for t, _ in some], documents, [list(s) for _, s in some], [list(s.values()) for _, s in some]]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS)], names=_STRIPES.names)


def _merge(least: int):
    """Sums up stripes of equal key, which come one after the other; drops terms in fewer than ``least`` documents.

    The last key of a batch may go on in the next one, so its stripe, summed up so far, is carried over.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = None
        for batch in batches:
            rows = pa.Table.from_batches([b for b in (carried, batch) if b is not None]).combine_chunks().to_batches()
            for some in rows:
                closed, carried = _merged(some, least)
                yield closed
        if carried is not None and (carried.column(2)[0].as_py() >= least or carried.column(1)[0].as_py() == _GROUPS):
            yield carried

    return run


def _merged(rows: pa.RecordBatch, least: int) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """The kept stripes of all keys but the last, and the last key's stripe."""
    langs, terms, documents, sources, counts = rows.columns
    differs = pc.or_(pc.not_equal(langs[1:], langs[:-1]), pc.not_equal(terms[1:], terms[:-1])).to_numpy(zero_copy_only=False)
    first = np.flatnonzero(np.append(True, differs))
    summed = np.add.reduceat(documents.to_numpy(), first)
    kept = (summed >= least) | pc.equal(terms.take(pa.array(first)), _GROUPS).to_numpy(zero_copy_only=False)
    kept[-1] = True
    place = np.where(kept, np.cumsum(kept) - 1, -1)
    number = int(kept.sum())
    of_row = np.repeat(place, np.diff(np.append(first, len(rows))))
    of_cell = np.repeat(of_row, np.diff(sources.offsets.to_numpy()))
    mine = of_cell >= 0
    names = sources.flatten().dictionary_encode()
    width = len(names.dictionary)
    cells = of_cell[mine] * width + names.indices.to_numpy()[mine]
    order = np.argsort(cells, kind="stable")
    cells = cells[order]
    starts = np.flatnonzero(np.append(True, cells[1:] != cells[:-1]))
    totals = np.add.reduceat(counts.flatten().to_numpy()[mine][order], starts)
    cells = cells[starts]
    offsets = pa.array(np.searchsorted(cells, np.arange(number + 1) * width), pa.int32())
    at = pa.array(first[kept])
    made = pa.RecordBatch.from_arrays([
        langs.take(at), terms.take(at), pa.array(summed[kept]), pa.ListArray.from_arrays(offsets, names.dictionary.take(pa.array(cells % width))),
        pa.ListArray.from_arrays(offsets, pa.array(totals))], names=_STRIPES.names)
    return made.slice(0, number - 1), made.slice(number - 1)


@dataclass
class Groups:
    """A language's sources in order, the sums of their kept terms' counts, the tile of each, and the number of kept terms."""

    sources: list[str]
    sums: np.ndarray
    tiles: np.ndarray
    terms: int

    def __post_init__(self) -> None:
        self.place = {s: k for k, s in enumerate(self.sources)}
        self.totals = self.sums + 2 * self.terms
        if self.terms:
            #: the share of a term that a source does not have
            self.absent = share(2, self.totals)
            self.total = int(self.sums.sum()) + 2 * self.terms


def _contributions(shared, top: int, cells: int):
    """Each stripe's share of the pairs, beyond what an absent term gives, and the greatest terms of each source, per task.

    Rows of one (language, tile) come one after the other. Only the tile's
    sources are rows of the sums here; a pair that both tiles could count is
    counted at the source that comes first.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, known, mine, sums, best = None, None, [], None, {}

        def flush() -> Iterator[pa.RecordBatch]:
            if now is None:
                return
            for g, row in zip(mine, sums):
                at = np.flatnonzero(row)
                names = [known.sources[h].encode() for h in at]
                yield _rows(now[0], known.sources[g], "pair", names, row[at])
                yield _rows(now[0], known.sources[g], "term", [t for _, t in best[g]], [-v for v, _ in best[g]])

        for batch in batches:
            langs, tiles = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            for at, end in _stretches(langs, tiles):
                if (langs[at], tiles[at]) != now:
                    yield from flush()
                    now = (langs[at], tiles[at])
                    known = shared.value[now[0]]
                    mine = np.flatnonzero(known.tiles == now[1])
                    sums, best = np.zeros((len(mine), len(known.sources)), np.int64), {g: [] for g in mine}
                rows = max(1, cells // len(known.sources))
                for start in range(at, end, rows):
                    _add(batch.slice(start, min(rows, end - start)), known, mine, sums, best, top)
        yield from flush()

    return run


def _stretches(langs: list[str], tiles: np.ndarray) -> Iterator[tuple[int, int]]:
    at = 0
    for k in range(1, len(langs) + 1):
        if k == len(langs) or langs[k] != langs[at] or tiles[k] != tiles[at]:
            yield at, k
            at = k


def _add(batch: pa.RecordBatch, known: Groups, mine: np.ndarray, sums: np.ndarray, best: dict[int, list], top: int) -> None:
    terms, sources, counts = (batch.column(k) for k in (2, 3, 4))
    sizes = np.diff(sources.offsets.to_numpy())
    names = sources.flatten().dictionary_encode()
    place = np.array([known.place[s] for s in names.dictionary.to_pylist()])[names.indices.to_numpy()]
    have = np.zeros((len(terms), len(known.sources)), np.int64)
    have[np.repeat(np.arange(len(terms)), sizes), place] = counts.flatten().to_numpy()
    p = share(have + 2, known.totals)
    whole = share(have.sum(axis=1) + 2, known.total)
    for row, g in zip(sums, mine):
        rows = np.flatnonzero(have[:, g])
        gained = divergence(p[rows, g][:, None], p[rows]) - divergence(known.absent[g], known.absent)
        gained[:, :g][have[rows, :g] > 0] = 0
        gained[:, g] = 0
        row += gained.sum(axis=0)
        rows = rows[p[rows, g] > whole[rows]]
        values = divergence(p[rows, g], whole[rows])
        if len(values) > top:
            enough = values >= np.partition(values, -top)[-top]
            rows, values = rows[enough], values[enough]
        best[g] = sorted([*best[g], *((-int(v), terms[r].as_py()) for v, r in zip(values, rows))])[:top]


def _rows(lang: str, source: str, part: str, items: list[bytes], values) -> pa.RecordBatch:
    columns = [[lang] * len(items), [source] * len(items), [part] * len(items), items, values]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _PART_KINDS)], names=_PARTS.names)


def _baseline(shared):
    """What each pair has if no term of the language occurs in either source."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                known = shared.value[lang]
                g = known.place[source]
                later = known.sources[g + 1:]
                values = known.terms * divergence(known.absent[g], known.absent[g + 1:]) if known.terms else np.zeros(len(later), np.int64)
                yield _rows(lang, source, "pair", [s.encode() for s in later], values)

    return run


def merged_stripes(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_documents: int = 10, most_cells: int = 1_000_000) -> DataFrame:
    """One stripe per language and kept term: documents, sources and the term's count in each; the empty term lists a language's sources."""
    bounded_batches(docs.sparkSession)
    none = F.lit("")
    read = docs.select(F.coalesce(docs[lang], none).alias("lang"), F.coalesce(docs[source], none).alias("source"), F.coalesce(docs[text], none).cast("binary").alias("body"))
    folded = read.mapInArrow(_fold(most_cells), _STRIPES)
    return folded.repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(_merge(least_documents), _STRIPES)


def source_divergences(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_documents: int = 10, top: int = 10,
    most_cells: int = 1_000_000, tile_cells: int = 1_000_000,
) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: how far each source's use of terms is from others'.

    Null text, language and source are read as empty. A language keeps the
    terms in at least ``least_documents`` of its documents (rows; repeated ones
    count again). Part ``pair`` has every other source of the language, part
    ``term`` the ``top`` terms that the source uses more than the language;
    equal values rank by item. A language without kept terms has pairs of value
    0; an empty table gives an empty table. Columns of other names are not read.
    Texts of any length are folded whole, piece by piece.

    A task holds at most ``most_cells`` cells before it emits, and ``tile_cells``
    sums of pairs: languages with many sources are cut into tiles of sources.
    The table of groups goes through the driver to all tasks; the result has a
    row for every pair of a language's groups, so it is about the root of that.
    """
    spark = docs.sparkSession
    stripes = materialised(merged_stripes(docs, text, lang, source, least_documents, most_cells), "stripes")
    kept, listed = stripes.filter(F.length("term") > 0), stripes.filter(F.length("term") == 0)
    sizes = listed.select("lang", F.size("sources").alias("n"))
    tiled = {r["lang"]: -(-r["n"] * r["n"] // tile_cells) for r in sizes.filter(F.col("n").cast("long") * F.col("n") > tile_cells).collect()}
    number = F.coalesce(F.create_map(*[F.lit(v) for pair in tiled.items() for v in pair])[F.col("lang")], F.lit(1)) if tiled else F.lit(1)

    groups = listed.select("lang", F.explode("sources").alias("source"), F.lit(0).cast("long").alias("n"), number.alias("number"))
    cells = kept.select("lang", F.inline(F.arrays_zip("sources", "counts"))).groupBy("lang", F.col("sources").alias("source")).agg(F.sum("counts").alias("n"))
    sums = groups.join(cells, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce(cells["n"], groups["n"]).alias("n"), F.pmod(F.xxhash64("source"), F.col("number")).cast("int").alias("tile"))
    terms = {r["lang"]: r["count"] for r in kept.groupBy("lang").count().collect()}
    found: dict[str, list] = {}
    for r in sums.orderBy(F.col("source").cast("binary")).toLocalIterator():
        found.setdefault(r["lang"], []).append((r["source"], r["n"], r["tile"]))
    known = {k: Groups([s for s, _, _ in v], np.array([n for _, n, _ in v], np.int64), np.array([t for _, _, t in v]), terms.get(k, 0)) for k, v in found.items()}
    shared = spark.sparkContext.broadcast(known)

    tile = F.explode(F.array_distinct(F.transform("sources", lambda s: F.pmod(F.xxhash64(s), F.col("number")).cast("int")))).alias("tile")
    tiles = kept.withColumn("number", number).select("lang", tile, "term", "sources", "counts").sortWithinPartitions("lang", "tile")
    given = tiles.mapInArrow(_contributions(shared, top, tile_cells), _PARTS)
    base = groups.select("lang", "source").mapInArrow(_baseline(shared), _PARTS)
    parts = materialised(given.unionByName(base), "divergences")  # read twice below

    a, b = F.col("source"), F.col("item").cast("string")
    one = F.struct(F.when(a.cast("binary") < F.col("item"), a).otherwise(b).alias("a"), F.when(a.cast("binary") < F.col("item"), b).otherwise(a).alias("b"))
    pairs = parts.filter("part = 'pair'").select("lang", one.alias("pair"), "value").groupBy("lang", "pair").agg(F.sum("value").alias("value"))
    both = F.array(F.struct(F.col("pair.a").alias("source"), F.col("pair.b").alias("item")), F.struct(F.col("pair.b").alias("source"), F.col("pair.a").alias("item")))
    pairs = pairs.select("lang", F.inline(both), "value").select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    leading = parts.filter("part = 'term'").select("lang", "source", "part", F.col("item").cast("string").alias("item"), "value")
    # each task gives a source's greatest terms; they are cut again by a hash of the term before a source's come together
    salted = Window.partitionBy("lang", "source", F.pmod(F.xxhash64("item"), F.lit(32))).orderBy(F.desc("value"), F.asc("item"))
    leading = leading.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= top).drop("rank")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    ranked = pairs.unionByName(leading).withColumn("rank", F.row_number().over(order))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top))
