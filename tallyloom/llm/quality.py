"""Quality rules: compression bands.

Zstandard ratios of the whole document and of its fixed chunks must lie in a
band that depends on the length: a ratio above it means repetition, one below
it text that does not compress (encoded or random data). Fixed outer limits
hold everywhere; within them, the ratios usual at each length are learned from
all documents that pass the base rules.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import fields, per_document

_SPACE = b" \t\n\r\x0b\x0c"
_CONTINUATION = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"

FEATURES = fields(
    n_words="long", word_chars="long", n_symbols="long", n_dup_lines="long", n_repeat_words="long", base_failed="boolean",
    ratio="double", n_chunks="long", n_bad_chunks="long", kept="boolean",
)


@dataclass(frozen=True)
class Bands:
    """Limits of raw bytes over compressed bytes.

    ``whole``: (bytes from which it holds, least ratio, greatest ratio), rising.
    ``chunk``: least and greatest ratio of one chunk of ``chunk_bytes``; a last
    chunk of less than half that size joins its neighbour. A document fails if
    more than ``bad_share`` of its chunks lie outside. Short texts compress
    badly and long ones well, hence the rising limits.

    ``curve``: (log2 of bytes, usual log ratio, its robust deviation), rising; see
    ``fit_bands``. A text or chunk between its ends may lie up to ``above``
    deviations over the curve and ``below`` under it; beyond the ends, or
    without a curve, only the fixed limits hold.
    """

    whole: tuple[tuple[int, float, float], ...] = ((0, 0.0, 3.5), (256, 1.1, 3.5), (1024, 1.2, 3.5), (4096, 1.3, 4.0), (16384, 1.4, 4.5), (65536, 1.4, 5.0))
    chunk: tuple[float, float] = (1.2, 4.0)
    chunk_bytes: int = 4096
    bad_share: float = 0.25
    level: int = 3
    least_words: int = 50
    repeat_percent: int = 50
    curve: tuple[tuple[float, float, float], ...] = ()
    above: float = 3.5
    below: float = 4.5
    per_octave: int = 2
    least_documents: int = 30
    least_deviation: float = 0.02

    def usual(self, size: int, ratio: float) -> bool:
        """Whether the ratio is usual for a text of this size."""
        if not self.curve:
            return True
        at = math.log2(size)
        sizes, middles, deviations = zip(*self.curve)
        reach = 0.5 / self.per_octave
        if not sizes[0] - reach <= at < sizes[-1] + reach:
            return True
        off = (math.log(ratio) - np.interp(at, sizes, middles)) / np.interp(at, sizes, deviations)
        return bool(-self.below <= off <= self.above)


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur at least twice."""
    n = len(words)
    if n < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, n)
    _, pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)
    _, windows, counts = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[windows] > 1)
    hit = np.zeros(n, bool)
    for k in range(3):
        hit[starts + k] = True
    return int(hit.sum())


def duplicate_lines(body: bytes) -> int:
    seen: set[bytes] = set()
    found = 0
    for line in body.split(b"\n"):
        if line and not line.isspace():
            if line in seen:
                found += 1
            else:
                seen.add(line)
    return found


def chunks_of(body: bytes, size: int) -> list[bytes]:
    cuts = list(range(0, len(body), size)) or [0]
    if len(cuts) > 1 and len(body) - cuts[-1] < size // 2:
        cuts.pop()
    return [body[a:b] for a, b in zip(cuts, [*cuts[1:], len(body)])]


def verdict(body: bytes, bands: Bands, compressor) -> tuple[float, int, int, bool]:
    """Ratio, chunks, chunks outside their band, and whether the text passes."""
    if not body:
        return 0.0, 0, 0, False
    ratio = len(body) / len(compressor.compress(body))
    _, low, high = next(b for b in reversed(bands.whole) if len(body) >= b[0])
    passed = low <= ratio <= high and bands.usual(len(body), ratio)
    chunks = bad = 0
    if len(body) >= bands.chunk_bytes:
        low, high = bands.chunk
        for chunk in chunks_of(body, bands.chunk_bytes):
            chunks += 1
            part = len(chunk) / len(compressor.compress(chunk))
            bad += not (low <= part <= high and bands.usual(len(chunk), part))
    return ratio, chunks, bad, passed and bad <= bands.bad_share * chunks


def base_fails(words: list[bytes], bands: Bands) -> tuple[int, bool]:
    """Repeated words, and whether the text fails the base rules."""
    repeats = repeated_words(words)
    return repeats, len(words) < bands.least_words or 100 * repeats > bands.repeat_percent * len(words)


def measure(bodies: list[bytes | None], bands: Bands) -> list[pa.Array]:
    compressor = zstandard.ZstdCompressor(level=bands.level)
    rows = []
    for body in bodies:
        body = body or b""
        words = body.split()
        repeats, failed = base_fails(words, bands)
        ratio, chunks, bad, passed = verdict(body, bands, compressor)
        rows.append((
            len(words), len(body.translate(None, _SPACE + _CONTINUATION)), len(body) - len(body.translate(None, _SYMBOLS)),
            duplicate_lines(body), repeats, failed, ratio, chunks, bad, passed and not failed,
        ))
    columns = list(zip(*rows)) if rows else [[]] * len(FEATURES)
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    return [pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(columns, FEATURES)]


_STEP, _LEAST, _MOST = 0.005, -1.0, 4.0
_RATIOS = fields(n_bytes="long", log_ratio="double")


def fit_bands(docs: DataFrame, text: str = "text", bands: Bands = Bands()) -> Bands:
    """``bands`` with the curve of all documents that pass the base rules, by length class (``per_octave`` to a doubling).

    Each class gives the median of its log ratios and their median distance
    from it (times 1.4826, at least ``least_deviation``); both stay put while
    fewer than half of a class are bad. Copies count once (a sketch of distinct
    texts). Classes below ``least_documents`` give no point; a gap between points is
    interpolated. The driver gets one row per class and step of the log
    ratio, at most a thousand steps a class.
    """
    def step(bodies: list[bytes | None]) -> list[pa.Array]:
        compressor = zstandard.ZstdCompressor(level=bands.level)
        sizes, ratios = [], []
        for body in bodies:
            body = body or b""
            failed = base_fails(body.split(), bands)[1]
            sizes.append(None if failed else len(body))
            ratios.append(None if failed else math.log(len(body) / len(compressor.compress(body))))
        return [pa.array(sizes, pa.int64()), pa.array(ratios, pa.float64())]

    hashed = docs.select(docs[text].alias("text"), F.xxhash64(docs[text]).alias("hash"))
    measured = per_document(hashed, step, _RATIOS, "text", ["hash"]).filter("n_bytes IS NOT NULL")
    counted = measured.groupBy(
        F.floor(F.log2("n_bytes") * bands.per_octave).cast("int").alias("size"),
        F.floor(F.least(F.greatest("log_ratio", F.lit(_LEAST)), F.lit(_MOST)) / _STEP).cast("int").alias("ratio"),
    ).agg(F.approx_count_distinct("row.hash").alias("n"))
    classes: dict[int, list[tuple[float, int]]] = {}
    for r in counted.collect():
        classes.setdefault(r["size"], []).append(((r["ratio"] + 0.5) * _STEP, r["n"]))
    curve = []
    for size, found in sorted(classes.items()):
        if sum(n for _, n in found) >= bands.least_documents:
            middle = weighted_median(found)
            deviation = 1.4826 * weighted_median([(abs(x - middle), n) for x, n in found])
            curve.append(((size + 0.5) / bands.per_octave, middle, max(deviation, bands.least_deviation)))
    return replace(bands, curve=tuple(curve))


def weighted_median(found: list[tuple[float, int]]) -> float:
    found = sorted(found)
    reached = np.cumsum([n for _, n in found])
    return found[int(np.searchsorted(reached, reached[-1] / 2))][0]


def quality_features(docs: DataFrame, text: str = "text", keep: list[str] | None = None, bands: Bands | None = None) -> DataFrame:
    """``row`` (the input, or its columns in ``keep``) and the features with the verdict ``kept``, one row per input row.

    Null and empty texts have no words and fail; rows that repeat are judged
    alike; an empty table gives an empty table; columns of any other name stay
    inside ``row``. Without ``bands`` they are learned from ``docs`` in a pass of
    their own, which shuffles counts only; each text is judged where it is read.
    """
    bands = fit_bands(docs, text) if bands is None else bands
    return per_document(docs, lambda bodies: measure(bodies, bands), FEATURES, text, keep)


def keep_quality(docs: DataFrame, text: str = "text", bands: Bands | None = None) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns."""
    return quality_features(docs, text, None, bands).filter("kept").select("row.*")
