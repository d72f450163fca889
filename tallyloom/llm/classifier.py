"""Quality classifier: boosted trees over statistics of the whole document.

Statistics tell of letters, signs, the shapes of words and lines, and
repetition, over the whole text and in its worst and best stretch of words, so
that a text which is junk in part is seen as well. The trees are trained on a
bounded sample of labelled rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.boosting import Forest, Growth, train
from tallyloom.llm.common import bounded_batches, fields, per_document

SCORE = fields(score="double", predicted="int")
_STATISTICS = fields(statistics="list_double")

_CLASSES = ("upper", "lower", "digit", "space", "line", "stop", "loud", "sign", "pipe", "quote", "other", "beyond")
_CLASS = np.full(256, _CLASSES.index("other"), np.uint8)
for _name, _bytes in {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "space": b" \t\r\x0b\x0c", "line": b"\n", "stop": b".,;:", "loud": b"!?",
    "sign": b"#*$%&<>@^~=+", "pipe": b"|/\\", "quote": b"\"'()[]{}-_", "beyond": range(128, 256),
}.items():
    _CLASS[list(_bytes)] = _CLASSES.index(_name)
_IS = {c: np.arange(len(_CLASSES)) == k for k, c in enumerate(_CLASSES)}
_BLANK, _LETTER = _IS["space"] | _IS["line"], _IS["upper"] | _IS["lower"] | _IS["beyond"]
_STRETCH = 40
#: Per word: all its letters are capitals, it has a sign, it is a bar, it has a loud mark, repeats the word before, is new in the text, has no letter, has a digit.
_FLAGS = ("capital", "sign", "bar", "loud", "same", "new", "bare", "digit")
STATISTICS = (
    "blank", *(f"bytes_{c}" for c in _CLASSES), "log_words", "word_size", "word_spread", "long_words", "short_words", "distinct", "log_distinct", "top_word", "top_pair",
    "repeated_pairs", *(f"words_{f}" for f in _FLAGS), *(f"worst_{f}" for f in _FLAGS), *(f"best_{f}" for f in _FLAGS), "upper_starts", "letter_ends",
    "words_a_stop", "words_a_line", "repeated_lines", "top_line", "single_words", "ratio",
)


def statistics(body: bytes, compressor) -> np.ndarray:
    """Numbers of a whole text, in the order of ``STATISTICS``; without words all but the first are 0."""
    out = np.zeros(len(STATISTICS))
    words = body.split()
    n = len(words)
    if not n:
        out[0] = 1 + (len(body) > 0)
        return out
    classes = _CLASS[np.frombuffer(body, np.uint8)]
    edges = np.diff(np.concatenate([[True], _BLANK[classes], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges < 0), np.flatnonzero(edges > 0)
    sizes = ends - starts
    first, last = classes[starts], classes[ends - 1]

    def in_words(of: np.ndarray) -> np.ndarray:
        summed = np.cumsum(of[classes], dtype=np.int32)
        return summed[ends - 1] - summed[starts] + of[first]

    uppers, signs, bars, louds, digits = (in_words(_IS[c]) for c in ("upper", "sign", "pipe", "loud", "digit"))
    lettered = in_words(_LETTER)
    ids = pa.array(words, pa.large_binary()).dictionary_encode().indices.to_numpy().astype(np.int64)
    counts = np.bincount(ids)
    pairs = np.unique(ids[:-1] * len(counts) + ids[1:], return_counts=True)[1]
    same, new = np.zeros(n, bool), np.zeros(n, bool)
    same[1:] = ids[1:] == ids[:-1]
    new[np.unique(ids, return_index=True)[1]] = True
    flags = np.column_stack([(uppers == lettered) & (lettered > 1), signs > 0, (bars > 0) & (lettered == 0), louds > 0, same, new, lettered == 0, digits > 0]).astype(float)
    cut = np.arange(0, max(1, n - _STRETCH + 1), _STRETCH)  # the last stretch takes what is left
    parts = np.add.reduceat(flags, cut, axis=0) / np.diff(np.append(cut, n))[:, None]
    lines = Counter(line for line in body.split(b"\n") if line and not line.isspace())
    n_lines = lines.total()
    out[1:] = [
        *np.bincount(classes, minlength=len(_CLASSES)) / len(body), np.log1p(n), sizes.mean(), sizes.std(), (sizes > 12).mean(), (sizes < 3).mean(),
        len(counts) / n, np.log1p(len(counts)) / np.log1p(n), counts.max() / n, pairs.max(initial=0) / n, 1 - len(pairs) / max(1, n - 1),
        *flags.mean(axis=0), *parts.max(axis=0), *parts.min(axis=0), _IS["upper"][first].mean(), _LETTER[last].mean(),
        n / max(1, int(_IS["stop"][last].sum())), n / n_lines, 1 - len(lines) / n_lines, max(lines.values()) / n_lines,
        (counts == 1).sum() / n, len(body) / len(compressor.compress(body)),
    ]
    return out


def _measured(bodies: list[bytes | None]) -> np.ndarray:
    compressor = zstandard.ZstdCompressor(level=1)
    return np.array([statistics(body or b"", compressor) for body in bodies]).reshape(len(bodies), len(STATISTICS))


def fit_classifier(
    docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", key: str = "doc_id", text: str = "text", per_label: int = 20_000, growth: Growth = Growth(),
) -> Forest:
    """Trains on labelled documents where ``usable``, a condition on the labels' rows, holds.

    The sample has about ``per_label`` documents of each label, picked by a hash
    of the key; rows weigh as much as they stand for. Labels other than 0 and 1
    and null keys are left out, labels that repeat count once; of documents with
    equal keys one is taken. Only the sample's statistics, never texts, reach
    the driver: a size that does not grow with the documents.
    """
    bounded_batches(docs.sparkSession)
    known = labels.filter(usable).select(labels[key].alias("key"), labels[label].cast("int").alias("label")).filter("key IS NOT NULL AND label IN (0, 1)").distinct()
    sizes = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    limits = F.when(F.lit(False), F.lit(0))
    for value, size in sizes.items():
        limits = limits.when(F.col("label") == value, F.lit(int(min(1.0, per_label / size) * (1 << 30))))
    chosen = known.filter(F.pmod(F.xxhash64(F.col("key").cast("string")), F.lit(1 << 30)) < limits)
    texts = docs.select(docs[key].alias("key"), docs[text].alias("text")).join(F.broadcast(chosen), "key")  # about per_label rows a label

    def measure(bodies: list[bytes | None]) -> list[pa.Array]:
        return [pa.array(_measured(bodies).tolist(), pa.list_(pa.float64()))]

    measured = per_document(texts, measure, _STATISTICS, "text", ["key", "label"])
    sample = measured.groupBy("row").agg(F.min("statistics").alias("statistics")).select("row.*", "statistics").toArrow().to_pydict()
    if not sample["key"]:
        return train(np.zeros((0, len(STATISTICS))), np.zeros(0), np.zeros(0), growth)
    order = sorted(range(len(sample["key"])), key=lambda k: (str(sample["key"][k]), sample["label"][k]))
    rows, marks = np.array(sample["statistics"])[order], np.array(sample["label"])[order]
    random = np.random.default_rng(7).permutation(len(order))
    stands = {value: sizes[value] / max(1, int((marks == value).sum())) for value in sizes}
    weights = np.array([stands[m] for m in marks.tolist()])
    return train(rows[random], marks[random], (weights / weights.mean())[random], growth)


def score_quality(docs: DataFrame, forest: Forest, text: str = "text", keep: list[str] | None = None, least_score: float = 0.5) -> DataFrame:
    """``row``, ``score`` (probability of label 1) and ``predicted`` (1 from ``least_score`` on), one row per input row, no shuffle.

    Only the text is read. Null counts as empty, empty and blank texts get what
    the trees say of them; equal texts get equal scores; a forest trained on
    nothing gives 0.5; an empty table gives an empty table; other columns
    stay inside ``row``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(forest)

    def step(bodies: list[bytes | None]) -> list[pa.Array]:
        scores = shared.value.probabilities(_measured(bodies))
        return [pa.array(scores, pa.float64()), pa.array((scores >= least_score).astype(np.int32), pa.int32())]

    return per_document(docs, step, SCORE, text, keep)
