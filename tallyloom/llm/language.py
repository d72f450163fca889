"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are byte n-grams inside words, with the spaces around them, hashed to
a fixed number of buckets. A text is the mean of its subwords' embeddings; a
softmax over a linear map of it gives the languages. Both are trained by
stochastic gradient descent in numpy on a bounded sample. A temperature is
fitted on a part of the sample kept apart; a guess is accepted if it then is
likelier than not (``least_score``), however many of the labels are wrong.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import appended, bounded_batches, fields

GUESS = fields(lang_pred="string", score="double", accepted="boolean")

_TABLE = np.full(256, 32, np.uint8)
_TABLE[97:123] = np.arange(97, 123)
_TABLE[65:91] = np.arange(97, 123)
_TABLE[128:] = np.arange(128, 256)


@dataclass(frozen=True)
class Settings:
    """``per_label`` bounds the sample: about that many rows of each language, picked by a hash of the row."""

    per_label: int = 400
    most_labels: int = 500
    bits: int = 15
    dim: int = 16
    sizes: tuple[int, ...] = (2, 3, 4)
    epochs: int = 8
    rate: float = 0.5
    calibration: float = 0.2
    least_score: float = 0.5
    seed: int = 7


def subwords(body: bytes, settings: Settings, piece: int = 1 << 20):
    """Bucket numbers of all subwords of a text, piece by piece."""
    edge = max(settings.sizes)
    padded = b" " + body + b" "
    for at in range(0, max(1, len(padded) - 1), piece):
        chars = _TABLE[np.frombuffer(padded[at:at + piece + edge - 1], np.uint8)]
        spaces = np.concatenate([[0], np.cumsum(chars == 32)])
        for n in settings.sizes:
            count = min(len(chars) - n + 1, piece)
            if count <= 0:
                continue
            hashes = np.full(count, n, np.uint32)
            for k in range(n):
                hashes = (hashes ^ chars[k:k + count]) * np.uint32(0x01000193)
            inside = spaces[n - 1:n - 1 + count] - spaces[1:1 + count]
            whole = spaces[n:n + count] - spaces[:count]
            hashes = (hashes * np.uint32(0x9E3779B1)) >> np.uint32(32 - settings.bits)
            yield hashes[(inside <= 0) & (whole < n)]


def counts_of(body: bytes, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    total = np.zeros(1 << settings.bits, np.int64)
    for hashes in subwords(body, settings):
        total += np.bincount(hashes, minlength=len(total))
    buckets = np.flatnonzero(total)
    return buckets.astype(np.int32), total[buckets]


@dataclass
class Model:
    settings: Settings
    labels: list[str]
    embeddings: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def __post_init__(self) -> None:
        #: the linear map applied to each bucket's embedding: averaging these gives the same logits
        self.table = (self.embeddings @ self.weights.T).astype(np.float32)

    def logits(self, body: bytes) -> np.ndarray:
        total, number = np.zeros(len(self.labels)), 0
        for hashes in subwords(body, self.settings):
            total += self.table[hashes].sum(axis=0, dtype=np.float64)
            number += len(hashes)
        return total / max(1, number) + self.bias

    def guess(self, body: bytes) -> tuple[str, float, bool]:
        p = softmax(self.logits(body) / self.temperature)
        best = int(np.argmax(p))
        return self.labels[best], float(p[best]), bool(p[best] >= self.threshold)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(samples: list[tuple[str, np.ndarray, np.ndarray]], settings: Settings) -> Model | None:
    """Gradient descent over (language, buckets, counts); None without samples."""
    labels = sorted({s[0] for s in samples})
    if not labels:
        return None
    random = np.random.default_rng(settings.seed)
    target = np.array([labels.index(s[0]) for s in samples])
    shares = [s[2] / max(1, s[2].sum()) for s in samples]
    order = random.permutation(len(samples))
    held = order[:int(len(samples) * settings.calibration)]
    fitted = order[len(held):]
    emb = random.uniform(-1 / settings.dim, 1 / settings.dim, (1 << settings.bits, settings.dim))
    weights, bias = np.zeros((len(labels), settings.dim)), np.zeros(len(labels))
    step, steps = 0, settings.epochs * len(fitted)
    for _ in range(settings.epochs):
        for k in random.permutation(fitted):
            rate = settings.rate * (1 - step / steps)
            step += 1
            buckets, share = samples[k][1], shares[k]
            mean = share @ emb[buckets]
            error = softmax(weights @ mean + bias)
            error[target[k]] -= 1
            back = weights.T @ error
            weights -= rate * np.outer(error, mean)
            bias -= 0.1 * rate * error
            # the mean spreads a step over many buckets; scaled up so that rare subwords move too
            emb[buckets] -= (rate * len(buckets) ** 0.5) * np.outer(share, back)
    model = Model(settings, labels, emb, weights, bias, threshold=settings.least_score if len(labels) > 1 else 0.0)
    if len(held):
        calibrate(model, np.array([shares[k] @ model.table[samples[k][1]] + bias for k in held]), target[held])
    return model


def calibrate(model: Model, logits: np.ndarray, target: np.ndarray) -> None:
    """The temperature of least log loss on the kept-apart rows."""
    rows = np.arange(len(target))
    scales = np.geomspace(0.05, 20, 60)
    model.temperature = float(min(scales, key=lambda t: -np.log(softmax(logits / t)[rows, target] + 1e-12).mean()))


def fit_languages(docs: DataFrame, usable: Column, lang: str = "lang", text: str = "text", key: str = "doc_id", settings: Settings = Settings()) -> Model | None:
    """Train on a sample of the rows where ``usable`` holds and the language is not null.

    The driver gets hashed subword counts of about ``per_label`` rows of each
    language, never texts: a size that does not grow with the documents.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(lang).alias("lang"), F.lower(text).alias("body"), F.xxhash64(F.col(key).cast("string")).alias("order"), usable.alias("usable"))
    rows = rows.filter("usable AND lang IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().orderBy("lang").limit(settings.most_labels + 1).collect()}
    if len(sizes) > settings.most_labels:
        raise ValueError(f"more than {settings.most_labels} languages")
    if not sizes:
        return None
    limits = F.create_map(*[F.lit(v) for name, n in sizes.items() for v in (name, int(min(1.0, settings.per_label / n) * (1 << 30)))])
    chosen = rows.filter(F.pmod("order", F.lit(1 << 30)) < limits[F.col("lang")])
    chosen = chosen.select(F.struct("lang", "order").alias("row"), F.coalesce("body", F.lit("")).cast("binary").alias("body"))

    def count(bodies: list[bytes]) -> list[pa.Array]:
        made = [counts_of(body, settings) for body in bodies]
        return [pa.array([m[0] for m in made], pa.list_(pa.int32())), pa.array([m[1] for m in made], pa.list_(pa.int64()))]

    sample = appended(chosen, ["body"], count, fields(buckets="list_int", counts="list_long")).toArrow().to_pydict()
    rows_ = [(r["lang"], r["order"], np.array(b, np.int32), np.array(c, np.int64)) for r, b, c in zip(sample["row"], sample["buckets"], sample["counts"])]
    rows_.sort(key=lambda r: (r[0], r[1], r[2].tobytes()))
    return train([(r[0], r[2], r[3]) for r in rows_ if len(r[2])], settings)


def identify(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row``, ``lang_pred``, ``score`` (calibrated probability) and ``accepted``; one row per input row, no shuffle.

    A null text or one without a letter is ``und`` with score 0, rejected, and
    so is everything where no language was learned. Equal texts get equal
    results; texts are read whole, in pieces of bounded size.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.columns if keep is None else keep
    frame = docs.select(
        F.struct(*[docs[c] for c in kept]).alias("row"), F.lower(docs[text]).cast("binary").alias("body"), F.coalesce(docs[text].rlike(r"\p{L}"), F.lit(False)).alias("letters"))

    def step(bodies: list[bytes | None], letters: list[bool]) -> list[pa.Array]:
        known = shared.value
        made = [known.guess(body) if known and ok else ("und", 0.0, False) for body, ok in zip(bodies, letters)]
        return [pa.array([m[k] for m in made], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]

    return appended(frame, ["body", "letters"], step, GUESS)


def keep_identified(docs: DataFrame, usable: Column, lang: str = "lang", text: str = "text", key: str = "doc_id", settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` whose language is accepted, with their columns."""
    return identify(docs, fit_languages(docs, usable, lang, text, key, settings), text).filter("accepted").select("row.*")
