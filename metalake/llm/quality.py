"""Quality by ordinal cumulative-link regression on graded ratings.

Grades are ordered: 0 toxic, 1 low quality, 2 good. One vector of weights over hashed words and a few text measures is
shared by all grades; P(grade <= k) = sigmoid(threshold_k - w.x) with ordered thresholds. Each document gets its expected grade and the tail probabilities
P(grade >= 1) and P(grade >= 2); it is kept if both reach a limit.

The model is fitted on a bounded sample of at most about `SAMPLE` rated documents, whose words are taken in full; they are
hashed where the documents are, and the driver gets the hashes alone. Three quarters give the weights, the last quarter the limits, which about the shares `LOST` of its good documents miss.

Null and empty texts have no words and get whatever the measures say of an empty text: grade as of no evidence, not kept.
Ratings that are null, or whose document isn't there, are left out; without any rating all documents are kept with grade 2.
Repeated rows and further columns change nothing (of several texts of one doc_id, one counts in the fit); an empty table gives an empty result.
Regularisation: a ridge, and words whose documents' grades differ from the rest by less than `SURE` standard errors keep the weight 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, chunks, materialize, release, set_aside, thrifty, utf8, word_hashes

BITS = 18
SAMPLE = 8_000
LOST = (0.003, 0.005)
STEPS, RATE, RIDGE = 200, 0.1, 1e-4
LEAST_DOCS, SURE = 8, 6.0
AT_ONCE = 1 << 20

_BREAKS = np.ones(256, dtype=bool)
_BREAKS[65:91] = _BREAKS[97:123] = _BREAKS[128:] = False
_LETTERS = bytes(np.flatnonzero(~_BREAKS).tolist())
_SIGNS = b"%&*#$@^~=<>{}[]_\\"
_MEASURES = 7


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashed words of each text, as one array with starts, and its measures."""
    words, first = word_hashes(texts, 11, _BREAKS)
    slots = (words >> U64(64 - BITS)).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    keys = np.unique((owner << BITS) | slots)
    starts = np.searchsorted(keys, np.arange(len(texts) + 1) << BITS)
    n = np.diff(first).astype(float)
    size = np.fromiter(map(len, texts), float, len(texts))
    letters = np.array([len(t) - len(t.translate(None, _LETTERS)) for t in texts], float)
    signs = np.array([len(t) - len(t.translate(None, _SIGNS)) for t in texts], float)
    bars = np.array([t.count(b"|") for t in texts], float)
    again = np.zeros(len(words) + 1)
    if len(words):
        np.cumsum((words[1:] == words[:-1]) & (owner[1:] == owner[:-1]), out=again[2:])
    some = np.maximum(n, 1)
    m = np.stack([
        np.log1p(n) / 3,
        np.log(np.diff(starts) + 1) / np.log(some + 1.7),
        letters / np.maximum(size, 1),
        np.log1p(9 * np.minimum(bars / some, 1)),
        np.log1p(3 * np.minimum(signs / some, 3)),
        np.log1p(9 * (again[first[1:]] - again[first[:-1]]) / some),
        np.minimum(letters / some, 40) / 10,
    ], axis=1) if len(texts) else np.zeros((0, _MEASURES))
    return keys & ((1 << BITS) - 1), starts, m


Features = tuple[np.ndarray, np.ndarray, np.ndarray]


def _pick(f: Features, which: np.ndarray) -> Features:
    """The features of the chosen texts."""
    slots, starts, m = f
    size = np.diff(starts)
    return slots[np.repeat(which, size)], np.concatenate(([0], np.cumsum(size[which]))), m[which]


@dataclass
class Model:
    weights: np.ndarray
    measures: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    thresholds: np.ndarray
    least: tuple[float, float]

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2) of each text."""
        out = np.zeros((len(texts), 2))
        for i, j in chunks(map(len, texts), AT_ONCE):
            out[i:j] = self.tails(features(texts[i:j]))
        return out

    def tails(self, f: Features) -> np.ndarray:
        slots, starts, m = f
        return self._tails(_sums(self.weights[slots], starts) + ((m - self.mean) / self.scale) @ self.measures)

    def _tails(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - z[:, None], -500, 500)))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[starts[1:]] - total[starts[:-1]]


def train(rated: Features, grades: np.ndarray) -> Model:
    """Weights from three of four rated texts, limits from the others."""
    held = np.arange(len(grades)) % 4 == 3
    model = _weights(_pick(rated, ~held), grades[~held])
    good = model.tails(_pick(rated, held & (grades == 2)))
    model.least = tuple(float(np.quantile(good[:, k], LOST[k])) if len(good) >= 50 else 0.5 for k in (0, 1))
    return model


def _telling(slots: np.ndarray, graded: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """Whether the documents with each slot differ in grade from the rest by SURE standard errors, at either threshold; other words' weights stay 0."""
    out = np.zeros(1 << BITS, dtype=bool)
    all_ = np.bincount(slots, minlength=1 << BITS)
    for k in (1, 2):
        n1, n0 = max(1, np.count_nonzero(grades >= k)), max(1, np.count_nonzero(grades < k))
        c1 = np.bincount(slots[graded >= k], minlength=1 << BITS)
        p = all_ / (n1 + n0)
        z = (c1 / n1 - (all_ - c1) / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
        out |= (all_ >= LEAST_DOCS) & (np.abs(z) >= SURE)
    return out


def loss(p: np.ndarray, slots: np.ndarray, starts: np.ndarray, x: np.ndarray, grades: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The weighted negative log likelihood with its ridge, and its gradient, at p: word weights, measure weights, lower threshold, log of the gap to the upper."""
    d, n = len(p) - x.shape[1] - 2, len(grades)
    own = p[: d + x.shape[1]]
    z = _sums(p[slots], starts) + x @ p[d : d + x.shape[1]]
    lo, hi = p[-2], p[-2] + np.exp(p[-1])
    with np.errstate(over="ignore"):
        s0, s1 = 1 / (1 + np.exp(z - lo)), 1 / (1 + np.exp(z - hi))  # P(<= 0), P(<= 1)
    like = np.choose(grades, [s0, s1 - s0, 1 - s1]).clip(1e-9)
    d0, d1 = s0 * (1 - s0), s1 * (1 - s1)
    g0 = np.choose(grades, [d0, -d0, np.zeros(n)]) / like * weight  # of the log likelihood by the lower threshold
    g1 = np.choose(grades, [np.zeros(n), d1, -d1]) / like * weight
    gz = g0 + g1  # the score enters both with the opposite sign
    grad = np.concatenate((np.bincount(slots, weights=np.repeat(gz, np.diff(starts)), minlength=d), x.T @ gz, [-gz.sum(), -(g1 * np.exp(p[-1])).sum()]))
    grad[: len(own)] += RIDGE * own / 10
    return float(RIDGE * (own @ own) / 20 - (weight * np.log(like)).sum()), grad


def _weights(rated: Features, grades: np.ndarray) -> Model:
    slots, starts, m = rated
    mean, scale = m.mean(axis=0), m.std(axis=0) + 1e-6
    x = (m - mean) / scale
    n, owner = len(grades), np.repeat(np.arange(len(grades)), np.diff(starts))
    share = np.bincount(grades, minlength=3) + 1.0
    weight = (1 / np.sqrt(share))[grades]
    weight /= weight.sum()
    below = np.cumsum(share)[:2] / share.sum()
    a, gap = np.log(below[0] / (1 - below[0])), np.log(max(0.1, np.log(below[1] / (1 - below[1])) - np.log(below[0] / (1 - below[0]))))
    known = np.flatnonzero(_telling(slots, np.repeat(grades, np.diff(starts)), grades))
    place = np.full(1 << BITS, len(known))
    place[known] = np.arange(len(known))
    counted = place[slots] < len(known)
    owner, slots = owner[counted], place[slots][counted]
    starts = np.searchsorted(owner, np.arange(n + 1))
    d = len(known)
    p = np.concatenate((np.zeros(d), np.zeros(_MEASURES), [a, gap]))
    first, second = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, STEPS + 1):
        grad = loss(p, slots, starts, x, grades, weight)[1]
        first += 0.1 * (grad - first)
        second += 0.01 * (grad * grad - second)
        p -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-7)
    weights = np.zeros(1 << BITS, np.float32)
    weights[known] = p[:d]
    return Model(weights, p[d : d + _MEASURES], mean, scale, np.array([p[-2], p[-2] + np.exp(p[-1])]), (0.5, 0.5))


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from labels (doc_id, quality, toxic) of docs (doc_id, text)."""
    rated = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.when(F.col("toxic") > 0, 0).when(F.col("quality") > 0, 2).otherwise(1)).alias("grade"))
    n = rated.count()
    if not n:
        return None
    drawn = rated.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < min(1 << 30, (SAMPLE << 30) // n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = utf8(b.column(1))
            for i, j in chunks(map(len, texts), AT_ONCE):
                slots, starts, m = features(texts[i:j])
                words = [slots[x:y].astype(np.uint32).tobytes() for x, y in zip(starts, starts[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([b.column(0)[i:j], b.column(2)[i:j], pa.array(words, pa.binary()), pa.array([x.tobytes() for x in m], pa.binary())], ["doc_id", "grade", "slots", "measures"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(drawn), "doc_id")  # about SAMPLE rows at most
    hashed = rows.mapInArrow(thrifty(run), "doc_id long, grade int, slots binary, measures binary")
    sample = materialize(hashed.groupBy("doc_id").agg(F.min(F.struct("grade", "slots", "measures")).alias("r")).select("doc_id", "r.*"), "quality-sample")  # a row an id, however often it comes
    taken = sorted((r[0], r[1], bytes(r[2]), bytes(r[3])) for r in sample.toLocalIterator())
    release(sample)
    if not taken:
        return None
    slots = [np.frombuffer(s, np.uint32) for _, _, s, _ in taken]
    starts = np.concatenate(([0], np.cumsum([len(s) for s in slots])))
    return train((np.concatenate(slots).astype(np.int64), starts, np.array([np.frombuffer(m) for *_, m in taken])), np.array([g for _, g, *_ in taken]))


SCHEMA = "expected_grade double, p_at_least_low double, p_good double, keep boolean"


def grade(docs: DataFrame, model: Model | None) -> DataFrame:
    """docs with expected_grade, p_at_least_low, p_good and keep in place of columns of those names."""
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    own = docs.drop(*names)
    if model is None:
        return own.select("*", F.lit(2.0).alias(names[0]), F.lit(1.0).alias(names[1]), F.lit(1.0).alias(names[2]), F.lit(True).alias(names[3]))
    at = own.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = model.probabilities(utf8(b.column(at)))
            keep = (t[:, 0] >= model.least[0]) & (t[:, 1] >= model.least[1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(t.sum(axis=1)), pa.array(t[:, 0]), pa.array(t[:, 1]), pa.array(keep)], [*b.schema.names, *names])

    from pyspark.sql import types as T

    return own.mapInArrow(thrifty(run), T.StructType([*own.schema.fields, *T._parse_datatype_string(SCHEMA).fields]))


def kept(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of docs that the model keeps, with docs' own columns."""
    own = set_aside(docs, "text")
    return grade(own, model).where("keep").select(*own.columns).toDF(*docs.columns)
