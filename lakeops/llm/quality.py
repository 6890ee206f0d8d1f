"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

    y(x) = w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j

The pairwise sum is taken in linear time, factor by factor, as half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2.
Features of a text are its words, hashed into buckets and weighted by their share, and a few statistics of its
form, one of them metadata (the length stated by the row). Which document it is, its language, its source and its
labels are never features.
"""

from __future__ import annotations

import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import carried, keeps_inner_names_apart, prepare_workers, whole_text

BUCKETS = 1 << 16
FACTORS = 8
#: Labelled documents to learn from, at most: those whose hashed id is smallest. Bounds the driver's work.
MAX_LABELLED = 8_192
ACCEPT = 0.7
STATISTICS = (
    "log_chars",
    "log_words",
    "word_length",
    "distinct_words",
    "commonest_word",
    "upper_case",
    "punctuation",
    "digits",
    "line_breaks",
    "beyond_ascii",
)
WIDTH = BUCKETS + len(STATISTICS)
_UPPER = string.ascii_uppercase.encode()
_PUNCTUATION = string.punctuation.encode()
_DIGITS = string.digits.encode()
_ASCII = bytes(range(128))


@dataclass
class Rows:
    """Sparse feature rows: row ``r`` has entries ``starts[r]`` to ``starts[r + 1]``; none is empty."""

    starts: np.ndarray
    index: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def take(self, rows: np.ndarray) -> Rows:
        sizes = np.diff(self.starts)[rows]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.starts[rows] - starts[:-1], sizes) + np.arange(starts[-1])
        return Rows(starts, self.index[at], self.value[at])


def _share(data: bytes, characters: bytes) -> float:
    return 1 - len(data.translate(None, characters)) / len(data) if data else 0.0


def features(texts: list[str], n_chars: list[int | None]) -> Rows:
    """Feature rows of whole texts. An empty text has its statistics only, and they are zero."""
    index, value, sizes = [], [], []
    statistics_at = np.arange(BUCKETS, WIDTH)
    for text, length in zip(texts, n_chars, strict=True):
        data = text.encode("utf-8", "replace")
        words = data.lower().split()
        counts = Counter(words)
        n = len(words)
        stats = [
            np.log1p(max(0, len(text) if length is None else length)) / 5,
            np.log1p(n) / 5,
            (len(data) - data.count(b" ")) / n / 8 if n else 0.0,
            len(counts) / n if n else 0.0,
            max(counts.values()) / n if n else 0.0,
            5 * _share(data, _UPPER),
            10 * _share(data, _PUNCTUATION),
            10 * _share(data, _DIGITS),
            10 * data.count(b"\n") / len(data) if data else 0.0,
            5 * (1 - _share(data, _ASCII)) if data else 0.0,
        ]
        buckets = np.fromiter((zlib.crc32(w) % BUCKETS for w in counts), np.int64, len(counts))
        weights = np.fromiter(counts.values(), np.float32, len(counts))
        if n:
            distinct, at = np.unique(buckets, return_inverse=True)
            summed = np.bincount(at, weights=weights)
            summed = summed / np.sqrt((summed**2).sum())
        else:
            distinct, summed = buckets, weights
        index += [distinct, statistics_at]
        value += [summed, np.minimum(stats, 5.0)]
        sizes.append(len(distinct) + len(STATISTICS))
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    if not texts:
        return Rows(starts, np.zeros(0, np.int64), np.zeros(0, np.float32))
    return Rows(starts, np.concatenate(index), np.concatenate(value).astype(np.float32))


@dataclass
class Machine:
    """w0, w and V; as large as the number of buckets, whatever the corpus."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margins(self, rows: Rows) -> np.ndarray:
        if not len(rows):
            return np.zeros(0)
        at, x = rows.starts[:-1], rows.value
        scaled = self.factors[rows.index] * x[:, None]
        total = np.add.reduceat(scaled, at, axis=0)
        squares = np.add.reduceat(scaled**2, at, axis=0)
        single = np.add.reduceat(self.linear[rows.index] * x, at)
        return self.bias + single + 0.5 * (total**2 - squares).sum(axis=1)

    def scores(self, rows: Rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(rows), -30, 30).astype(np.float64)))


def train(rows: Rows, labels: np.ndarray, epochs: int = 12, rate: float = 0.08, penalty: float = 1e-5, seed: int = 7) -> Machine:
    """Fit by AdaGrad on the log loss, in mini-batches. Without both labels, the share of label 1 (Laplace) for all."""
    n = len(labels)
    share = (labels.sum() + 1) / (n + 2)
    model = Machine(float(np.log(share / (1 - share))), np.zeros(WIDTH, np.float32), np.zeros((WIDTH, FACTORS), np.float32))
    if n == 0 or labels.min() == labels.max():
        return model
    rng = np.random.default_rng(seed)
    model.factors = rng.normal(0, 0.02, (WIDTH, FACTORS)).astype(np.float32)
    seen_w, seen_v, seen_b = np.full(WIDTH, 1e-6, np.float32), np.full((WIDTH, FACTORS), 1e-6, np.float32), 1e-6
    for _ in range(epochs):
        order = rng.permutation(n)
        for at in range(0, n, 64):
            some = order[at : at + 64]
            part = rows.take(some)
            error = (model.scores(part) - labels[some]).astype(np.float32) / len(some)
            sizes = np.diff(part.starts)
            each = np.repeat(error, sizes)
            x, index = part.value, part.index
            scaled = model.factors[index] * x[:, None]
            total = np.repeat(np.add.reduceat(scaled, part.starts[:-1], axis=0), sizes, axis=0)
            touched, where = np.unique(index, return_inverse=True)
            slope_w = np.bincount(where, weights=each * x).astype(np.float32) + penalty * model.linear[touched]
            slope_v = np.zeros((len(touched), FACTORS), np.float32)
            np.add.at(slope_v, where, (each * x)[:, None] * (total - scaled))
            slope_v += penalty * model.factors[touched]
            seen_w[touched] += slope_w**2
            seen_v[touched] += slope_v**2
            seen_b += float(error.sum()) ** 2
            model.linear[touched] -= rate * slope_w / np.sqrt(seen_w[touched])
            model.factors[touched] -= rate * slope_v / np.sqrt(seen_v[touched])
            model.bias -= rate * float(error.sum()) / np.sqrt(seen_b)
    return model


def _source(df: DataFrame, keep: list[str], text: str, n_chars: str) -> DataFrame:
    stated: Column = F.col(n_chars).cast("long") if n_chars in df.columns else F.lit(None).cast("long")
    return df.select(*keep, whole_text(text).alias("_text_to_score"), stated.alias("_stated_length"))


def _features_of(batch: pa.RecordBatch) -> Rows:
    return features(batch.column("_text_to_score").to_pylist(), batch.column("_stated_length").to_pylist())


def fit(
    docs: DataFrame, labels: DataFrame, learn_from: Column, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars", label: str = "quality"
) -> Machine:
    """Learn from at most ``MAX_LABELLED`` labelled documents for which ``learn_from`` (over ``doc_id``) holds.

    Labels other than 0 and 1, and rows without id, are left out; of several labels of one document the
    largest counts. The features of the sample come to the driver, texts do not.
    """
    prepare_workers(docs.sparkSession)
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull() & learn_from)
    known = known.groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("_label"))
    sample = known.orderBy(F.xxhash64("_id"), "_id").limit(MAX_LABELLED)
    # At most MAX_LABELLED rows of 12 bytes.
    joined = _source(docs, [doc_id], text, n_chars).join(F.broadcast(sample), F.col(doc_id) == F.col("_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _features_of(batch)
            cuts = list(zip(rows.starts[:-1], rows.starts[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("_label"),
                    pa.array([rows.index[a:b].astype("<i4").tobytes() for a, b in cuts], pa.binary()),
                    pa.array([rows.value[a:b].astype("<f4").tobytes() for a, b in cuts], pa.binary()),
                ],
                names=["id", "label", "index", "value"],
            )

    found = joined.mapInArrow(run, "id long, label int, index binary, value binary").toArrow()
    found = found.sort_by([("id", "ascending"), ("value", "ascending")])
    index = [np.frombuffer(x, "<i4") for x in found["index"].to_pylist()]
    value = [np.frombuffer(x, "<f4") for x in found["value"].to_pylist()]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in index])]).astype(np.int64)
    empty = [np.zeros(0, np.int64)]
    rows = Rows(starts, np.concatenate(index or empty).astype(np.int64), np.concatenate(value or empty).astype(np.float32))
    return train(rows, np.array(found["label"].to_pylist(), dtype=np.float64))


@keeps_inner_names_apart
def score(df: DataFrame, model: Machine, text: str = "text", n_chars: str = "n_chars", out: str = "score") -> DataFrame:
    """Add ``out``: the probability of label 1 for each whole text.

    NULL texts count as empty; empty texts have a score too. Columns are kept, one called like the result is replaced.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    sent = spark.sparkContext.broadcast((model.bias, model.linear, model.factors))
    keep = carried(df, [out])
    schema = T.StructType([*df.select(*keep).schema, T.StructField(out, T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(*sent.value)
        for batch in batches:
            found = pa.array(machine.scores(_features_of(batch)), pa.float64())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keep), found], names=[*keep, out])

    return _source(df, keep, text, n_chars).mapInArrow(run, schema)
