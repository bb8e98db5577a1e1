"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct hashes, in 2^22 places, of a text's words, pairs of neighbours and pairs with one word between them.
Words are `[^\\x20\\x09-\\x0D]+`, A-Z in lower case and without ASCII punctuation at their ends.  FTRL-proximal keeps for each
coordinate the sum of squared gradients, hence its own learning rate, and its L1 term leaves most weights at exactly zero: what
the executors get is a sorted list of the few non-zero ones.

Training reads at most about ``MOST`` labelled rows (a hash sample outside the held-out fold; the bound is a parameter), in one
task and in id order, which makes it repeatable; only the weights reach the driver.  Scoring covers every row.

Null and empty texts have no features and get the score of the bias.  Rows with a null label do not train; if there are no
labelled rows all scores are 0.  Very long texts are read whole.  Repeated ids in the labels count once for each pair of rows.
Other columns, whatever their names, are kept by ``without_toxic``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from skiagram.llm.shared import TO_LOWER, U64, as_bytes, bounded_sample, chunks, held_out, mix, prefix_hash, span_hash, unused_name, words

MOST, BITS = 20_000, 22
#: Chosen by cross-validation among the training folds.
ALPHA, BETA, L1, L2, EPOCHS = 3.0, 1.0, 12.0, 0.01, 8
_TRIM = np.zeros(256, bool)
_TRIM[[c for c in range(33, 127) if not chr(c).isalnum()]] = True


def features(data: np.ndarray, at: np.ndarray, bits: int = BITS) -> Iterator[np.ndarray]:
    """Distinct hashed features of each document of a chunk."""
    data = TO_LOWER[data]
    start, end, before = words(data, at)
    if len(start):  # all marks at the ends go; a word of marks alone stays as it is
        inner = np.flatnonzero(~_TRIM[data])
        low, high = np.searchsorted(inner, start), np.searchsorted(inner, end) - 1
        some = low <= high
        start = np.where(some, inner[np.minimum(low, len(inner) - 1)], start) if len(inner) else start
        end = np.where(some, inner[np.maximum(high, 0)] + 1, end) if len(inner) else end
    h = span_hash(prefix_hash(data), start, end)
    down = U64(64 - bits)
    one = mix(h + U64(1)) >> down
    two = mix(mix(h[:-1] + U64(2)) + h[1:]) >> down
    skip = mix(mix(h[:-2] + U64(3)) + h[2:]) >> down
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        yield np.unique(np.concatenate([one[a:b], two[a : max(a, b - 1)], skip[a : max(a, b - 2)]])).astype(np.int64)


class Ftrl:
    """FTRL-proximal for logistic loss; coordinate ``2^bits`` is the bias."""

    def __init__(self, bits: int = BITS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2) -> None:
        self.z, self.n = np.zeros((1 << bits) + 1, np.float32), np.zeros((1 << bits) + 1, np.float32)
        self.alpha, self.beta, self.l1, self.l2, self.bias = alpha, beta, l1, l2, 1 << bits

    def weights(self, i: np.ndarray) -> np.ndarray:
        z, n = self.z[i].astype(np.float64), self.n[i].astype(np.float64)
        l1 = np.where(i == self.bias, 0, self.l1)
        return np.where(np.abs(z) <= l1, 0, (np.sign(z) * l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, i: np.ndarray, label: int) -> None:
        i = np.append(i, self.bias)
        w = self.weights(i)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[i].astype(np.float64)
        self.z[i] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[i] = n + g * g


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = MOST, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of the non-zero weights; the bias has the largest index."""
    known = labels.filter(F.col(label).isNotNull() & ~held_out()).select("doc_id", F.col(label).cast("int").alias("label"))
    chosen = bounded_sample(known, "doc_id", most, "toxicity")
    rows = chosen.join(docs.select("doc_id", as_bytes("text").alias("text")), "doc_id").select("doc_id", "label", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in chunks(batches, "text", 1 << 19):
            found = [f.astype(np.int32) for f in features(data, at)]
            ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))], ["doc_id", "label", "f"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, label = [], []
        for batch in batches:
            if batch.num_rows:
                at = batch.column(2).offsets.to_numpy()
                own += np.split(batch.column(2).values.to_numpy()[at[0] : at[-1]].copy(), at[1:-1] - at[0])
                label += batch.column(1).to_pylist()
        if label:
            model = Ftrl()
            for epoch in range(epochs):
                for k in np.random.default_rng(epoch).permutation(len(label)).tolist():
                    model.learn(own[k].astype(np.int64), int(label[k] == 1))
            i = np.append(np.flatnonzero(np.abs(model.z[:-1]) > model.l1), model.bias)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(model.weights(i))], ["i", "w"])

    # the sample is bounded, so one task may hold its features
    sample = rows.mapInArrow(extract, "doc_id long, label int, f array<int>").repartition(1).sortWithinPartitions("doc_id")
    got = sample.mapInArrow(fit, "i long, w double").toPandas().sort_values("i")
    return got["i"].to_numpy(np.int64), got["w"].to_numpy(np.float64)


def scored(docs: DataFrame, index: np.ndarray, weight: np.ndarray, score: str = "score") -> DataFrame:
    """``docs`` with a column ``score`` (a name that it hasn't), the probability of label 1."""
    broadcast = docs.sparkSession.sparkContext.broadcast((index, weight))
    schema = StructType([*docs.schema.fields, StructField(score, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, weight = broadcast.value
        table = np.zeros((1 << BITS) + 1, np.float32)
        table[index] = weight
        bias = float(table[-1])
        for part, data, at in chunks(batches, "text", 1 << 19):
            s = np.array([bias + float(table[f].sum()) for f in features(data, at)])
            p = 1 / (1 + np.exp(-np.clip(s, -35, 35))) if len(index) else np.zeros(len(s))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(p)], [*part.schema.names, score])

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, most: int = MOST) -> DataFrame:
    out = scored(docs.select("doc_id", "text"), *train(docs, labels, most=most))
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, most: int = MOST) -> DataFrame:
    """The rows of ``docs`` with a score below 0.5, columns unchanged."""
    name = unused_name(docs, "score")
    return scored(docs, *train(docs, labels, most=most), name).filter(F.col(name) < 0.5).select(*[F.col(f"`{c}`") for c in docs.columns])
