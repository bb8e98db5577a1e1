"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 of its own, drawn by a hash of its code point.  A trigram binds its letters: the
vector of the first letter, permuted twice (rolled by two places), times that of the second, permuted once, times that of the
third.  A text bundles (sums) the vectors of its trigrams; the prototype of a language bundles all its training texts.  The
prediction is the prototype of largest cosine, and the score that cosine, at least 0.

Letters are the code points that Unicode calls letters, in lower case; everything else is one separator.  Trigrams are counted
for a text at once and their vectors kept for the next texts, so a text costs one small matrix product.  The model is langs x
dimensions numbers, whatever the size of the corpus or of the alphabet.

Training uses a hash sample of about ``MOST`` labelled rows outside the held-out fold; texts are bundled on the executors, and
only the sums (a row for each language and dimension) reach the driver.  A text that is null or has no letter gets ``und`` and
0; so does every text if no row has a language.  Very long texts are counted whole, piece by piece.  Repeated rows get equal
rows; ties of cosine go to the smaller language name.  Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skiagram.llm.shared import U64, bounded_sample, held_out, mix

MOST, DIMS = 20_000, 512
#: Vectors that a worker keeps, and windows of a text that are counted at once.
MEMO, PIECE = 1 << 15, 1 << 18
UNKNOWN = "und"
_LETTERS: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    """Whether Unicode calls a code point a letter."""
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTERS[0]


def trigrams(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct trigrams of a text (three code points of 21 bits, 0 for a run of separators) and their counts, piece by piece."""
    s = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    s = np.concatenate([[0], np.where(is_letter()[s], s, 0), [0]]).astype(np.int64)
    s = s[np.append(True, (s[1:] != 0) | (s[:-1] != 0))]
    for k in range(0, len(s) - 2, PIECE):
        p = s[k : k + PIECE + 2]
        yield np.unique(p[:-2] << 42 | p[1:-1] << 21 | p[2:], return_counts=True)


def letter_vectors(letters: np.ndarray, dims: int) -> np.ndarray:
    """The vector of each code point, +1 and -1, from the bits of a hash."""
    words = mix(letters.astype(U64)[:, None] * U64(0x9E3779B97F4A7C15) + np.arange(1, -(-dims // 64) + 1, dtype=np.uint64) * U64(0xD1342543DE82EF95))
    return np.unpackbits(words.view(np.uint8), axis=1)[:, :dims].astype(np.int8) * 2 - 1


def bound(codes: np.ndarray, dims: int) -> np.ndarray:
    """The vectors of trigrams."""
    parts = np.stack([codes >> 42, codes >> 21 & 0x1FFFFF, codes & 0x1FFFFF])
    letters, at = np.unique(parts, return_inverse=True)
    v, (a, b, c) = letter_vectors(letters, dims), at.reshape(parts.shape)
    return np.roll(v, 2, 1)[a] * np.roll(v, 1, 1)[b] * v[c]


class TrigramVectors:
    """Vectors of trigrams, bound when first met; at most about ``MEMO`` are kept, and started anew beyond."""

    def __init__(self, dims: int = DIMS) -> None:
        self.dims = dims
        self.codes, self.rows = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.vectors = np.empty((MEMO, dims), np.float32)

    def of(self, codes: np.ndarray) -> np.ndarray:
        """The vectors of at most ``MEMO`` sorted distinct codes."""
        at = np.searchsorted(self.codes, codes)
        new = np.append(self.codes, -1)[at] != codes
        if new.any():
            if len(self.codes) + new.sum() > MEMO:
                self.codes, self.rows, at, new = self.codes[:0], self.rows[:0], at * 0, new | True
            rows = np.arange(len(self.codes), len(self.codes) + new.sum())
            self.vectors[rows] = bound(codes[new], self.dims)
            self.codes, self.rows = np.insert(self.codes, at[new], codes[new]), np.insert(self.rows, at[new], rows)
            at = np.searchsorted(self.codes, codes)
        return self.vectors[self.rows[at]]

    def bundle(self, text: str) -> tuple[np.ndarray, bool]:
        """The sum of a text's trigram vectors, and whether it has a letter."""
        out, some = np.zeros(self.dims), False
        for codes, counts in trigrams(text):
            some = some or bool(codes[-1])
            for k in range(0, len(codes), 8192):
                out += counts[k : k + 8192].astype(np.float32) @ self.of(codes[k : k + 8192])
        return out, some


def train(docs: DataFrame, most: int = MOST, dims: int = DIMS) -> tuple[list[str], np.ndarray]:
    """Languages and their unit prototypes, from doc_id, text and lang of rows outside the held-out fold."""
    known = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = bounded_sample(known, "doc_id", most, "language").select("lang", F.col("text").cast("string").alias("text"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = TrigramVectors(dims)
        for batch in batches:
            total: dict[str, np.ndarray] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own, some = vectors.bundle(text)
                if some:
                    total[lang] = total.get(lang, 0) + own
            for lang, own in total.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * dims, pa.string()), pa.array(np.arange(dims)), pa.array(np.rint(own).astype(np.int64))], ["lang", "dim", "n"])

    found = rows.mapInArrow(sums, "lang string, dim long, n long").groupBy("lang", "dim").agg(F.sum("n").alias("n")).toPandas().sort_values(["lang", "dim"])
    langs = found["lang"].drop_duplicates().to_list()
    prototypes = found["n"].to_numpy(np.float32).reshape(len(langs), dims)
    return langs, prototypes / np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-12)


def predict(docs: DataFrame, langs: list[str], prototypes: np.ndarray) -> DataFrame:
    dims = prototypes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, und = TrigramVectors(dims), [*langs, UNKNOWN]
        for batch in batches:
            texts = batch.column(2)
            profile, some = np.zeros((batch.num_rows, dims)), np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                if text := texts[k].as_py():
                    profile[k], some[k] = vectors.bundle(text)
            some &= bool(langs)
            cosine = profile @ prototypes.T / np.maximum(np.linalg.norm(profile, axis=1), 1e-12)[:, None] if langs else np.zeros((len(some), 1))
            best = np.where(some, cosine.argmax(1), len(langs))
            score = np.where(some, np.clip(cosine.max(1), 0, 1), 0).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([und[b] for b in best], pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identified(docs: DataFrame, most: int = MOST, dims: int = DIMS) -> DataFrame:
    return predict(docs, *train(docs, most, dims))
