"""What the operators of this subpackage share: the cluster's folder, staged tables and vectorised text primitives.

Text travels to Python as UTF-8 bytes.  A chunk of documents is one flat ``uint8`` array with document offsets, and words,
shingles and windows are found and hashed for the whole chunk at once, so there is no Python loop over words.
"""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64


def shared_dir(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; in local mode (tests) a temporary folder where that setting is absent."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="skiagram-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/skiagram-{uuid.uuid4().hex}"


_COLLECTING: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("folders", default=None)


@contextlib.contextmanager
def collecting(folders: list[str]) -> Iterator[None]:
    """Within, and in this thread alone, the folders of staged tables are noted, so that they can be discarded when the result is written."""
    was = _COLLECTING.set(folders)
    try:
        yield
    finally:
        _COLLECTING.reset(was)


def discard(spark: SparkSession, folders: list[str]) -> None:
    for folder in folders:
        p = spark._jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    folders.clear()


def unused_name(df: DataFrame, stem: str) -> str:
    """``stem`` with as many underscores as it takes to clash with no column."""
    taken = {c.lower() for c in df.columns}
    while stem in taken:
        stem += "_"
    return stem


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, folders: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and a lost executor costs one scan.

    The shuffle files of that one write are not needed afterwards and go at once.  The folder is added to ``folders``.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    for noted in (_COLLECTING.get(), folders):
        if noted is not None:
            noted.append(path)
    was = spark.conf.get(CLEANUP, None)
    try:
        spark.conf.set(CLEANUP, "true")
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, was) if was is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(id_col: str = "doc_id", folds: int = 5):
    """True where crc32 of the id as text is divisible by ``folds``; such rows never train."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0


def bounded_sample(df: DataFrame, id_col: str, most: int, seed: str) -> DataFrame:
    """About ``most`` rows at most, chosen by a hash of the id; for fitting classifiers only."""
    grain = 1 << 20
    share = min(1.0, most / max(1, df.count()))
    if share >= 1:
        return df
    return df.filter(F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(grain)) < int(share * grain))


def as_bytes(col: str):
    return F.coalesce(F.col(col).cast("binary"), F.lit(b""))


# ---------------------------------------------------------------------------------------------------------------- chunks


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary or string Arrow column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        column = column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    wide = pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def tidy() -> None:
    """Hand memory that a task no longer uses back to the machine: workers live on and run other stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def chunks(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches of about ``most`` bytes of ``column``, never splitting a row."""
    try:
        for batch in batches:
            _, at = flat(batch.column(batch.schema.get_field_index(column)))
            row = 0
            while row < batch.num_rows:
                end = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
                part = batch.slice(row, min(end, batch.num_rows) - row)
                yield part, *flat(part.column(part.schema.get_field_index(column)))
                row += part.num_rows
    finally:
        tidy()


# --------------------------------------------------------------------------------------------------------------- hashing

_RADIX = 0x9E3779B97F4A7C15 | 5
_INVERSE = pow(_RADIX, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}
_LETTER = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
TO_LOWER = np.arange(256, dtype=np.uint8)
TO_LOWER[65:91] += 32


def powers(n: int, radix: int) -> np.ndarray:
    have = _POWERS.get(radix)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, radix, U64)
        have[0] = 1
        _POWERS[radix] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` gives the hash of any byte range."""
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(_LETTER[data] * powers(len(data), _RADIX), out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    inverse = powers(len(sums), _INVERSE)
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every ``[^\\x20\\x09-\\x0D]+`` and, per document, the number of words before it."""
    inside = ~IS_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    edges = at[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, at)


def shingle_hashes(word_hash: np.ndarray, size: int) -> np.ndarray:
    """Order-dependent hash of every run of ``size`` words of one document."""
    n = len(word_hash) - size + 1
    out = np.zeros(n, U64)
    for k in range(size):
        out = mix(out + word_hash[k : k + n] + U64(k + 1))
    return out
