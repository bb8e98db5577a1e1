"""Periodic stretches of words: all maximal repetitions by Lyndon arrays in linear time, and texts without their repeats.

A run of period q is a stretch of words in which words q apart are identical, q is the smallest such number and no neighbouring word
extends it.  The method is that of Ellert and Fischer.  Words are ranks in an ordered alphabet; every run has a root that is the
longest Lyndon word at its place for the order or for its reverse, so the edges from each place to its next smaller suffix name all
candidates, less than two a word.  How far the words match to the right and to the left of an edge is found by scanning words, and a
scan starts where an earlier one has ended: within a stretch that has been matched with an earlier one, the extension is that of the
same edge there.  There is no suffix array or tree and no hash of words; ranks come from sorting the distinct words of a chunk.

Before that, texts are cut at words that no run can hold: a run of exponent ``times`` has each of its words that often.  The cut
only spares work and loses nothing.

Null and empty texts have no words, no runs and an empty result.  Rows are independent of each other: repeated rows and ids and
null ids give a row each, an empty table none.  A text of any length is one row's work in one task, with memory of some hundred
bytes a word.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skiagram.llm.shared import IS_SPACE, as_bytes, chunks, unused_name, words

LEAST, TIMES = 24, 3
#: How often stretches are cut again; a matter of speed alone.
CUTS = 6
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


# ------------------------------------------------------------------------------------------------------------ Lyndon arrays


def smaller_suffixes(t: list[int]) -> tuple[list[int], list[int], int]:
    """For t[1:-1], between a first value found nowhere else and a last one below all others: the next smaller suffix of each place,
    how far the suffixes match, and how many comparisons found an equal pair.

    (left, right, reach) is the matched stretch that ends last: t[left:] and t[right:] agree up to reach.  Edges don't cross, so an
    edge that begins its scan inside that stretch lies behind ``right`` as a whole, and the same edge lies behind ``left``, or ends in
    ``right`` and begins at the place before ``left``.
    """
    end = len(t) - 1
    after, match = [end] * (end + 1), [0] * (end + 1)
    before, shared = [0] * (end + 1), [0] * (end + 1)
    left = right = reach = scanned = 0
    for j in range(2, end):
        i = j - 1
        while i:
            k = 0
            known = False
            if j < reach:
                if i >= right:
                    a = i - right + left
                    b = j - right + left
                    if after[a] == b:
                        k = match[a]
                        known = True
                    elif before[b] == i - right + left:
                        k = shared[b]
                        known = True
                    if known and j + k >= reach:
                        k = reach - j
                        known = False
                elif j == right and before[left] == i:
                    k = shared[left]
                    known = k != reach - j
                    if k > reach - j:
                        k = reach - j
            if not known:
                a = i + k
                b = j + k
                while t[a] == t[b]:
                    a += 1
                    b += 1
                scanned += b - j - k
                k = b - j
            if j + k >= reach:
                left, right, reach = i, j, j + k
            if t[i + k] < t[j + k]:
                before[j] = i
                shared[j] = k
                break
            after[i] = j
            match[i] = k
            i = before[i]
    return after, match, scanned


def left_matches(t: list[int], after: list[int]) -> tuple[list[int], int]:
    """How far the words before each place and before its next smaller suffix agree, at most one period; equal pairs compared.

    (left, right, reach) is the matched stretch that begins first: the words before left and right agree down to reach.  As it is a
    period long at most, an edge that begins inside it also lies between left and right, and is an edge there.
    """
    end = len(t) - 1
    match = [0] * (end + 1)
    left, right, reach, scanned = end, end, end, 0
    for i in range(end - 1, 0, -1):
        j = after[i]
        if j == end:
            continue
        period = j - i
        k = 0
        known = False
        if i > reach and j <= left:
            a = i + right - left
            if after[a] == j + right - left:
                k = match[a]
                known = True
                if k >= i - reach and i - reach < period:
                    k = i - reach
                    known = False
        if not known:
            a = i - 1 - k
            b = j - 1 - k
            stop = j - 1 - period
            while b > stop and t[a] == t[b]:
                a -= 1
                b -= 1
            scanned += j - 1 - k - b
            k = j - 1 - b
        match[i] = k
        if i - k < reach:
            left, right, reach = i, j, i - k
    return match, scanned


def maximal_runs(ranks: list[int], least: int = 2, times: int = 2) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``least`` words and ``times`` (2 or more) periods, in order."""
    out = []
    top = max(ranks, default=0) + 1
    for way in (1, -1):
        t = [top + 1, *(ranks if way == 1 else [-x for x in ranks]), -top]
        if way == -1:
            t[0] = top + 1
        end = len(t) - 1
        after, right, _ = smaller_suffixes(t)
        left, _ = left_matches(t, after)
        for i in range(1, end):
            j = after[i]
            period = j - i
            if j == end or left[i] >= period:  # the root before it has the same run
                continue
            n = left[i] + period + right[i]
            if n >= times * period and n >= least and (way == 1 or j + right[i] < end):  # one that ends the text has roots both ways
                out.append((i - left[i] - 1, n, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


# ------------------------------------------------------------------------------------------------------------------- chunks


def ranks_of(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The rank of each word among the distinct words of a chunk, in the order of their bytes."""
    if not len(start):
        return np.zeros(0, np.int64)
    size = end - start
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    raw = data[~IS_SPACE[data]]
    found = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))]).dictionary_encode()
    order = pc.array_sort_indices(found.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[found.indices.to_numpy()]


def stretches(rank: np.ndarray, piece: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last (exclusive) word of the stretches that may hold runs; ``piece`` is the document of each word, ascending."""
    at = np.arange(len(rank))
    wide = int(rank.max(initial=0)) + 1
    for _ in range(CUTS):
        _, which, n = np.unique(piece * wide + rank, return_inverse=True, return_counts=True)
        kept = n[which] >= times
        at, rank, piece = at[kept], rank[kept], piece[kept]
        if not len(at):
            break
        new = np.concatenate([[True], (np.diff(at) > 1) | (np.diff(piece) != 0)])
        piece = np.cumsum(new) - 1
        long = np.bincount(piece)[piece] >= least
        whole = long.all() and kept.all()
        at, rank, piece = at[long], rank[long], piece[long]
        if whole or not len(at):
            break
    if not len(at):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], np.diff(piece) != 0]))
    last = np.append(first[1:], len(at)) - 1
    return at[first], at[last] + 1


def kept_words(data: np.ndarray, at: np.ndarray, start: np.ndarray, end: np.ndarray, bounds: np.ndarray, kept: np.ndarray) -> pa.Array:
    """The kept words of each document joined by one space, as a string column."""
    out, space = data.copy(), IS_SPACE[data]
    out[space] = 32
    mark = np.zeros(len(data) + 1, np.int8)
    mark[start[kept]] += 1
    mark[end[kept]] -= 1
    take = np.cumsum(mark[:-1], dtype=np.int8).astype(bool)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[kept]
    if len(doc):
        inner = np.append(doc[1:] == doc[:-1], False)
        take[end[kept][inner]] = True  # white space follows a word that isn't its document's last
    offsets = np.concatenate([[0], np.cumsum(take, dtype=np.int64)])[at]
    return pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(out[take])]).cast(pa.string())


def chunk_runs(data: np.ndarray, at: np.ndarray, least: int, times: int) -> tuple[np.ndarray, list[list[tuple[int, int, int]]], pa.Array]:
    """Words, runs and collapsed text of each document of a chunk."""
    start, end, bounds = words(data, at)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    rank = ranks_of(data, start, end)
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(at) - 1)]
    drop = np.zeros(len(start) + 1, np.int64)
    for a, b in zip(*stretches(rank, doc, least, times), strict=True):
        own = found[doc[a]]
        for first, n, period in maximal_runs(rank[a:b].tolist(), least, times):
            own.append((int(a - bounds[doc[a]]) + first, n, period))
            drop[a + first + period] += 1
            drop[a + first + n] -= 1
    return np.diff(bounds), found, kept_words(data, at, start, end, bounds, np.cumsum(drop[:-1]) == 0)


# ---------------------------------------------------------------------------------------------------------------- operators


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, n_words, runs (start, length, period in words, ordered by start, then period) and collapsed, the words of the text
    joined by one space without those that a run holds after its first period; one row a row, no shuffle."""
    if times < 2 or least < 1:
        raise ValueError("runs have two periods or more and at least a word")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in chunks(batches, "text"):
            n, found, collapsed = chunk_runs(data, at, least, times)
            flat = [r for own in found for r in own]
            fields = [pa.array([r[k] for r in flat], pa.int64()) for k in range(3)]
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(own) for own in found])]).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, fields=list(RUN)))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n.astype(np.int64)), lists, collapsed], ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", as_bytes("text").alias("text")).mapInArrow(run, SCHEMA)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the texts (by the crc32 of the id) goes on in a period from some word on: with n words and
    g a tenth of that crc32, word i >= a = g % n becomes word a + (i - a) % p, p = 1 + (n - a) / (3 + g % 8) rounded down.

    A null id has no crc32 and its text stays.  For tests and for queries that need runs of known places.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    w, n, g, a, p = (unused_name(docs, f"_{c}") for c in "wngap")
    found = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, found).alias(w), F.floor(h / 10).alias(g))
    rows = rows.withColumn(n, F.size(w)).withColumn(a, F.col(g) % F.nullif(F.col(n), F.lit(0)))
    rows = rows.withColumn(p, F.lit(1) + F.floor((F.col(n) - F.col(a)) / (F.lit(3) + F.col(g) % 8)))
    source = lambda i: F.when(i < F.col(a), i).otherwise(F.col(a) + (i - F.col(a)) % F.col(p)).cast("int")
    planted = F.array_join(F.transform(F.sequence(F.lit(0), F.col(n) - 1), lambda i: F.get(F.col(w), source(i))), " ")
    return rows.select("doc_id", F.when(F.col(a).isNotNull(), planted).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """Of ``periodic_runs``: how many runs, the one of greatest length over period (ties: smallest start, then period; nulls where
    there is none) and the digests of all runs and of the collapsed text."""
    better = lambda x, y: (x["length"] * y["period"] > y["length"] * x["period"])
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda acc, x: F.when(better(x, acc), x).otherwise(acc))  # runs are in order
    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    rows = found.withColumn("_best", best)
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
