"""Token sequences of a fixed length with little padding: first-fit decreasing in randomised groups of documents.

Rows are dealt to tasks, and put in order there, by a hash of their id, text and place, so a group is a random one and the same when
a lost task runs again; what a task holds at once is a group of about ``GROUP_TOKENS`` ids, and groups know nothing of each other.
Within a group, a document longer than a sequence is cut into whole sequences and a rest.  Rests go, the longest first, each into the
first sequence with room for it, which a tournament tree over the room of all sequences finds in logarithmic time.  What room is left
by then is filled from the emptiest sequences, whose pieces are cut where need be; room of less than ``least_fragment`` ids stays, as
a fragment that short costs more than it saves.  Of the last sequence, powers of two are cut off, since a sequence of such a length
isn't padded.

Null and empty texts are documents of the end id alone (of no ids and no pieces where there is none).  Repeated rows and ids and null
ids are documents of their own; equal rows of one input partition fall into one task, those of others elsewhere.  An empty table gives
no rows.  A text of any length is encoded whole and makes its group as large as it must be.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skiagram.llm.shared import chunks
from skiagram.llm.token_files import encoder

LENGTH, GROUP_TOKENS, LEAST_FRAGMENT = 2048, 1 << 22, 8
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

#: (document, start, length)
Piece = tuple[int, int, int]


class Room:
    """A tournament tree over the room left in each of a number of sequences; every node knows the most below it."""

    def __init__(self, sequences: int, length: int) -> None:
        self.leaves = 1 << max(sequences - 1, 0).bit_length()
        self.most = [length] * (2 * self.leaves)

    def first(self, need: int) -> int:
        """The first sequence with room for ``need``; there must be one."""
        node = 1
        while node < self.leaves:
            node *= 2
            node += self.most[node] < need
        return node - self.leaves

    def take(self, sequence: int, n: int) -> None:
        node = sequence + self.leaves
        self.most[node] -= n
        while node > 1:
            node //= 2
            self.most[node] = max(self.most[2 * node], self.most[2 * node + 1])

    def left(self, sequence: int) -> int:
        return self.most[sequence + self.leaves]


def first_fit_decreasing(pieces: list[Piece], length: int) -> list[list[Piece]]:
    """Sequences of whole pieces of at most ``length``; equal pieces in their own order."""
    room, out = Room(len(pieces), length), []
    for piece in sorted(pieces, key=lambda p: -p[2]):
        k = room.first(piece[2])
        if k == len(out):
            out.append([])
        out[k].append(piece)
        room.take(k, piece[2])
    return out


def filled(sequences: list[list[Piece]], length: int, least_fragment: int) -> list[list[Piece]]:
    """The same ids in fewer sequences: the emptiest ones are taken apart to fill the others, and powers of two cut off the last."""
    size = lambda s: sum(p[2] for p in s)
    order = sorted(sequences, key=size, reverse=True)
    room, least = [length - size(s) for s in order], max(least_fragment, 1)
    k, last = 0, len(order)  # what is being filled; from where on sequences are taken apart
    loose: list[Piece] = []
    while True:
        while k < last and room[k] < least:
            k += 1
        if not loose and k < last:
            last -= 1
            loose = sorted(order[last], key=lambda p: p[2])
        elif not loose or k >= last:
            break
        else:
            doc, start, n = loose.pop()
            put = min(n, room[k])
            order[k].append((doc, start, put))
            room[k] -= put
            if put < n:
                loose.append((doc, start + put, n - put))
    return [*order[:last], *([loose] if loose and length - size(loose) < least else in_powers_of_two(loose))]


def in_powers_of_two(pieces: list[Piece]) -> list[list[Piece]]:
    """Sequences whose lengths are the powers of two that make up the whole, the largest first."""
    rest, left = list(reversed(pieces)), sum(p[2] for p in pieces)
    out: list[list[Piece]] = []
    while left:
        want = 1 << (left.bit_length() - 1)
        left -= want
        out.append([])
        while want:
            doc, start, n = rest.pop()
            put = min(n, want)
            out[-1].append((doc, start, put))
            want -= put
            if put < n:
                rest.append((doc, start + put, n - put))
    return out


def packed(sizes: list[int], length: int = LENGTH, least_fragment: int = LEAST_FRAGMENT) -> list[list[Piece]]:
    """Sequences of pieces of documents of these sizes."""
    whole = [[(d, k, length)] for d, n in enumerate(sizes) for k in range(0, n - length + 1, length)]
    rests = [(d, n - n % length, n % length) for d, n in enumerate(sizes) if n % length]
    return whole + filled(first_fit_decreasing(rests, length), length, least_fragment)


def pack(docs: DataFrame, tokenizer_path: str, end_id: int | None, length: int = LENGTH, partitions: int | None = None, group_tokens: int = GROUP_TOKENS, least_fragment: int = LEAST_FRAGMENT) -> DataFrame:
    """A row a piece: doc_id, start (ids of its document before it), length, ids (little-endian unsigned 32-bit integers), doc_tokens,
    sequence_id and offset (ids of its sequence before it)."""
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("deal", F.xxhash64("doc_id", "text", F.spark_partition_id()))
    dealt = rows.repartition(n, "deal").sortWithinPartitions("deal", "doc_id").select("doc_id", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        _, encode = encoder(tokenizer_path)
        tail = np.array([] if end_id is None else [end_id], "<u4")
        number = TaskContext.get().partitionId() << 33
        names: list[int | None] = []
        ids: list[np.ndarray] = []

        def made() -> Iterator[pa.RecordBatch]:
            nonlocal number
            sequences = packed([len(x) for x in ids], length, least_fragment)
            for a in range(0, len(sequences), 256):
                own = sequences[a : a + 256]
                pieces = [p for s in own for p in s]
                counts = np.array([len(s) for s in own])
                offsets = [o for s in own for o in accumulate((p[2] for p in s[:-1]), initial=0)]
                columns = [
                    pa.array([names[d] for d, _, _ in pieces], pa.int64()),
                    pa.array([k for _, k, _ in pieces], pa.int64()),
                    pa.array([m for _, _, m in pieces], pa.int64()),
                    pa.array([ids[d][k : k + m].tobytes() for d, k, m in pieces], pa.binary()),
                    pa.array([len(ids[d]) for d, _, _ in pieces], pa.int64()),
                    pa.array(np.repeat(number + a + np.arange(len(own)), counts)),
                    pa.array(offsets, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCHEMA.split(", ")])
            number += len(sequences)
            names.clear()
            ids.clear()

        held = 0
        for batch, _, _ in chunks(batches, "text", 1 << 23):
            for name, own in zip(batch.column(0).to_pylist(), encode(batch.column(1)), strict=True):
                names.append(name)
                ids.append(np.append(own, tail).astype("<u4", copy=False))
                held += len(ids[-1])
                if held >= group_tokens:
                    yield from made()
                    held = 0
        yield from made()

    return dealt.mapInArrow(work, SCHEMA)


def sequences(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """A row a sequence of ``pack``: sequence_id, ids, n_tokens, padded_to and doc_ids in their order; no more than ``length`` ids meet."""
    held = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    joined = F.aggregate("held", F.lit(b""), lambda s, x: F.concat(s, x["ids"]))
    n = F.octet_length("ids").cast("long") / 4
    rows = pieces.groupBy("sequence_id").agg(held.alias("held")).select("sequence_id", joined.alias("ids"), F.col("held.doc_id").alias("doc_ids"))
    rows = rows.withColumn("n_tokens", n.cast("long"))
    return rows.withColumn("padded_to", F.when(F.bit_count("n_tokens") == 1, F.col("n_tokens")).otherwise(F.lit(length).cast("long")))
