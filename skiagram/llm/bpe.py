"""Byte-level BPE through a sentencepiece model that is serialised here, straight from a table of ranks.

Every byte gets one printable code point, so each vocabulary entry is a string of such points.  The model proto holds these
strings as normal pieces with score = -rank, BPE as model type and the identity as normaliser; no training takes place.
Merging the pair of best score leftmost first is then the merge order of the ranks.  A pre-token that is itself an entry takes
that id at once, as rank encoders do.  Decoding maps ids to the bytes of their entries.

Distinct pre-tokens are encoded once and kept, with their ids as bytes, in bounded memos of the worker (see ``pretokens``).

Null texts are empty: no ids and the digest of nothing.  Texts of any length are encoded whole.  Repeated rows are encoded
for each row.  An empty table gives no rows.  Extra columns are not read by the query; ``encode_column`` keeps them.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skiagram.llm.pretokens import KEPT, LONGEST, PieceIds, cuts_at_spaces
from skiagram.llm.shared import chunks

#: One printable code point for each byte: Latin Extended-A and on, no white space and no special character among them.
BYTE_CHAR = [chr(0x100 + b) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, body: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(body)) + body


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """A serialised ModelProto: piece 0 is unknown, piece rank + 1 is the entry of that rank."""
    pieces = [_field(1, _field(1, b"<unk>") + b"\x15" + np.float32(0).tobytes() + b"\x18\x02")]
    for entry, rank in sorted(ranks.items(), key=lambda x: x[1]):
        text = "".join(BYTE_CHAR[b] for b in entry).encode()
        pieces.append(_field(1, _field(1, text) + b"\x15" + np.float32(-rank).tobytes() + b"\x18\x01"))
    # trainer_spec: model_type (3) = BPE (2), vocab_size (4); normalizer_spec: name, no dummy prefix, no trimming, no escaping
    trainer = b"\x18\x02" + b"\x20" + _varint(len(pieces))
    normalizer = _field(1, b"identity") + b"\x18\x00" + b"\x20\x00" + b"\x28\x00"
    return b"".join(pieces) + _field(2, trainer) + _field(3, normalizer)


class RankCodec:
    """Encoder and decoder of one table of ranks; ranks must be 0 to n - 1."""

    def __init__(self, path: str, pattern: str) -> None:
        import regex
        import sentencepiece

        self.ranks = read_ranks(path)
        if sorted(self.ranks.values()) != list(range(len(self.ranks))):
            raise ValueError("ranks must be consecutive from 0")
        self.split = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.ranks))
        self.entries = [e for e, _ in sorted(self.ranks.items(), key=lambda x: x[1])]
        self.known: dict[str, bytes] = {}
        # a pattern whose tokens cross single spaces has whole texts split
        self.pieces = PieceIds(self._encode_pieces, cut=cuts_at_spaces(self.split))

    def _encode_pieces(self, pieces: list[str]) -> list[bytes]:
        split = [self.split(p) for p in pieces]
        rest, new = {}, []
        for t in {t for s in split for t in s if t not in self.known}:
            rank = self.ranks.get(t.encode())
            if rank is None:
                new.append(t)
            else:
                rest[t] = rank.to_bytes(4, "little")
        mapped = ["".join([BYTE_CHAR[b] for b in t.encode()]) for t in new]
        for t, ids in zip(new, self.model.encode(mapped, num_threads=1) if mapped else [], strict=True):
            rest[t] = (np.array(ids, "<u4") - np.uint32(1)).tobytes()
        if len(self.known) < KEPT:
            self.known.update((t, i) for t, i in rest.items() if len(t) <= LONGEST)
        return [b"".join([self.known.get(t) or rest[t] for t in s]) for s in split]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        return [ids.tobytes() for ids in self.pieces.encode_array(pa.array(texts, pa.string()))]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.entries.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_CODECS: dict[tuple[str, str], RankCodec] = {}


def codec(path: str, pattern: str) -> RankCodec:
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = RankCodec(path, pattern)
    return _CODECS[path, pattern]


def encode_column(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, order_col: str | None = None) -> DataFrame:
    """doc id, n_tokens, ids_sha256, decoded_sha256 and, if asked, the ids themselves as binary and a column of integers that orders
    the rows, which stay in the order in which they come."""
    schema = f"{id_col} long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids + (f", {order_col} long" if order_col else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for part, _, _ in chunks(batches, "_text", 1 << 21):
            ids = [x.tobytes() for x in own.pieces.encode_array(part.column(1))]
            arrays = [part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()), pa.array([hashlib.sha256(own.decode(x)).hexdigest() for x in ids], pa.string())]
            names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
            arrays, names = arrays + [pa.array(ids, pa.binary())] * with_ids, names + ["ids"] * with_ids
            yield pa.RecordBatch.from_arrays(arrays + [part.column(2)] if order_col else arrays, names + [order_col] if order_col else names)

    more = [F.col(order_col).cast("long").alias("_order")] if order_col else []
    return docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("_text"), *more).mapInArrow(run, schema)
