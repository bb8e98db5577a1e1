"""Token ids in binary files: independent zstandard frames, a trailing seek table and a checksum for every frame.

A file is a valid zstandard stream in the public "seekable format":

    frame ... frame        each holds the ids of one document (a very long one takes several), compressed alone
    skippable 0x184D2A50   document index: doc_id, null flag, number of frames and number of ids of each document
    skippable 0x184D2A5E   seek table: compressed size, decompressed size, low 32 bits of xxh64 of each frame; then
                           number of frames (u32), descriptor 0x80 (checksums present), magic 0x8F92EAB1

``read_documents`` finds the requested frames from the tail and decompresses only those.  Ids are little-endian and two
bytes wide where the vocabulary allows, else four.

Null texts are empty documents: only the end id.  A null doc_id sorts first and is kept.  Repeated ids keep one entry for
each row.  An empty table gives an empty folder and no rows.  Other columns of the input are not read.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skiagram.llm.pretokens import PieceIds
from skiagram.llm.shared import chunks, shared_dir

# Fixed values of the public zstandard seekable format.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEKABLE_MAGIC, CHECKSUM_FLAG = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80
INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("frames", "<u4"), ("n_tokens", "<u8")])
SEEK = np.dtype([("compressed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])
IDS_A_FRAME = 1 << 22

MANIFEST = T.StructType([T.StructField("part", T.LongType()), T.StructField("file", T.StringType()), T.StructField("n_docs", T.LongType()), T.StructField("n_tokens", T.LongType())])
OUT = "doc_id long, part long, start_in_part long, n_tokens long, ids_crc32 long"


def _filesystem(uri: str):
    """A pyarrow filesystem and path; plain and file: paths need no other library."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


_ENCODERS: dict[str, tuple] = {}


def is_byte_level(path: str) -> bool:
    """Whether a tokenizer is byte-level BPE with the public pattern, no normaliser and no added prefix, so pieces may stand alone."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    pre = model.get("pre_tokenizer") or {}
    return not model.get("normalizer") and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and model["model"].get("dropout") is None


def by_lines(many):
    """``many`` for pieces that are a space and something else: one call for many of them, as lines of one text.

    A line break before a piece is a token of its own and no piece holds one, so its id tells where each piece ends.
    """
    end_of_line = np.frombuffer(many(["\n"])[0], "<u4")

    def encode(pieces: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(pieces)
        plain = [k for k, p in enumerate(pieces) if p[:1] == " " and "\n" not in p and not p[-1].isspace() and not p[1].isspace()]
        groups = [plain[a : a + 512] for a in range(0, len(plain), 512)]
        texts = ["\n".join([pieces[k] for k in own]) + "\n" for own in groups]
        for own, raw in zip(groups, many(texts) if texts else [], strict=True):
            at = 0
            for k, e in zip(own, np.flatnonzero(np.frombuffer(raw, "<u4") == end_of_line[0]).tolist(), strict=True):
                out[k] = raw[at : 4 * e]
                at = 4 * e + 4
        rest = [k for k, x in enumerate(out) if x is None]
        for k, ids in zip(rest, many([pieces[k] for k in rest]) if rest else [], strict=True):
            out[k] = ids
        return out

    return encode


def encoder(path: str):
    """The tokenizer and a function from a string column to the ids of each text; kept, with its memo, as long as the worker."""
    from tokenizers import Tokenizer

    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(path)
        many = lambda texts: [np.array(x.ids, "<u4").tobytes() for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        whole = lambda texts: [np.frombuffer(x, "<u4") for x in many(texts.fill_null("").to_pylist())]
        pieces = PieceIds(by_lines(many), 1_000_000).encode_array
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

        def encode(texts: pa.Array) -> list[np.ndarray]:
            out, named = pieces(texts), np.zeros(len(texts), bool)
            for token in added:  # texts that spell out an added token are cut by the library
                named |= np.asarray(pc.match_substring(texts.fill_null(""), token))
            at = np.flatnonzero(named)
            for k, ids in zip(at.tolist(), whole(texts.take(pa.array(at))) if len(at) else [], strict=True):
                out[k] = ids
            return out

        _ENCODERS[path] = tokenizer, encode if is_byte_level(path) else whole
    return _ENCODERS[path]


class FrameWriter:
    """Writes one file; ``close`` publishes it under its name, so a task that dies leaves no half file there."""

    def __init__(self, uri: str, width: int, level: int = 3) -> None:
        self.fs, self.path = _filesystem(uri)
        self.temporary = f"{self.path}.{os.urandom(6).hex()}"
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.out = self.fs.open_output_stream(self.temporary)
        self.kind, self.packer = f"<u{width}", zstandard.ZstdCompressor(level=level)
        self.index: list[tuple[int, int, int, int]] = []
        self.seek: list[tuple[int, int, int]] = []
        self.n_tokens = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        frames = 0
        for k in range(0, len(ids), IDS_A_FRAME):
            raw = ids[k : k + IDS_A_FRAME].astype(self.kind).tobytes()
            packed = self.packer.compress(raw)
            self.out.write(packed)
            self.seek.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
            frames += 1
        self.index.append((doc_id or 0, doc_id is None, frames, len(ids)))
        self.n_tokens += len(ids)

    def close(self) -> None:
        index = np.array(self.index, INDEX).tobytes()
        seek = np.array(self.seek, SEEK).tobytes() + struct.pack("<IBI", len(self.seek), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        for magic, body in ((SKIPPABLE_INDEX, self.kind[2:].encode() + index), (SKIPPABLE_SEEK, seek)):
            self.out.write(struct.pack("<II", magic, len(body)) + body)
        self.out.close()
        self.fs.move(self.temporary, self.path)


def read_documents(uri: str, wanted: Iterable[int] | None = None) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, ids before it in the file, ids) of the wanted documents, or of all; others stay compressed."""
    fs, path = _filesystem(uri)
    wanted = None if wanted is None else set(wanted)
    with fs.open_input_file(path) as f:
        end = f.size()
        n, flag, magic = struct.unpack("<IBI", f.read_at(9, end - 9))
        if magic != SEEKABLE_MAGIC or flag != CHECKSUM_FLAG:
            raise ValueError(f"{uri} has no seek table")
        seek_at = end - 9 - n * SEEK.itemsize
        seek = np.frombuffer(f.read_at(n * SEEK.itemsize, seek_at), SEEK)
        index_at = int(seek["compressed"].sum(dtype=np.int64))
        magic, size = struct.unpack("<II", f.read_at(8, index_at))
        if magic != SKIPPABLE_INDEX:
            raise ValueError(f"{uri} has no document index")
        body = f.read_at(size, index_at + 8)
        kind, index = f"<u{body[:1].decode()}", np.frombuffer(body[1:], INDEX)
        starts = np.concatenate([[0], np.cumsum(seek["compressed"], dtype=np.int64)])
        unpack, frame, before = zstandard.ZstdDecompressor(), 0, 0
        for doc_id, null, frames, n_tokens in index.tolist():
            if wanted is None or (not null and doc_id in wanted):
                parts = []
                for k in range(frame, frame + frames):
                    raw = unpack.decompress(f.read_at(int(seek["compressed"][k]), int(starts[k])), max_output_size=int(seek["size"][k]))
                    if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != seek["checksum"][k]:
                        raise ValueError(f"{uri}: frame {k} is damaged")
                    parts.append(np.frombuffer(raw, kind))
                yield None if null else doc_id, before, np.concatenate(parts) if parts else np.zeros(0, kind)
            frame, before = frame + frames, before + n_tokens


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int | None, partitions: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files of ascending doc_id; a staged manifest with a row for each file.

    Texts are range-partitioned by doc_id once and encoded behind that shuffle, so the sampling of the range bounds reads ids
    only and nothing is tokenised twice.
    """
    spark = docs.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer, encode_texts = encoder(tokenizer_path)
        width = 2 if max(tokenizer.get_vocab_size(), end_id or 0) <= 1 << 16 else 4
        part = TaskContext.get().partitionId()
        file, writer = f"{folder}/part-{part:06d}.ids", None
        tail = np.array([] if end_id is None else [end_id], np.uint32)
        for batch, _, _ in chunks(batches, "text", 1 << 23):
            writer = writer or FrameWriter(file, width)
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode_texts(batch.column(1)), strict=True):
                writer.add(doc_id, np.append(ids, tail))
        if writer:
            writer.close()
            yield pa.RecordBatch.from_pylist([{"part": part, "file": file, "n_docs": len(writer.index), "n_tokens": writer.n_tokens}], pa.schema([("part", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64())]))

    manifest = dealt.mapInArrow(encode, MANIFEST)
    path = f"{folder}/_manifest"
    manifest.write.parquet(path)  # one evaluation: the files are written by this job alone
    return spark.read.schema(MANIFEST).parquet(path)


def read_token_files(manifest: DataFrame, columns: str = OUT) -> DataFrame:
    """Digest of every document, read back from the files a manifest names; each file is one task's work."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("part", pa.int64()), ("start_in_part", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for part, file in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = []
                for doc_id, before, ids in read_documents(file):
                    rows.append((doc_id, part, before, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(rows) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types, strict=True)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types, strict=True)], schema=schema)

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("part", "file").repartition(n, "part").mapInArrow(read, columns)


def token_starts(manifest: DataFrame, rows: DataFrame) -> DataFrame:
    """Adds ``start``: ids of all documents in earlier files and before it in its own.

    The manifest has one row for each file (one for each write task), so its prefix sums are taken on the driver
    and sent back: two numbers for each file.
    """
    before, total = [], 0
    for part, n in sorted((r.part, r.n_tokens) for r in manifest.select("part", "n_tokens").collect()):
        before.append((part, total))
        total += n
    base = manifest.sparkSession.createDataFrame(before, "part long, base long")
    return rows.join(F.broadcast(base), "part").withColumn("start", F.col("base") + F.col("start_in_part"))


def encode_and_read(docs: DataFrame, tokenizer_path: str, end_id: int | None) -> DataFrame:
    folder = shared_dir(docs.sparkSession)
    manifest = write_token_files(docs, folder, tokenizer_path, end_id)
    return token_starts(manifest, read_token_files(manifest)).select("doc_id", "start", "n_tokens", "ids_crc32")
