"""Ids of whole texts from ids of the pieces that byte-level BPE treats apart.

Pre-tokenisation by the public pattern never lets a token cross a single space between two characters that are not white space:
such a space can only begin a token.  A text without runs of white space, or any at its ends, is therefore cut before each of its
spaces; a batch of texts is cut and its distinct pieces found by Arrow, so Python sees each distinct piece once a batch.  Ids of
pieces are kept up to a bound; pieces met after that are encoded for their batch only.  Texts with runs of white space go whole
through ``CUT``, which leaves such runs alone.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

KEPT, LONGEST = 150_000, 64
#: A single space between characters that are not white space is where a text may be cut.
CUT = re.compile(r"(?<=\S) (?=\S)")
_SPACE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
UNEVEN = rf"{_SPACE}{_SPACE}|^{_SPACE}|{_SPACE}$"
NONE = np.zeros(0, "<u4")


#: One character of each kind that patterns tell apart, and contractions.
KINDS = ["a", "Z", "é", "ж", "漢", "ا", "1", "٣", ".", "'", "-", "€", "\U0001f600", "\u0301", "\x00", "'s", "ab12", "_"]


def cuts_at_spaces(split: Callable[[str], list[str]]) -> bool:
    """Whether a pattern splits a text before a single space as it splits the two parts, for all kinds of characters around it."""
    return all(split(f"{a} {b}") == split(a) + split(f" {b}") for a in KINDS for b in KINDS)


class PieceIds:
    """``encode_many`` gives the ids, as little-endian unsigned 32-bit integers, of each of a list of strings."""

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], kept: int = KEPT, cut: bool = True) -> None:
        self.encode_many, self.most, self.cut = encode_many, kept, cut
        self.kept: dict[str, bytes] = {}  # pieces after a space, without it

    def _ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces after a space."""
        out = list(map(self.kept.get, pieces))
        new = [k for k, ids in enumerate(out) if ids is None]
        if new:
            got = self.encode_many([" " + pieces[k] for k in new])
            for k, ids in zip(new, got, strict=True):
                out[k] = ids
            if len(self.kept) < self.most:
                self.kept.update((pieces[k], ids) for k, ids in zip(new, got, strict=True) if len(pieces[k]) <= LONGEST)
        return out

    def _even(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.split_pattern(texts, " ")
        at = lists.offsets.to_numpy().astype(np.int64)
        pieces = lists.values.slice(at[0], at[-1] - at[0]).dictionary_encode()
        at -= at[0]
        codes = pieces.indices.to_numpy().astype(np.int64)
        blobs = self._ids(pieces.dictionary.to_pylist())
        heads = pieces.dictionary.take(pa.array(codes[at[:-1]])).dictionary_encode()
        codes[at[:-1]] = len(blobs) + heads.indices.to_numpy()
        blobs += self.encode_many(heads.dictionary.to_pylist())
        size = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 4
        ids = np.frombuffer(b"".join(blobs), "<u4")
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        n = size[codes]
        end = np.cumsum(n)
        places = np.repeat(start[codes] - (end - n), n) + np.arange(end[-1])
        return ids[places], np.concatenate([[0], end])[at]

    def encode_array(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a string column; null is empty."""
        texts = texts.fill_null("")
        if not self.cut:
            return [np.frombuffer(ids, "<u4") for ids in self.encode_many(texts.to_pylist())]
        uneven = np.asarray(pc.match_substring_regex(texts, UNEVEN)) | (np.asarray(pc.binary_length(texts)) == 0)
        out: list[np.ndarray] = [NONE] * len(texts)
        even = np.flatnonzero(~uneven)
        if len(even):
            ids, at = self._even(texts.take(pa.array(even)))
            for k, a, b in zip(even.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                out[k] = ids[a:b]
        for k in np.flatnonzero(uneven).tolist():
            if text := texts[k].as_py():
                first, *rest = CUT.split(text)
                out[k] = np.frombuffer(b"".join([*self.encode_many([first]), *self._ids(rest)]), "<u4")
        return out
