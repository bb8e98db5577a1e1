"""Quality by line labelling: a linear-chain conditional random field marks each line as content or boilerplate.

Lines (split at \\n, those with a word) are the chain.  A line has a few numeric features: shares of letters, upper case, digits,
symbols and marks, words without a letter or digit, its length, whether it repeats an earlier line or its own words, whether it
ends like a sentence.  Viterbi decoding gives the best labelling; a text is kept if lines marked as content hold at least
``CONTENT_SHARE`` of its word characters.  Texts that fail the base rules (under 50 words, or over half of their words inside
repeated 3-word windows) are not kept.

There are no line labels, so the field is fitted to the documents' quality labels: lines of labelled good texts count as
content, lines of labelled bad texts as boilerplate, by maximum conditional likelihood over about ``MOST`` labelled texts (a
hash sample outside the held-out fold, of texts with at most ``TRAIN_LINES`` lines; both bounds are parameters and concern the
fit alone).  The chain smooths what single lines leave open.  The model is some forty numbers.  Without labels a fixed prior
is used.  Viterbi runs over all texts of a chunk at once, step by step over the line number.

Null texts have no words, all counts 0, and fail the base.  Very long texts and lines are read whole.  Repeated rows get equal
rows.  Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skiagram.llm.shared import as_bytes, bounded_sample, chunks, held_out, prefix_hash, span_hash, words

MOST, TRAIN_LINES, CONTENT_SHARE = 4_000, 64, 0.5
LEAST_WORDS, REPEAT_PERCENT = 50, 50
SYMBOLS = b"#*$%&|<>"

_IS = {name: np.zeros(256, np.int32) for name in ("upper", "lower", "digit", "symbol", "mark", "high")}
_IS["upper"][65:91] = _IS["lower"][97:123] = _IS["digit"][48:58] = _IS["high"][0xC0:] = 1
_IS["symbol"][list(SYMBOLS)] = 1
_IS["mark"][list(b"!?=/\\_@~^{}[]+;:\"")] = 1
FEATURES = ("bias", "symbol", "upper", "digit", "mark", "letter", "length", "short", "duplicate", "repeats", "ends", "word_length", "bare", "some_symbols")
#: Emission of boilerplate over content, without labels.
PRIOR = np.array([-2.0, 12.0, 4.0, 4.0, 6.0, 0.0, -0.2, 0.0, 2.5, 2.5, -0.3, 0.0, 4.0, 0.0])


class Chunk:
    """Words, lines and base counts of a chunk of documents."""

    def __init__(self, data: np.ndarray, at: np.ndarray) -> None:
        self.n = len(at) - 1
        start, end, before = words(data, at)
        doc = np.repeat(np.arange(self.n), np.diff(before))
        points = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=points[1:])
        chars = points[end] - points[start]
        total = lambda x: np.bincount(doc, x, self.n).astype(np.int64)
        self.n_words, self.word_chars = np.diff(before), total(chars)
        symbol = np.concatenate([[0], np.cumsum(_IS["symbol"][data])])
        self.n_symbols = symbol[at[1:]] - symbol[at[:-1]]
        sums = prefix_hash(data)
        word_hash = span_hash(sums, start, end)
        repeated = self._repeated(word_hash, before)
        self.n_repeat = total(repeated)
        # lines: between breaks, of one document, with a word
        breaks = np.flatnonzero(data == 10)
        edges = np.unique(np.concatenate([at[:-1], breaks + 1]))
        line_of_word = np.searchsorted(edges, start, "right") - 1
        line, first = np.unique(line_of_word, return_index=True)
        self.line_doc = doc[first] if len(first) else np.zeros(0, np.int64)
        line_start = edges[line]
        line_end = np.append(edges, len(data))[line + 1]
        line_end = np.minimum(line_end, at[self.line_doc + 1])
        text_end = line_end - ((line_end > line_start) & (data[np.maximum(line_end - 1, 0)] == 10)) if len(line) else line_end
        key = span_hash(sums, line_start, text_end)
        order = np.lexsort((np.arange(len(key)), key, self.line_doc))
        same = np.zeros(len(key), bool)
        same[order[1:]] = (key[order[1:]] == key[order[:-1]]) & (self.line_doc[order[1:]] == self.line_doc[order[:-1]])
        self.n_dup_lines = np.bincount(self.line_doc, same, self.n).astype(np.int64)
        per = lambda x: np.add.reduceat(x, first) if len(first) else np.zeros(0)
        self.line_chars = per(chars).astype(np.float64)
        n = np.maximum(self.line_chars, 1)
        n_words = np.diff(np.append(first, len(start)))
        share = {}
        for name, table in _IS.items():
            c = np.concatenate([[0], np.cumsum(table[data])])
            share[name] = (c[text_end] - c[line_start]) / n
        letters = share["upper"] + share["lower"] + share["high"]
        plain = np.concatenate([[0], np.cumsum(_IS["upper"][data] + _IS["lower"][data] + _IS["digit"][data] + _IS["high"][data])])
        bare = per((plain[end] == plain[start]).astype(np.int64)) / n_words
        tail = data[end[np.append(first[1:], len(start)) - 1] - 1] if len(first) else np.zeros(0, np.uint8)
        self.x = np.stack([np.ones(len(n)), np.minimum(share["symbol"], 1), share["upper"] / np.maximum(letters, 1e-9), np.minimum(share["digit"], 1), np.minimum(share["mark"], 1), np.minimum(letters, 1), np.log1p(n) / 5, n_words < 5, same, per(repeated) / n_words, np.isin(tail, list(b".!?")), np.minimum(n / n_words, 20) / 10, bare, np.minimum(10 * share["symbol"], 1)], 1).astype(np.float64)

    def _repeated(self, h: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Whether each word lies in a 3-word window found twice or more in its document."""
        out = np.zeros(len(h), bool)
        _, ids = np.unique(h, return_inverse=True)
        for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
            if b - a < 4:
                continue
            w = ids[a:b]
            _, pair = np.unique(w[:-1] * (len(h) + 1) + w[1:], return_inverse=True)
            _, window, n = np.unique(pair[:-1] * (len(h) + 1) + w[2:], return_inverse=True, return_counts=True)
            hit = n[window] > 1
            out[a : b - 2] |= hit
            out[a + 1 : b - 1] |= hit
            out[a + 2 : b] |= hit
        return out


def _padded(line_doc: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines by (step, document), with documents ordered by falling number of lines."""
    length = np.bincount(line_doc, minlength=n)
    order = np.argsort(-length, kind="stable")
    step = np.arange(len(line_doc)) - np.concatenate([[0], np.cumsum(length)])[line_doc]
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    alive = np.array([np.count_nonzero(length > t) for t in range(length.max(initial=0))], np.int64) if n else np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.cumsum(alive)])
    at = starts[step] + place[line_doc]
    packed = np.empty_like(values)
    packed[at] = values
    return packed, starts, alive, at


def viterbi(line_doc: np.ndarray, emission: np.ndarray, transition: np.ndarray, n: int) -> np.ndarray:
    """Best labels (0 content, 1 boilerplate) of all lines; emission is lines x 2, lines of a document stand together."""
    packed, starts, alive, at = _padded(line_doc, emission, n)
    back = np.zeros(packed.shape, np.int8)
    best = packed.copy()
    for t in range(1, len(alive)):
        a, was = alive[t], best[starts[t - 1] : starts[t - 1] + alive[t]]
        ways = was[:, :, None] + transition
        pick = ways.argmax(1)
        back[starts[t] : starts[t] + a] = pick
        best[starts[t] : starts[t] + a] += np.take_along_axis(ways, pick[:, None, :], 1)[:, 0]
    label = np.zeros(len(packed), np.int8)
    for t in range(len(alive) - 1, -1, -1):
        own = slice(starts[t], starts[t] + alive[t])
        more = alive[t + 1] if t + 1 < len(alive) else 0
        label[own] = best[own].argmax(1)
        if more:
            later = np.arange(starts[t + 1], starts[t + 1] + more)
            label[starts[t] : starts[t] + more] = back[later, label[later]]
    return label[at]


def _likelihood(packed: np.ndarray, starts: np.ndarray, alive: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of labels and expected transition counts, by forward and backward passes in log space."""
    lse = lambda x, axis: np.logaddexp.reduce(x, axis)
    fore, aft = packed.copy(), np.zeros_like(packed)
    for t in range(1, len(alive)):
        was = fore[starts[t - 1] : starts[t - 1] + alive[t]]
        fore[starts[t] : starts[t] + alive[t]] += lse(was[:, :, None] + transition, 1)
    pairs = np.zeros((2, 2))
    for t in range(len(alive) - 2, -1, -1):
        m = alive[t + 1]
        nxt = slice(starts[t + 1], starts[t + 1] + m)
        ahead = packed[nxt] + aft[nxt]
        aft[starts[t] : starts[t] + m] = lse(transition + ahead[:, None, :], 2)
        joint = fore[starts[t] : starts[t] + m][:, :, None] + transition + ahead[:, None, :]
        joint -= lse(lse(joint, 2), 1)[:, None, None]
        pairs += np.exp(joint).sum(0)
    marginal = fore + aft
    return np.exp(marginal - lse(marginal, 1)[:, None]), pairs


def fit(x: np.ndarray, y: np.ndarray, line_doc: np.ndarray, n: int, rounds: int = 150, l2: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Emission weights of boilerplate over content and transitions, by Adam on the conditional likelihood."""
    packed_x, starts, alive, at = _padded(line_doc, x, n)
    label = np.empty(len(y), np.int64)
    label[at] = y
    found = np.zeros((2, 2))
    for t in range(1, len(alive)):
        np.add.at(found, (label[starts[t - 1] : starts[t - 1] + alive[t]], label[starts[t] : starts[t] + alive[t]]), 1)
    theta = np.concatenate([PRIOR * 0.1, np.zeros(4)])
    m, v, d = np.zeros_like(theta), np.zeros_like(theta), x.shape[1]
    for k in range(1, rounds + 1):
        e = np.stack([np.zeros(len(x)), packed_x @ theta[:d]], 1)
        marginal, pairs = _likelihood(e, starts, alive, theta[d:].reshape(2, 2))
        g = np.concatenate([packed_x.T @ (marginal[:, 1] - label), (pairs - found).ravel()]) / max(len(y), 1) + l2 * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta = theta - 0.15 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return theta[:d], theta[d:].reshape(2, 2)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    known = labels.filter(F.col(label).isNotNull() & ~held_out()).select("doc_id", F.col(label).cast("int").alias("label"))
    chosen = bounded_sample(known, "doc_id", most, "quality")
    rows = chosen.join(docs.select("doc_id", as_bytes("text").alias("text")), "doc_id").select("doc_id", "label", "text")

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in chunks(batches, "text"):
            c = Chunk(data, at)
            short = np.bincount(c.line_doc, minlength=c.n)[c.line_doc] <= TRAIN_LINES
            doc, y = part.column(0).to_numpy(), part.column(1).to_numpy()
            flat = pa.array(c.x[short].ravel())
            yield pa.RecordBatch.from_arrays([pa.array(doc[c.line_doc[short]]), pa.array(np.flatnonzero(short)), pa.array((y[c.line_doc[short]] != 1).astype(np.int32)), pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, c.x.shape[1], dtype=np.int32)), flat)], ["doc_id", "line", "y", "x"])

    got = rows.mapInArrow(lines, "doc_id long, line long, y int, x array<double>").toPandas().sort_values(["doc_id", "line"])
    if got["y"].nunique() < 2:
        return PRIOR, np.array([[0.5, -0.5], [-0.5, 0.5]])
    ids, line_doc = np.unique(got["doc_id"].to_numpy(), return_inverse=True)
    y = got["y"].to_numpy()
    return fit(np.stack(got["x"].to_numpy()), y, line_doc, len(ids))


def assessed(docs: DataFrame, weights: np.ndarray, transition: np.ndarray, share: float = CONTENT_SHARE) -> DataFrame:
    """Base counts, base_failed, n_content_lines, content_share and kept of every document."""
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_content_lines long, content_share double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in chunks(batches, "text"):
            c = Chunk(data, at)
            label = viterbi(c.line_doc, np.stack([np.zeros(len(c.x)), c.x @ weights], 1), transition, c.n)
            content = np.bincount(c.line_doc, (label == 0) * c.line_chars, c.n) / np.maximum(np.bincount(c.line_doc, c.line_chars, c.n), 1)
            failed = (c.n_words < LEAST_WORDS) | (100 * c.n_repeat > REPEAT_PERCENT * c.n_words)
            arrays = [c.n_words, c.word_chars, c.n_symbols, c.n_dup_lines, c.n_repeat, failed, ~failed & (content >= share), np.bincount(c.line_doc, label == 0, c.n).astype(np.int64), content]
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(np.asarray(x)) for x in arrays)], [f.split()[0] for f in schema.split(", ")])

    return docs.select("doc_id", as_bytes("text").alias("text")).mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame, most: int = MOST) -> DataFrame:
    return assessed(docs, *train(docs, labels, most=most))
