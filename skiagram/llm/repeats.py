"""Suffix-array removal of repeated passages: maximal repeats from the common-prefix interval tree.

Goal: every string of ``min_len`` bytes that starts twice or more in the corpus keeps its first occurrence (smallest doc_id,
then smallest position); the bytes under all other occurrences go.

1. Anchors.  Of every window of ``min_len - GRAM + 1`` successive GRAM-byte hashes the smallest (leftmost) is an anchor.  Equal
   strings of ``min_len`` bytes choose the same anchor, so the suffix array of the corpus falls apart into one for each anchor,
   over the surroundings of its occurrences: the context from min_len - GRAM bytes before an anchor to min_len bytes after its
   start.
2. Leaves.  Equal contexts (by 128 bits of hash) are one leaf of the tree with several occurrences: all but the first are repeats
   as a whole.  A task first joins the equal contexts of its own documents, so a passage that half the corpus shares puts one
   row a task, not one a document, into its leaf.  Leaves are dealt by anchor; those of anchors that hold more than a quarter of
   a task's share in a sample of documents are dealt by context, so an anchor in ever different surroundings is spread over the
   tasks.  (The sample decides where rows go and nothing else.)
3. Inner nodes.  Contexts of anchors that have several go, once for each leaf, through an enhanced suffix array: the suffixes of
   at least min_len bytes that share min_len bytes with another are sorted, those bytes and what follows compared, and a stack
   scan of the common-prefix lengths gives the interval tree.  An interval of depth min_len or more is a group of occurrences;
   it is output if its left extensions differ (else the group one byte further left holds the same occurrences).  Groups list
   all occurrences, not just neighbours; all but the first of each are removed.
4. Subtrees.  An interval of depth min_len or more lies in the subtree of its first min_len bytes, so the array of an anchor
   that was dealt by context or has more than ``MOST_LEAVES`` contexts is cut into these subtrees, which go to different tasks.  The root of a subtree
   holds all of its occurrences, and all but the first are removed, which is what its nodes remove together.  A task sends one
   occurrence of each subtree on and settles the others of its chunk, so a hot subtree isn't hot any more.
5. Spans are merged by document and cut out of the text.

Null and empty texts stay empty.  Matches never cross documents.  A null doc_id sorts before all others.  Rows that share a
doc_id but not a text are documents of their own, ordered by a hash of the text; rows equal in both share one result and are no
repeats of each other.  Texts are read whole at any length.  Other columns, whatever their names, are kept by
``without_repeats``; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skiagram.llm.shared import U64, as_bytes, bounded_sample, chunks, flat, mix, prefix_hash, span_hash, staged, tidy, unused_name

GRAM, MIN_LEN = 44, 100
#: Contexts of an anchor whose suffixes one task sorts; the array of an anchor with more is cut into its subtrees.
MOST_LEAVES = 1024
#: Documents in which anchors that hold a large share of all are looked for.
SAMPLE = 10_000
#: pack = position of the anchor << 32 | bytes of context before it << 16 | bytes from its start on; -1 - stop marks a span.
ROWS = "anchor long, context long, doc long, pack long"
SPANS = "doc long, start long, stop long"
#: What goes to the tasks of inner nodes: bytes of a context, the place of a subtree's suffix, or a settled span.
LEAF, ROOT, SETTLED = 0, 1, 2
NODES = "kind int, anchor long, head long, doc long, start long, stop long, bytes binary"
LEAST_ID = -(1 << 63)


def _slide(h: np.ndarray, width: int, pick) -> np.ndarray:
    """pick over every window of ``width``, by doubling."""
    out, span = h, 1
    while span < width:
        step = min(span, width - span)
        out = pick(out[: len(out) - step], out[step:])
        span += step
    return out


def anchors(at: np.ndarray, sums: np.ndarray, gram: int, min_len: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position and hash of the anchors of a chunk, and the document of each: hashes that are the least of some window."""
    none = np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, np.int64)
    if at[-1] < min_len:
        return none
    start = np.arange(at[-1] - gram + 1)
    h = span_hash(sums, start, start + gram)
    width, edge, found = min_len - gram + 1, np.zeros(min_len - gram, U64), []
    for d in np.flatnonzero(np.diff(at) >= min_len).tolist():
        own = h[at[d] : at[d + 1] - gram + 1]
        least = _slide(own, width, np.minimum)
        place = np.flatnonzero(own == _slide(np.concatenate([edge, least, edge]), width, np.maximum))
        found.append((place + at[d], own[place], np.full(len(place), d)))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else none


def merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of spans, by document."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    new_doc = np.append(True, doc[1:] != doc[:-1])
    group = np.cumsum(new_doc) - 1
    low, high = int(start.min()), int(stop.max()) + 1
    if (high - low + 1) * (int(group[-1]) + 1) < 1 << 62:  # running maxima that fall back at each document
        reach = np.maximum.accumulate(stop - low + group * (high - low + 1)) - group * (high - low + 1) + low
    else:
        reach = np.concatenate([np.maximum.accumulate(x) for x in np.split(stop, np.flatnonzero(new_doc)[1:])])
    first = new_doc | np.append(True, start[1:] > reach[:-1])
    at = np.flatnonzero(first)
    return doc[at], start[at], reach[np.append(at[1:], len(doc)) - 1]


def _same_as_before(*columns: np.ndarray) -> np.ndarray:
    """Whether a row equals the row before it in all columns; the first row does not."""
    out = np.zeros(len(columns[0]), bool)
    if len(out):
        out[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in columns])
    return out


def numbered(docs: DataFrame) -> tuple[DataFrame, bool]:
    """``docs`` with a number for each row (``doc``) that sorts like doc_id, and whether several rows may share one.

    The number is the id itself (null the least) if no id comes twice; else the place of (id, hash of the text) in the order
    of all of them, from a range-partitioned sort.
    """
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID))
    total, ids, null = docs.agg(F.count("*"), F.count_distinct("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    number = unused_name(docs, "doc")
    if total == ids + min(null, 1):
        return docs.withColumn(number, own), False
    tie, name = unused_name(docs, "tie"), unused_name(docs, "id")
    rows = docs.withColumns({name: own, tie: F.xxhash64(as_bytes("text"))})
    order = staged(rows.select(name, tie).distinct().orderBy(name, tie).withColumn(number, F.monotonically_increasing_id()))
    return rows.join(order, [name, tie]).drop(name, tie), True


def anchor_rows(rows: DataFrame, gram: int, min_len: int) -> DataFrame:
    """Occurrences of anchors, and spans where a task's own documents settle an occurrence."""
    left = min_len - gram

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple[int, int]] = {}  # contexts found twice in a chunk of this task: their earliest place
        for part, data, at in chunks(batches, "text", 1 << 19):
            sums = prefix_hash(data)
            place, h, owner = anchors(at, sums, gram, min_len)
            if not len(place):
                continue
            doc = part.column(0).to_numpy()
            before, after = np.minimum(place - at[owner], left), np.minimum(at[owner + 1] - place, min_len)
            context = mix(span_hash(sums, place - before, place + after) + before.astype(U64)).view(np.int64)
            own, pos = doc[owner], place - at[owner]
            order = np.lexsort((pos, own, context))
            repeat = _same_as_before(context[order])
            twice = order[np.append(repeat[1:], False) & ~repeat]
            settled = np.zeros(len(order), bool)
            settled[order[repeat]] = True
            if known:
                seen = np.flatnonzero(np.isin(context, np.fromiter(known, np.int64, len(known))) & ~settled)
                for k in seen.tolist():
                    if known[int(context[k])] < (int(own[k]), int(pos[k])):
                        settled[k] = True
            for k in twice.tolist():
                spot = int(own[k]), int(pos[k])
                if len(known) < 1 << 16:
                    known[int(context[k])] = min(known.get(int(context[k]), spot), spot)
            d, a, b = merged(own[settled], (pos - before)[settled], (pos + after)[settled])
            go = ~settled
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([h[go].view(np.int64), mix(d.astype(np.int64).view(U64)).view(np.int64)])), pa.array(np.concatenate([context[go], a])), pa.array(np.concatenate([own[go], d])), pa.array(np.concatenate([pos[go] << 32 | before[go] << 16 | after[go], -1 - b]))],
                ["anchor", "context", "doc", "pack"],
            )

    return rows.select("doc", "text").mapInArrow(run, ROWS)


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def large_anchors(rows: DataFrame, gram: int, min_len: int, sample: int = SAMPLE) -> list[int]:
    """Anchors with more than a quarter of a task's share of the rows of a sample: at most four for each task."""
    n = partitions(rows)
    some = anchor_rows(bounded_sample(rows, "doc", sample, "anchors"), gram, min_len).filter("pack >= 0").groupBy("anchor").agg(F.count("*").alias("n"))
    some = staged(some)
    total = some.agg(F.sum("n")).first()[0] or 0
    return [r.anchor for r in some.filter(F.col("n") > max(total / (4 * n), 32)).collect()]


def leaves(rows: DataFrame, large: list[int], most: int) -> DataFrame:
    """Spans of all but the first of equal contexts (anchor null), and the first of each context of anchors that have several;
    ``cut`` tells that the anchor's array goes by subtrees."""
    by_context = np.array(large, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = WholeGroups("anchor", 1 << 15)

        def settle(group: pa.RecordBatch) -> pa.RecordBatch:
            anchor, context, doc, pack = (c.to_numpy() for c in group.columns)
            ready = pack < 0
            found = [(doc[ready], context[ready], -1 - pack[ready])]
            anchor, context, doc, pack = (x[~ready] for x in (anchor, context, doc, pack))
            again = _same_as_before(anchor, context)
            pos, before, after = pack >> 32, pack >> 16 & 0xFFFF, pack & 0xFFFF
            found.append((doc[again], (pos - before)[again], (pos + after)[again]))
            d, a, b = merged(*(np.concatenate(x) for x in zip(*found, strict=True)))
            number = np.cumsum(~_same_as_before(anchor)) - 1
            n = np.bincount(number, ~again).astype(np.int64)[number] if len(anchor) else again.astype(np.int64)
            cut = (n > most) | np.isin(anchor, by_context)
            go = ~again & (cut | (n > 1))
            none = np.zeros(len(d), bool)
            return pa.RecordBatch.from_arrays([pa.concat_arrays([pa.nulls(len(d), pa.int64()), pa.array(anchor[go])]), pa.array(np.concatenate([d, doc[go]])), pa.array(np.concatenate([a, (pos - before)[go]])), pa.array(np.concatenate([b, (pos + after)[go]])), pa.array(np.concatenate([none, cut[go]]))], ["anchor", "doc", "start", "stop", "cut"])

        for batch in batches:
            if batch.num_rows:
                yield from map(settle, groups.add(batch))
        yield from map(settle, groups.rest())
        tidy()

    deal = F.when(F.col("anchor").isin(large), F.col("context")).otherwise(F.col("anchor")) if large else F.col("anchor")
    dealt = rows.repartition(partitions(rows), deal).sortWithinPartitions("anchor", "context", "doc", "pack")
    return dealt.mapInArrow(run, f"anchor long, {SPANS}, cut boolean")


def nodes(rows: DataFrame, firsts: DataFrame, min_len: int) -> DataFrame:
    """The bytes of contexts; the suffixes at which subtrees start instead for anchors whose array is cut."""
    lists = firsts.groupBy("doc").agg(F.collect_list(F.struct("anchor", "start", "stop", "cut")).alias("at"))
    names = [f.split()[0] for f in NODES.split(", ")]

    def batch(kind: int, anchor: np.ndarray, head: np.ndarray, doc: np.ndarray, start: np.ndarray, stop: np.ndarray, raw: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(doc), kind, np.int32)), *(pa.array(x) for x in (anchor, head, doc, start, stop)), raw], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in chunks(batches, "text", 1 << 19):
            where = part.column(2)
            row = np.repeat(np.arange(part.num_rows), np.diff(where.offsets.to_numpy()))
            anchor, start, stop, cut = (f.to_numpy(zero_copy_only=False) for f in where.flatten().flatten())
            doc = part.column(0).to_numpy()[row]
            whole, raw = ~cut, data.tobytes()
            a, b = (start + at[row])[whole].tolist(), (stop + at[row])[whole].tolist()
            yield batch(LEAF, anchor[whole], np.zeros(len(a), np.int64), doc[whole], start[whole], stop[whole], pa.array([raw[i:j] for i, j in zip(a, b, strict=True)], pa.binary()))
            if not cut.any():
                continue
            anchor, start, stop, doc, row = anchor[cut], start[cut], stop[cut], doc[cut], row[cut]
            n = stop - start - min_len + 1
            own = np.repeat(np.arange(len(n)), n)
            begin = start[own] + np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
            place = begin + at[row[own]]
            head = span_hash(prefix_hash(data), place, place + min_len).view(np.int64)
            anchor, doc = anchor[own], doc[own]
            order = np.lexsort((begin, doc, head, anchor))
            anchor, head, doc, begin = (x[order] for x in (anchor, head, doc, begin))
            place_again = _same_as_before(anchor, head, doc, begin)  # contexts of a document that overlap
            anchor, head, doc, begin = (x[~place_again] for x in (anchor, head, doc, begin))
            again = _same_as_before(anchor, head)
            first = ~again
            none = pa.nulls(int(first.sum()), pa.binary())
            yield batch(ROOT, anchor[first], head[first], doc[first], begin[first], begin[first] + min_len, none)
            d, x, y = merged(doc[again], begin[again], begin[again] + min_len)
            yield batch(SETTLED, mix(d.astype(np.int64).view(U64)).view(np.int64), x, d, x, y, pa.nulls(len(d), pa.binary()))

    return rows.join(lists, "doc").select("doc", "text", "at").mapInArrow(run, NODES)


class WholeGroups:
    """Gathers sorted batches into pieces of at least ``least`` rows, as far as there are, that end where the column changes.
    Batches that only go on with the last group are kept beside it, so a group of any size is put together once."""

    def __init__(self, column: str, least: int) -> None:
        self.column, self.least = column, least
        self.held: list[pa.RecordBatch] = []

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        key = batch.column(self.column)
        goes_on = bool(self.held) and self.held[-1].column(self.column)[-1] == key[0] == key[-1]
        self.held.append(batch)
        if goes_on:
            return
        rows, begin = pa.concat_batches(self.held), 0
        key = rows.column(self.column).to_numpy()
        for edge in (np.flatnonzero(key[1:] != key[:-1]) + 1).tolist():
            if edge - begin >= self.least:
                yield rows.slice(begin, edge - begin)
                begin = edge
        self.held = [rows.slice(begin)]

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            yield pa.concat_batches(self.held)
        self.held = []


def maximal_intervals(lcp: list[int], left: list[int]) -> list[tuple[int, int, int]]:
    """(first, last, depth) of the nodes of the interval tree whose suffixes have different left extensions.

    ``lcp[k]`` is the common prefix of suffixes k and k + 1; one stack scan, with the common left extension carried along.
    """
    out: list[tuple[int, int, int]] = []
    stack: list[list] = []
    for k in range(len(left)):
        depth, low, same = lcp[k] if k < len(lcp) else -1, k, left[k]
        while stack and stack[-1][0] > depth:
            d, low, other = stack.pop()
            same = same if same == other else None
            if same is None:
                out.append((low, k, d))
        if depth < 0:
            continue
        if stack and stack[-1][0] == depth:
            if stack[-1][2] != same:
                stack[-1][2] = None
        else:
            stack.append([depth, low, same])
    return out


def maximal_repeats(data: np.ndarray, at: np.ndarray, group: np.ndarray, min_len: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal repeats of ``min_len`` bytes or more among contexts of the same group: occurrences (places in ``data``, one repeat
    after the other), how many each repeat has, and its length.

    The suffix array is kept for the suffixes that share ``min_len`` bytes with another one; it lists them by that prefix, then
    by what follows.  Prefixes are found by hash and compared byte by byte.
    """
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    tail = int(np.diff(at).max(initial=0)) - min_len
    if tail < 0:
        return none
    end = np.repeat(at[1:], np.diff(at))
    start = np.flatnonzero(np.arange(len(data)) + min_len <= end)
    owner = np.searchsorted(at, start, "right") - 1
    head = mix(span_hash(prefix_hash(data), start, start + min_len) + mix(group[owner].astype(np.int64).view(U64)))
    order = np.argsort(head, kind="stable")
    same = head[order[1:]] == head[order[:-1]]
    shared = order[np.append(same, False) | np.append(False, same)]
    start, head = start[shared], head[shared]
    if not len(start):
        return none
    owner = np.searchsorted(at, start, "right") - 1
    rest = at[owner + 1] - start - min_len
    words = -(-tail // 8)
    padded = np.concatenate([data, np.zeros(8 * words + min_len, np.uint8)])
    follow = np.lib.stride_tricks.sliding_window_view(padded, 8 * words)[start + min_len] if words else np.zeros((len(start), 0), np.uint8)
    follow[np.arange(8 * words) >= rest[:, None]] = 0
    keys = follow.view(">u8") if words else np.zeros((len(start), 0), np.int64)
    array = np.lexsort((start, rest, *(keys[:, k] for k in range(words - 1, -1, -1)), head))
    start, head, rest, follow, owner = start[array], head[array], rest[array], follow[array], owner[array]
    joined = head[1:] == head[:-1]
    prefix = np.lib.stride_tricks.sliding_window_view(padded, min_len)[start]
    joined &= (prefix[1:] == prefix[:-1]).all(1)
    differ = follow[1:] != follow[:-1]
    common = np.where(differ.any(1), differ.argmax(1), 8 * words) if words else np.zeros(len(start) - 1, np.int64)
    lcp = np.where(joined, min_len + np.minimum(common, np.minimum(rest[1:], rest[:-1])), -1)
    left = np.where(start > at[owner], data[np.maximum(start - 1, 0)].astype(np.int64), -1 - np.arange(len(start)))
    first = np.flatnonzero(np.append(True, ~joined))
    size = np.diff(np.append(first, len(start)))
    two = first[size == 2]
    two = two[left[two] != left[two + 1]]
    place, many, length = [start[np.stack([two, two + 1], 1).ravel()]], [np.full(len(two), 2)], [lcp[two]]
    for f, k in zip(first[size > 2].tolist(), size[size > 2].tolist(), strict=True):
        found = maximal_intervals(lcp[f : f + k - 1].tolist(), left[f : f + k].tolist())
        if found:
            low, high, depth = np.array(found).T
            place += [start[f + a : f + b + 1] for a, b in zip(low.tolist(), high.tolist(), strict=True)]
            many.append(high - low + 1)
            length.append(depth)
    return tuple(np.concatenate(x).astype(np.int64) for x in (place, many, length))


def _later(group: pa.RecordBatch, min_len: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of all but the first occurrence of each maximal repeat among whole groups of contexts."""
    anchor, doc, begin = (group.column(c).to_numpy() for c in ("anchor", "doc", "start"))
    data, at = flat(group.column("bytes"))
    place, many, length = maximal_repeats(data, at, anchor, min_len)
    repeat = np.repeat(np.arange(len(many)), many)
    own = np.searchsorted(at, place, "right") - 1
    own_doc, where, span = doc[own], begin[own] + place - at[own], length[repeat]
    order = np.lexsort((where, own_doc, repeat))  # the first of a repeat leads; overlapping contexts show one place twice
    repeat, own_doc, where, span = (x[order] for x in (repeat, own_doc, where, span))
    head = (np.cumsum(many) - many)[repeat] if len(many) else repeat
    again = (own_doc != own_doc[head]) | (where != where[head])
    return merged(own_doc[again], where[again], (where + span)[again])


def inner_spans(found: DataFrame, min_len: int) -> DataFrame:
    """Spans of all but the first occurrence of each maximal repeat of an anchor's array, or of a subtree cut from it."""

    def out(spans: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        if spans:
            d, a, b = merged(*(np.concatenate(x) for x in zip(*spans, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(d), pa.array(a), pa.array(b)], ["doc", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = WholeGroups("anchor", MOST_LEAVES)
        last, lead = None, (0, 0)  # subtree of the row before, and its first occurrence
        for batch in batches:
            kind, anchor, head, doc, start, stop = (batch.column(k).to_numpy() for k in range(6))
            n = int(np.searchsorted(kind, ROOT))
            spans = [_later(g, min_len) for g in groups.add(batch.slice(0, n))] if n else []
            root, ready = kind == ROOT, kind == SETTLED
            if root.any():
                a, h, d, s = (x[root] for x in (anchor, head, doc, start))
                again = _same_as_before(a, h)
                again[0] = (a[0], h[0]) == last
                at = np.maximum.accumulate(np.where(again, -1, np.arange(len(a))))
                lead_d, lead_s = (np.where(at >= 0, x[at], y) for x, y in zip((d, s), lead, strict=True))
                last, lead = (a[-1], h[-1]), (lead_d[-1], lead_s[-1])
                go = again & ((d != lead_d) | (s != lead_s))
                spans.append((d[go], s[go], stop[root][go]))
            spans.append((doc[ready], start[ready], stop[ready]))
            yield from out(spans)
        yield from out([_later(g, min_len) for g in groups.rest()])
        tidy()

    return found.repartition(partitions(found), "anchor", "head").sortWithinPartitions("kind", "anchor", "head", "doc", "start").mapInArrow(run, SPANS)


def repeated_spans(rows: DataFrame, min_len: int, gram: int, most: int) -> DataFrame:
    """(doc, start, stop) of what goes, for rows of different ``doc``; spans of a document may overlap."""
    found = staged(leaves(anchor_rows(rows, gram, min_len), large_anchors(rows, gram, min_len), most))
    ends = staged(inner_spans(nodes(rows, found.filter("anchor is not null"), min_len), min_len))
    return found.filter("anchor is null").select("doc", "start", "stop").unionByName(ends)


def with_spans(docs: DataFrame, number: str, repeated: bool, min_len: int, gram: int = GRAM, most: int = MOST_LEAVES) -> DataFrame:
    """doc (the number), text (bytes) and spans (starts and stops of what goes, null if nothing), once for each number."""
    rows = docs.select(F.col(number).alias("doc"), as_bytes("text").alias("text"))
    if repeated:
        rows = rows.dropDuplicates(["doc"])
    lists = repeated_spans(rows, min_len, gram, most).groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    return rows.join(lists, "doc", "left").select("doc", "text", "spans")


def _cut(part: pa.RecordBatch, data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    """Removed bytes, removed runs and what is left of each document."""
    where = part.column(part.schema.get_field_index("spans"))
    n = np.diff(where.fill_null([]).offsets.to_numpy())
    start, stop = (f.to_numpy() for f in where.flatten().flatten())
    doc, start, stop = merged(np.repeat(np.arange(part.num_rows), n), start, stop)
    edge = np.searchsorted(doc, np.arange(part.num_rows + 1))
    for k in range(part.num_rows):
        own = data[at[k] : at[k + 1]]
        a, b = start[edge[k] : edge[k + 1]], stop[edge[k] : edge[k + 1]]
        if not len(a):
            yield 0, 0, own.tobytes()
            continue
        raw = own.tobytes()
        kept = b"".join(raw[i:j] for i, j in zip([0, *b.tolist()], [*a.tolist(), len(raw)], strict=True))
        yield len(raw) - len(kept), len(a), kept


def digests(docs: DataFrame, min_len: int = MIN_LEN, most: int = MOST_LEAVES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in chunks(batches, "text"):
            gone, runs, kept = zip(*_cut(part, data, at), strict=True)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(at)), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())], ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    own, repeated = numbered(docs.select("doc_id", "text"))
    out = with_spans(own, "doc", repeated, min_len, most=most).mapInArrow(run, "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    id_ = F.when(F.col("doc") > F.lit(LEAST_ID), F.col("doc")).alias("doc_id")
    if repeated:
        out, id_ = own.select("doc", F.col("doc_id").cast("long").alias("doc_id")).join(out, "doc"), F.col("doc_id")
    return out.select(id_, "n_bytes", "n_removed", "n_spans", "kept_sha256")


def without_repeats(docs: DataFrame, min_len: int = MIN_LEN, most: int = MOST_LEAVES) -> DataFrame:
    """``docs`` with text cut (bytes of a character cut in two go too) and n_chars, if there, made to fit; null text stays null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in chunks(batches, "text"):
            kept = [k.decode("utf-8", "ignore") for _, _, k in _cut(part, data, at)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(kept, pa.string())], ["doc", "kept"])

    own, repeated = numbered(docs)
    number, name = own.columns[-1], unused_name(docs, "kept")
    cut = with_spans(own, number, repeated, min_len, most=most).filter("spans is not null").mapInArrow(run, "doc long, kept string")
    out = own.join(cut.select(F.col("doc").alias(number), F.col("kept").alias(name)), number, "left")
    kept = F.col(name)
    made = {"text": F.when(F.col("text").isNotNull(), F.coalesce(kept, F.col("text")))}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(kept.isNotNull(), F.length(kept)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return out.select(*[made[c].alias(c) if c in made else F.col(f"`{c}`") for c in docs.columns])
