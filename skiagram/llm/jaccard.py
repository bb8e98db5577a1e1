"""Exact n-gram Jaccard join by a size-aware heavy-light method.

A document is the set of 64-bit hashes of its word shingles; documents of equal sets form a class with one representative.
Two sets of n and m shingles link when (num + den) * overlap >= num * (n + m), which needs an overlap of
c(n, m) = ceil(num * (n + m) / (num + den)).

* Light sets (n up to a boundary) enumerate their subsets of each size c(n, m) that a partner may need; two light sets link
  exactly if they have such a subset in common, so a shared subset is the proof and no text is read again.
* Heavy sets go into inverted lists under the first n - ceil(num * n / den) + 1 shingles of one global order, by the prefix
  principle: linked sets share one of them.  The order puts shingles that are frequent in a sample last (order affects cost only,
  never the result).  A list is scanned for members whose 256-bit sketches (one bit of each of 256 minima, each of a hash of its
  own) agree in so many places that linked sets, which agree in each with a probability of (1 + J) / 2, fall short of it with one
  below ``LOSS``, by the exact binomial tail.  That is less than the chance that the 64-bit hashes of two sets' shingles collide.
  These pairs are candidates, and connected candidates are verified exactly from the texts; ``Rule(exact=True)`` scans lists
  without sketches, every two members being candidates.
* The boundary is where enumerating gets dearer than listing and verifying: the cost of a set depends on its own size only, so
  the cheapest split compares the two costs size by size.

Components are kept instead of pairs: within a list and within a verified block, members already connected are not compared
again, so a group of n near copies costs about n comparisons and n links.  As tasks that scan lists know nothing of each other,
each would link a large group anew; so lists under the ``FEW`` least hashes of each set, which copies mostly share, are scanned
first, with at most that many links a set, and all lists are then scanned for links between the components found.  A class has one
set in the lists.  Verification deals a large candidate component in
blocks of bounded size that each hold its first set too, so a text is read once; only if links within the blocks leave it in
several pieces, members of different pieces meet in pairs of blocks.  Equal sets of a task find their class through their first
one, so a hot group of copies puts at most one entry for each task into a join.

Null and empty texts, and texts without a word, have no shingles and stay alone.  A text of fewer words than a shingle is one
shingle.  Rows without a doc_id get a null component.  Rows that share an id but not a text are documents of their own (by a
64-bit hash of both); rows equal in both are one document.  Texts of any length are read whole.  Other columns, whatever their
names, are kept by ``first_of_components``; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skiagram.llm.components import connected_components, limit, spread_join
from skiagram.llm.shared import TO_LOWER, U64, as_bytes, bounded_sample, chunks, mix, prefix_hash, shingle_hashes, span_hash, staged, unused_name, words

SAMPLE, FREQUENT, MOST_FREQUENT = 2_000, 3, 1 << 20
BLOCK_SETS, BLOCK_SHINGLES, LIST_ROWS = 2_000, 1 << 20, 20_000
FEW, FEW_ROWS = 4, 2_000
BITS, LOSS = 256, 1e-18
_RNG = np.random.default_rng(99)
_ROLLS = _RNG.integers(0, 1 << 31, BITS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SALTS = _RNG.integers(0, 1 << 32, BITS, dtype=np.uint32)


def least_agreement(bits: int, p: float, loss: float) -> int:
    """The largest t with P[Binomial(bits, p) < t] <= loss."""
    below = 0.0
    for t in range(bits):
        below += comb(bits, t) * p**t * (1 - p) ** (bits - t)
        if below > loss:
            return t
    return bits


class Rule:
    """Shingle size and threshold num / den, and what follows from them for sets of each size."""

    def __init__(self, size: int, num: int, den: int, exact: bool = False) -> None:
        self.size, self.num, self.den = size, num, den
        self.light: dict[int, list[int]] = {}
        n = 1
        while sum(comb(n, c) for c in self.overlaps(n)) <= self.heavy_cost(n):
            self.light[n] = self.overlaps(n)
            n += 1
        self.boundary = n - 1
        # one-bit minima of linked sets agree with probability (1 + J) / 2
        self.alike = least_agreement(BITS, (1 + num / den) / 2, LOSS)
        self.agree = 0 if exact else self.alike

    def overlap(self, n: int, m: int) -> int:
        return -(-self.num * (n + m) // (self.num + self.den))

    def overlaps(self, n: int) -> list[int]:
        """Overlaps that partners of a set of n may need."""
        return sorted({self.overlap(n, m) for m in range(-(-self.num * n // self.den), self.den * n // self.num + 1)})

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + 1

    def heavy_cost(self, n: int) -> int:
        """Index rows, twice as wide for their sketch, plus reading the set once more."""
        return 2 * self.prefix(n) + n

    def is_heavy(self, n: int) -> bool:
        return self.den * n // self.num > self.boundary


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document of a chunk."""
    data = TO_LOWER[data]
    start, end, before = words(data, at)
    h = span_hash(prefix_hash(data), start, end)
    rolled = shingle_hashes(h, size) if len(h) >= size else np.zeros(0, U64)
    out = []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        else:
            out.append(shingle_hashes(h[a:b], b - a) if b > a else np.zeros(0, U64))
    return out


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Four 64-bit words of sketch for each non-empty set."""
    out = np.zeros((len(sets), BITS // 64), U64)
    for k, s in enumerate(sets):
        low = np.full(BITS, 0xFFFFFFFF, np.uint32)
        short = (s >> U64(32)).astype(np.uint32)
        for a in range(0, len(short), 512):
            low = np.minimum(low, ((short[a : a + 512, None] ^ _SALTS) * _ROLLS).min(0))
        out[k] = np.packbits((low * np.uint32(0x9E3779B1) >> np.uint32(31)).astype(np.uint8)).view(U64)
    return out


def set_digest(s: np.ndarray) -> tuple[int, int]:
    n = U64(len(s))
    return tuple(int(mix(np.add.reduce(mix(s + salt), keepdims=True) + n).view(np.int64)[0]) for salt in (U64(11), U64(0x123456789)))


def subset_keys(s: np.ndarray, c: int) -> np.ndarray:
    """A key for each subset of c members: a sum of mixed hashes less those of the members left out."""
    m = mix(s ^ U64(0x5851F42D4C957F2D))
    total, out = np.add.reduce(m), len(s) - c
    if out == 0:
        sums = np.array([total], U64)
    elif out == 1:
        sums = total - m
    else:
        sums = np.array([total - np.add.reduce(m[list(x)]) for x in combinations(range(len(s)), out)], U64)
    return mix(sums + U64(c))


def frequent_shingles(docs: DataFrame, rule: Rule) -> np.ndarray:
    """Sorted hashes found in several texts of a small sample; at most ``MOST_FREQUENT`` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, data, at in chunks(batches, "text"):
            found = shingle_sets(data, at, rule.size)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64))], ["h"])

    sample = bounded_sample(docs, "doc_id", SAMPLE, "shingles").select(as_bytes("text").alias("text"))
    rows = sample.mapInArrow(run, "h long").groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") >= FREQUENT)
    return np.sort(rows.orderBy(F.desc("n"), "h").limit(MOST_FREQUENT).toPandas()["h"].to_numpy(np.int64).view(U64))


def keyed(docs: DataFrame) -> tuple[Column, bool]:
    """An expression that tells documents apart, and whether it is the id itself (null stays null)."""
    total, ids, null = docs.agg(F.count("*"), F.count_distinct("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    own = F.col("doc_id").cast("long")
    if total == ids + null:
        return own, True
    return F.when(own.isNotNull(), F.xxhash64(own, as_bytes("text"))), False


#: id: the document's key; local: the key of the first equal set in the task.
SETS = "doc_id long, id long, n long, h1 long, h2 long, s0 long, s1 long, s2 long, s3 long, local long, light array<long>, light_c array<int>, few array<long>, heavy array<long>"


def set_table(docs: DataFrame, key: Column, rule: Rule, frequent: np.ndarray) -> DataFrame:
    """A row for each document: size, digest, sketch, and (for the first of equal sets in a task) its index keys."""
    broadcast = docs.sparkSession.sparkContext.broadcast(frequent)

    def lists(parts: list[np.ndarray], kind) -> pa.ListArray:
        at = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, seen, none = broadcast.value, {}, np.zeros(0, np.int64)
        for part, data, at in chunks(batches, "text"):
            sets = shingle_sets(data, at, rule.size)
            digest = [set_digest(s) for s in sets]
            new, local = [], []
            for d, s, i in zip(digest, sets, part.column(1).to_pylist(), strict=True):
                new.append(bool(len(s)) and i is not None and d not in seen)
                local.append(seen.setdefault(d, i) if len(s) and i is not None else i)
            sketch = np.zeros((len(sets), BITS // 64), U64)
            sketch[np.array(new, bool)] = sketches([s for s, x in zip(sets, new, strict=True) if x])
            light, light_c, few, heavy = [], [], [], []
            for s, x in zip(sets, new, strict=True):
                n = len(s)
                keys = [subset_keys(s, c).view(np.int64) for c in rule.light.get(n, ())] if x else []
                light.append(np.concatenate(keys) if keys else none)
                light_c.append(np.repeat(rule.light[n], [len(k) for k in keys]) if keys else none)
                if x and rule.is_heavy(n):
                    order = mix(s + U64(77)) >> U64(1)
                    few.append((s[np.argpartition(order, FEW - 1)[:FEW]] if FEW < n else s).view(np.int64))
                    if len(frequent):
                        order |= (frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s).astype(U64) << U64(63)
                    p = rule.prefix(n)
                    heavy.append((s[np.argpartition(order, p - 1)[:p]] if p < n else s).view(np.int64))
                else:
                    few.append(none)
                    heavy.append(none)
            h = np.array(digest, np.int64).reshape(-1, 2)
            columns = [pa.array([len(s) for s in sets], pa.int64()), *(pa.array(x) for x in (h[:, 0], h[:, 1], *sketch.view(np.int64).T)), pa.array(local, pa.int64())]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns, lists(light, np.int64), lists(light_c, np.int32), lists(few, np.int64), lists(heavy, np.int64)], [f.split()[0] for f in SETS.split(", ")])

    return staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("id"), as_bytes("text").alias("text")).mapInArrow(run, SETS))


def light_links(sets: DataFrame, rule: Rule) -> DataFrame:
    """Links through a shared subset, from the smallest set under the key (a) to each member.

    Whoever shares a subset that two members need shares enough with the smallest of them, so no link is lost.
    """
    rows = sets.filter(F.size("light") > 0).select("id", "n", F.explode(F.arrays_zip("light", "light_c")).alias("k")).select("id", "n", F.col("k.light").alias("key"), F.col("k.light_c").alias("c"))
    hubs = rows.groupBy("key", "c").agg(F.min(F.struct("n", "id")).alias("hub"), F.count("*").alias("members")).filter("members > 1").drop("members")
    near = (F.col("hub.id") != F.col("id")) & ((rule.num + rule.den) * F.col("c") >= rule.num * (F.col("n") + F.col("hub.n")))
    return rows.join(hubs, ["key", "c"]).filter(near).select(F.col("hub.id").alias("a"), F.col("id").alias("b")).distinct()


def _similar(ids: np.ndarray, sketch: np.ndarray, agree: int) -> list[tuple[int, int]]:
    """Links that connect all members whose sketches agree in ``agree`` bits, directly or through others; equal ids are connected."""
    label, out = np.unique(ids, return_inverse=True)[1], []
    for p in range(len(sketch)):
        others = np.flatnonzero(label != label[p])
        if not len(others):
            break
        near = others[np.bitwise_count(sketch[others] ^ sketch[p]).sum(1) <= BITS - agree]
        if len(near):
            out += [(p, int(q)) for q in near]
            label[np.isin(label, label[near])] = label[p]
    return out


def scan_lists(rows: DataFrame, rule: Rule, parted: bool = False) -> DataFrame:
    """Candidate links (a, b) from index rows (key, id, s0, s1, s2, s3); rows of one id are connected already.

    With ``parted``, a list is scanned in parts of ``FEW_ROWS`` and by sketches always, which gives some of the candidates only.
    """
    agree = rule.alike if parted else rule.agree

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}  # what this task has linked so far: a link inside a component is not sent
        held: list[np.ndarray] = []
        hub: tuple[int, int] | None = None  # key and first id of a list too long to hold

        def root(i: int) -> int:
            while (up := parent.get(i, i)) != i:
                parent[i] = i = parent.get(up, up)
            return i

        def new_links(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
            if len(parent) > 1 << 20:
                parent.clear()
            out = []
            for a, b in found:
                x, y = root(a), root(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
                    out.append((a, b))
            return out

        def close(m: np.ndarray) -> list[tuple[int, int]]:
            """m: key, id and sketch of whole lists in order."""
            edge = np.flatnonzero(np.append(True, m[1:, 0] != m[:-1, 0]))
            size = np.diff(np.append(edge, len(m)))
            two = edge[size == 2]
            s = m[:, 2:].view(U64)
            found = []
            if len(two):
                near = two[np.bitwise_count(s[two] ^ s[two + 1]).sum(1) <= BITS - agree]
                found += zip(m[near, 1].tolist(), m[near + 1, 1].tolist(), strict=True)
            for e, k in zip(edge[size > 2].tolist(), size[size > 2].tolist(), strict=True):
                for f in range(e, e + k, FEW_ROWS if parted else k):
                    t = min(f + FEW_ROWS, e + k) if parted else e + k
                    ids = m[f:t, 1]
                    found += [(int(ids[p]), int(ids[q])) for p, q in _similar(ids, s[f:t], agree)]
            return found

        for batch in batches:
            m = np.stack([c.to_numpy() for c in batch.columns], 1)
            if not len(m):
                continue
            if held and held[0][0, 0] != m[0, 0]:
                found, held = close(np.concatenate(held)), []
            else:
                found = []
            last = int(np.searchsorted(m[:, 0], m[-1, 0]))
            if last:
                tail = int(np.searchsorted(m[:last, 0], hub[0], "right")) if hub and hub[0] == m[0, 0] else 0
                found += [(hub[1], int(i)) for i in m[:tail, 1]]  # the end of a list too long to hold
                if held or tail < last:
                    found += close(np.concatenate([*held, m[tail:last]]))
                held, hub = [], None
            rest = m[last:]
            if hub and hub[0] == rest[0, 0]:
                found += [(hub[1], int(i)) for i in rest[:, 1]]
            else:
                hub = None
                held.append(rest)
                if parted and sum(map(len, held)) > FEW_ROWS:
                    found, held = found + close(np.concatenate(held)), []
                elif sum(map(len, held)) > LIST_ROWS:  # every member becomes a candidate of the first one
                    ids = np.concatenate(held)[:, 1]
                    hub, held = (int(rest[0, 0]), int(ids[0])), []
                    found += [(hub[1], int(i)) for i in ids[1:]]
            if new := new_links(found):
                a, b = zip(*new, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
        if held and (found := new_links(close(np.concatenate(held)))):
            a, b = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "key").sortWithinPartitions("key").mapInArrow(run, "a long, b long").filter("a <> b").distinct()


def linked(sets: list[np.ndarray], rule: Rule) -> np.ndarray:
    """Component label of each set, by exact overlaps; a member is compared until all are in one component."""
    n = len(sets)
    size = np.array([len(s) for s in sets])
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    _, ids = np.unique(tokens, return_inverse=True)
    order = np.argsort(ids, kind="stable")
    posting = owner[order]
    start = np.concatenate([[0], np.cumsum(np.bincount(ids))])
    at = np.concatenate([[0], np.cumsum(size)])
    label = np.arange(n)
    for p in range(n):
        if (label == label[0]).all():
            break
        own = ids[at[p] : at[p + 1]]
        length = start[own + 1] - start[own]
        take = np.repeat(start[own] - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        overlap = np.bincount(posting[take], minlength=n)
        near = (rule.num + rule.den) * overlap >= rule.num * (size + size[p])
        label[np.isin(label, label[near])] = label[p]
    return label


def block_links(rows: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """Exact links that connect the members of each block as their links do; ``rows``: id, component, i, j (the block)."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.join(docs, "id").select("component", "i", "j", "id", "text").repartition(n, "component", "i", "j").sortWithinPartitions("component", "i", "j", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sets = None, [], []

        def close() -> pa.RecordBatch | None:
            if len(sets) > 1:
                label = linked(sets, rule)
                own = np.array(ids)
                least = np.full(len(own), np.iinfo(np.int64).max)
                np.minimum.at(least, label, own)
                far = own != least[label]
                return pa.RecordBatch.from_arrays([pa.array(own[far]), pa.array(least[label][far])], ["a", "b"])
            return None

        for part, data, at in chunks(batches, "text"):
            keys = list(zip(*(part.column(k).to_pylist() for k in range(3)), strict=True))
            for k, i, s in zip(keys, part.column(3).to_pylist(), shingle_sets(data, at, rule.size), strict=True):
                if k != key:
                    if (out := close()) is not None:
                        yield out
                    key, ids, sets = k, [], []
                if len(s) and (not ids or ids[-1] != i):
                    ids.append(i)
                    sets.append(s)
        if (out := close()) is not None:
            yield out

    return dealt.mapInArrow(run, "a long, b long")


def _blocks(k: str, total: str) -> Column:
    return F.greatest(F.ceil(F.col(k) / BLOCK_SETS), F.ceil(F.col(total) / BLOCK_SHINGLES), F.lit(1)).cast("long")


def verified(docs: DataFrame, members: DataFrame, rule: Rule) -> DataFrame:
    """Exact links (a, b) that connect candidate components as their links do; ``docs``: id, text; ``members``: id, component, n."""
    total = members.groupBy("component").agg(F.count("*").alias("k"), F.sum("n").alias("total"))
    members = staged(members.join(total.select("component", _blocks("k", "total").alias("blocks")), "component"))
    deal = lambda m: F.pmod(F.xxhash64("id"), m)
    up_to = lambda m: F.sequence(F.lit(0).cast("long"), m - 1)
    own = F.when(F.col("id") == F.col("component"), up_to(F.col("blocks"))).otherwise(F.array(deal(F.col("blocks"))))
    first = staged(block_links(members.select("id", "component", F.explode(own).alias("i"), F.lit(0).cast("long").alias("j")), docs, rule))
    large = members.filter("blocks > 1")
    if large.isEmpty():
        return first
    # pieces of large components: all pairs of pieces but none within the largest one
    pieces = connected_components(first).withColumnRenamed("component", "piece")
    large = large.join(pieces, "id", "left").withColumn("piece", F.coalesce("piece", "id"))
    sizes = large.groupBy("component", "piece").agg(F.count("*").alias("k"), F.sum("n").alias("total"))
    main = sizes.groupBy("component").agg(F.max_by("piece", F.struct("k", "piece")).alias("main"), F.max(F.struct("k", "piece", "total")).alias("m"), F.sum("k").alias("k"), F.sum("total").alias("total"), F.count("*").alias("pieces")).filter("pieces > 1")
    main = main.select("component", "main", F.col("m.k").alias("main_k"), F.col("m.total").alias("main_total"), (F.col("k") - F.col("m.k")).alias("k"), (F.col("total") - F.col("m.total")).alias("total"))
    main = main.select("component", "main", _blocks("main_k", "main_total").alias("main_blocks"), _blocks("k", "total").alias("blocks"))
    rows = large.select("id", "component", "piece").join(main, "component")
    b, m = deal(F.col("blocks")), deal(F.col("main_blocks"))
    of_main = F.transform(up_to(F.col("blocks")), lambda x: F.struct((-1 - m).alias("i"), x.alias("j")))
    with_main = F.transform(up_to(F.col("main_blocks")), lambda x: F.struct((-1 - x).alias("i"), b.alias("j")))
    among = F.transform(up_to(F.col("blocks")), lambda x: F.struct(F.least(x, b).alias("i"), F.greatest(x, b).alias("j")))
    rows = rows.select("id", "component", F.explode(F.when(F.col("piece") == F.col("main"), of_main).otherwise(F.concat(with_main, among))).alias("at")).select("id", "component", "at.i", "at.j")
    return first.unionByName(block_links(rows, docs, rule))


def labelled(docs: DataFrame, rule: Rule) -> tuple[DataFrame, Column, bool]:
    """(doc_id, id, n, component) of every row, component being the smallest key reachable; the key, and whether it is the id."""
    key, plain = keyed(docs)
    sets = set_table(docs, key, rule, frequent_shingles(docs, rule))
    some = sets.filter((F.col("n") > 0) & F.col("id").isNotNull())
    classes = some.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.min("local").alias("first"))
    leads = staged(some.filter("id = local").select("id", "n", "h1", "h2").distinct().join(classes, ["h1", "h2"]).select(F.col("id").alias("local"), "n", "rep", "first"))
    listed = some.filter(F.size("heavy") > 0).select(F.col("id").alias("local"), "s0", "s1", "s2", "s3", "few", "heavy")
    listed = listed.join(leads.filter("local = first").select("local", F.col("rep").alias("id")), "local").drop("local")
    keys = lambda rows, kind: rows.select(F.explode(kind).alias("key"), "id", "s0", "s1", "s2", "s3")

    def by_rep(links: DataFrame) -> DataFrame:
        """Links of classes.  Many links may share their first end, the hub of a list or subset, but few their second."""
        links = staged(links)
        named = lambda end: leads.select(F.col("local").alias(end), F.col("rep").alias(f"{end}_rep"))
        links = spread_join(links, named("a"), "a", limit(links.count(), links)).join(named("b"), "b")
        return links.filter("a_rep <> b_rep").select(F.col("a_rep").alias("a"), F.col("b_rep").alias("b")).distinct()

    near = staged(scan_lists(keys(listed, "few"), rule, parted=True))
    pieces = connected_components(near)
    pieced = listed.join(pieces, "id", "left").withColumn("id", F.coalesce("component", "id"))
    candidates = connected_components(near.unionByName(scan_lists(keys(pieced, "heavy"), rule)))
    sizes = leads.groupBy(F.col("rep").alias("id")).agg(F.max("n").alias("n"))
    texts = docs.select(key.alias("id"), as_bytes("text").alias("text"))
    exact = verified(texts if plain else texts.dropDuplicates(["id"]), candidates.join(sizes, "id"), rule)
    label = connected_components(by_rep(light_links(some, rule)).unionByName(exact.select("a", "b")))
    named = leads.join(label.withColumnRenamed("id", "rep"), "rep", "left").select("local", F.coalesce("component", "rep").alias("component"))
    named = some.select("doc_id", "id", "n", "local").join(named, "local").select("doc_id", "id", "n", "component")
    alone = sets.filter((F.col("n") == 0) | F.col("id").isNull()).select("doc_id", "id", "n", F.col("id").alias("component"))
    return named.unionByName(alone), key, plain


def components(docs: DataFrame, size: int, num: int, den: int, exact: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``."""
    rows, _, plain = labelled(docs, Rule(size, num, den, exact))
    if not plain:  # the smallest key isn't the smallest id
        rows = staged(rows)
        rows = rows.join(rows.groupBy("component").agg(F.min("doc_id").alias("least")), "component", "left").withColumn("component", F.col("least"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def first_of_components(docs: DataFrame, size: int = 5, num: int = 80, den: int = 100, exact: bool = False) -> DataFrame:
    """One document of each component, that of the smallest doc_id, with the columns of ``docs``; rows without an id all stay."""
    rows, key, plain = labelled(docs, Rule(size, num, den, exact))
    rows = rows.filter(F.col("id").isNotNull())
    first = rows.filter("id = component").select("id") if plain else rows.groupBy("component").agg(F.min(F.struct("doc_id", "id")).alias("f")).select("f.id")
    name = unused_name(docs, "key")
    own = docs.withColumn(name, key)
    one = own.join(first.select(F.col("id").alias(name)), name, "left_semi")
    return one.unionByName(own.filter(F.col(name).isNull())).select(*[F.col(f"`{c}`") for c in docs.columns])
