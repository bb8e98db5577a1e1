"""Exact top-k by integer inner product, block at a time.

Vectors are quantised to integers, put in an order in which vectors that point the same way stand together (by the places and
signs of their largest components, then by id), and packed, in ranges of that order, into blocks: a dense forward index (ids x
dimensions) with a summary, the largest and smallest value of every dimension.  A dimension acts as a term; the most it can add
to a query's score is the larger of weight x maximum and weight x minimum.  Summed over dimensions this bounds the score of every
vector in the block.

Queries go in sets that share the place of their largest component.  Bounds come from the summaries alone, a fraction of the
index; only blocks that a set needs are sent to it:

1. Each query takes the block of its highest bound and scores it through the forward index, which gives it a first k-th score.
2. Blocks whose bound reaches the k-th score of some query of a set follow; within a task each query takes them in order of
   falling bounds and scores them until the bound falls below its k-th score.

So the result is exact.  Ties go to the smaller id; a block whose bound equals the k-th score is still read.  How many blocks that
spares depends on the vectors (``visits`` tells): where they lie in clusters or have few large components, most; where they point
every way alike in tens of dimensions, none, as the maxima of any two vectors already bound too loosely.

Vectors that are null or hold a null or non-finite component take no part, neither as queries nor as candidates.  Shorter
vectors count as padded with zeros.  Rows that share an id are separate candidates and separate queries, told apart by
query_copy (0 for the first of an id in the order of its vectors), and answer each other.  An empty table gives no rows.  Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skiagram.llm.shared import staged

#: Vectors a block, blocks that one task scores for a set, summaries that one task bounds, and about how many queries a set has.
BLOCK, GROUP_BLOCKS, GROUP_SUMMARIES, SET_QUERIES = 128, 64, 4096, 4096
LEADING = 4
PACKED = "dims int, n int, ids binary, copies binary, vectors binary, top binary, bottom binary"
_ARROW = pa.schema([("dims", pa.int32()), ("n", pa.int32()), *((c, pa.binary()) for c in ("ids", "copies", "vectors", "top", "bottom"))])
FOUND = "query_id long, query_copy int, vec_id long, score long, made long, possible long"
NO_ID = np.iinfo(np.int64).max


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, copy, v array<long>) of the vectors that take part; copy numbers the rows of one id."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    bad = F.exists(F.col("_v"), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = (
        vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("_v"))
        .filter(F.col("_v").isNotNull() & F.col("id").isNotNull() & ~bad)
        .select("id", F.transform("_v", lambda x: F.floor(x * scale).cast("long")).alias("v"))
    )
    n, ids = rows.agg(F.count("*"), F.count_distinct("id")).first()
    copy = F.lit(0) if n == ids else F.row_number().over(Window.partitionBy("id").orderBy("v")) - 1
    return rows.select("id", copy.cast("int").alias("copy"), "v")


def direction(v: Column) -> Column:
    """Places and signs of the largest components, largest first: alike for vectors that point the same way."""
    largest = F.slice(F.array_sort(F.transform(v, lambda x, i: F.struct((-F.abs(x)).alias("a"), F.when(x < 0, -1 - i).otherwise(i).alias("i")))), 1, LEADING)
    return F.transform(largest, lambda x: x["i"])


def _matrix(lists: pa.Array) -> np.ndarray:
    """A row for each list, padded with zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    width = np.diff(at)
    out = np.zeros((len(width), int(width.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < width[:, None]] = values[at[0] : at[-1]]
    return out


def packed(rows: DataFrame) -> DataFrame:
    """Blocks of up to ``BLOCK`` vectors, ranges of the order by direction and id, numbered by ``b``; written."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            held = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            while held.num_rows >= BLOCK:
                yield block(held.slice(0, BLOCK))
                held = held.slice(BLOCK)
        if held is not None and held.num_rows:
            yield block(held)

    def block(t: pa.Table) -> pa.RecordBatch:
        m = _matrix(pa.concat_arrays([c for c in t.column(2).chunks]))
        ids, copies = (t.column(k).to_numpy() for k in (0, 1))
        raw = [ids.astype(np.int64), copies.astype(np.int32), m, m.max(0, initial=-(1 << 62)), m.min(0, initial=1 << 62)]
        return pa.RecordBatch.from_arrays([pa.array([m.shape[1]], pa.int32()), pa.array([len(ids)], pa.int32()), *(pa.array([x.tobytes()]) for x in raw)], schema=_ARROW)

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    way = rows.withColumn("way", direction(F.col("v")))
    ordered = way.repartitionByRange(n, "way", "id", "copy").sortWithinPartitions("way", "id", "copy").drop("way")
    return staged(ordered.mapInArrow(pack, PACKED).withColumn("b", F.monotonically_increasing_id()))


class Queries:
    """Queries of a set, with the k-th score they are sure of."""

    def __init__(self, t: pa.Table, dims: int) -> None:
        q = _matrix(t.column("v"))
        self.q = np.pad(q, ((0, 0), (0, max(dims - q.shape[1], 0))))
        self.ids, self.copies = t.column("id").to_numpy(), t.column("copy").to_numpy()
        self.floor = t.column("floor").to_numpy()


def _rows(t: pa.Table, column: str, dims: int) -> np.ndarray:
    out = np.zeros((t.num_rows, dims), np.int64)
    for k, (raw, n) in enumerate(zip(t.column(column).to_pylist(), t.column("dims").to_pylist(), strict=True)):
        out[k, :n] = np.frombuffer(raw, np.int64)
    return out


def _exact(q: np.ndarray, *others: np.ndarray) -> list[np.ndarray]:
    """The arrays as doubles, which go through BLAS, where all sums of products are exact in them; else as they are."""
    most = max((int(np.abs(x).max(initial=0)) for x in (q, *others)), default=0)
    return [x.astype(np.float64) if most**2 * max(q.shape[1], 1) < 1 << 52 else x for x in (q, *others)]


def bounds(queries: Queries, summaries: pa.Table) -> np.ndarray:
    """The most that any vector of each block can score, for each query."""
    dims = queries.q.shape[1]
    q, top, bottom = _exact(queries.q, _rows(summaries, "top", dims), _rows(summaries, "bottom", dims))
    return (np.where(q > 0, q, 0) @ top.T + np.where(q < 0, q, 0) @ bottom.T).astype(np.int64)


def search(queries: Queries, blocks: pa.Table, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Query numbers, candidate ids and scores of the k best of these blocks, as far as they reach the floors; and block visits."""
    bound = bounds(queries, blocks)
    dims = queries.q.shape[1]
    parts = []
    for r in blocks.to_pylist():
        m = np.zeros((r["n"], dims), np.int64)
        m[:, : r["dims"]] = np.frombuffer(r["vectors"], np.int64).reshape(r["n"], r["dims"])
        parts.append((np.frombuffer(r["ids"], np.int64), np.frombuffer(r["copies"], np.int32), m))
    q, *index = _exact(queries.q, *(m for _, _, m in parts))
    order = np.argsort(-bound, 1, kind="stable")
    least = -NO_ID  # the least number that may be negated
    best = np.full((len(q), k), least)
    who = np.full((len(q), k), NO_ID)
    going, visits = np.arange(len(q)), 0
    for step in range(len(parts)):
        at = order[going, step]
        on = bound[going, at] >= np.maximum(best[going, -1], queries.floor[going])
        going, at = going[on], at[on]
        if not len(going):
            break
        visits += len(going)
        for b in np.unique(at):
            rows = going[at == b]
            ids = np.broadcast_to(parts[b][0], (len(rows), len(parts[b][0])))
            score = (q[rows] @ index[b].T).astype(np.int64)
            own = (ids == queries.ids[rows, None]) & (parts[b][1] == queries.copies[rows, None])
            score = np.concatenate([best[rows], np.where(own, least, score)], 1)
            ids = np.concatenate([who[rows], np.where(own, NO_ID, ids)], 1)
            pick = np.lexsort((ids, -score), axis=1)[:, :k]
            best[rows], who[rows] = np.take_along_axis(score, pick, 1), np.take_along_axis(ids, pick, 1)
    keep = who != NO_ID
    return np.repeat(np.arange(len(q)), keep.sum(1)), who[keep], best[keep], visits


def _meet(queries: DataFrame, blocks: DataFrame, groups: int):
    """Queries (by s) and blocks (with s) that are grouped by set and one of a number of groups of blocks."""
    right = blocks.withColumn("g", F.pmod(F.xxhash64("b"), F.lit(groups)))
    left = queries.join(right.select("s", F.col("g").alias("h")).distinct(), "s").withColumnRenamed("s", "t")
    return left.groupBy("t", "h").cogroup(right.groupBy("s", "g"))


def found(vectors: DataFrame, id_col: str, vec_col: str, is_query, k: int, scale: int) -> DataFrame:
    """Candidates of each query, the k best among them, and block visits made and possible by task."""
    rows = quantised(vectors, id_col, vec_col, scale)
    n_queries = rows.filter(is_query).count()
    blocks = packed(rows)
    n_blocks = blocks.count()
    sets, groups, parts = max(1, -(-n_queries // SET_QUERIES)), max(1, -(-n_blocks // GROUP_BLOCKS)), max(1, -(-n_blocks // GROUP_SUMMARIES))
    s = F.pmod(F.xxhash64(F.get(direction(F.col("v")), F.lit(0))), F.lit(sets))
    queries = staged(rows.filter(is_query).withColumn("s", s).withColumn("floor", F.lit(np.iinfo(np.int64).min).cast("long")))
    every = F.explode(F.sequence(F.lit(0), F.lit(sets - 1)).cast("array<long>"))
    summaries = blocks.select("b", "dims", "top", "bottom", every.alias("s"))
    widest = lambda t: max(t.column("dims").to_pylist(), default=0)

    def highest(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return pa.table({"id": pa.array([], pa.int64()), "copy": pa.array([], pa.int32()), "b": pa.array([], pa.int64()), "bound": pa.array([], pa.int64())})
        own = Queries(left, widest(right))
        at = bounds(own, right)
        pick = at.argmax(1)
        return pa.table({"id": own.ids, "copy": own.copies, "b": right.column("b").to_numpy()[pick], "bound": at[np.arange(len(pick)), pick]})

    def needed(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return pa.table({"s": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        own = Queries(left, widest(right))
        some = (bounds(own, right) >= own.floor[:, None]).any(0)
        b = right.column("b").to_numpy()[some]
        return pa.table({"s": np.full(len(b), left.column("t")[0].as_py()), "b": b})

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        if not (left.num_rows and right.num_rows):
            return pa.table({f.split()[0]: pa.array([], pa.int32() if "copy" in f else pa.int64()) for f in FOUND.split(", ")})
        own = Queries(left, widest(right))
        q, v, score, made = search(own, right, k)
        count = np.zeros((2, len(q) + 1), np.int64)
        count[:, -1] = made, len(own.ids) * right.num_rows  # told once, in a row of its own without a candidate
        return pa.table({"query_id": np.append(own.ids[q], own.ids[0]), "query_copy": np.append(own.copies[q], own.copies[0]), "vec_id": pa.array(np.append(v, 0), mask=np.append(np.zeros(len(q), bool), True)), "score": np.append(score, 0), "made": count[0], "possible": count[1]})

    first = _meet(queries, summaries, parts).applyInArrow(highest, "id long, copy int, b long, bound long")
    first = first.groupBy("id", "copy").agg(F.max_by("b", F.struct("bound", "b")).alias("b"))
    pairs = staged(first.join(queries.select("id", "copy", "s"), ["id", "copy"]).select("s", "b").distinct())
    one = staged(_meet(queries, blocks.join(pairs, "b"), groups).applyInArrow(scored, FOUND))
    if n_blocks <= 1:
        return one
    ranked = one.filter("vec_id is not null").withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "query_copy").orderBy(F.desc("score"))))
    sure = ranked.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("query_copy").alias("copy"), F.col("score").alias("sure"))
    queries = staged(queries.join(sure, ["id", "copy"], "left").withColumn("floor", F.coalesce("sure", "floor")).drop("sure"))
    rest = _meet(queries, summaries, parts).applyInArrow(needed, "s long, b long").join(pairs, ["s", "b"], "left_anti")
    two = _meet(queries, blocks.join(rest, "b"), groups).applyInArrow(scored, FOUND)
    return one.unionByName(two)


def exact_top_k(vectors: DataFrame, id_col: str, vec_col: str, is_query, k: int = 10, scale: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score, query_copy; ``is_query`` is a condition on the column ``id``."""
    best = found(vectors, id_col, vec_col, is_query, k, scale).filter("vec_id is not null")
    w = Window.partitionBy("query_id", "query_copy").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "query_copy")


def visits(vectors: DataFrame, id_col: str, vec_col: str, is_query, k: int = 10, scale: int = 1024) -> DataFrame:
    """One row: block visits that the search makes, block visits possible among the blocks sent, and among all blocks."""
    rows = quantised(vectors, id_col, vec_col, scale)
    made = staged(found(vectors, id_col, vec_col, is_query, k, scale).agg(F.sum("made").alias("made"), F.sum("possible").alias("sent")))
    return made.crossJoin(rows.agg((F.count_if(is_query) * F.ceil(F.count("*") / F.lit(BLOCK))).alias("possible")))  # one row each
