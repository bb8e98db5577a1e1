"""Samples for hand labelling and contact sheets: quantile ranks, hypercube, strata, pages.

A sample is bounded, so its design is made on the driver, from a few rows for each of its points, whose ranks are counted; other ranks, strata and pages are places in an order (``ranks``), which no task
needs a whole group for once a table is large.  Random choices are orders of a hash of the id and the seed: repeatable, whatever
the partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skiagram.functions.gate import finite
from skiagram.operators import ranks

PAGE = 24


def hashed(key: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(key))


def quantile_ranked(rows: DataFrame, x: str, tie: str, *by: str, name: str = "rank", small: bool | None = None) -> DataFrame:
    """Adds (k + 0.5) / n of the row in the order of x, tie within each group; null keys are a group."""
    at = ranks.placed(rows, list(by), [x, tie], "_k", small)
    n = rows.groupBy(*by).agg(F.count("*").alias("_n"))
    at = at.alias("a").join(n.alias("b"), ranks.matched("a", "b", list(by))) if by else at.alias("a").crossJoin(F.broadcast(n).alias("b"))  # one row without groups
    return at.select(*[F.col(f"a.`{c}`") for c in rows.columns], ((F.col("a._k") + 0.5) / F.col("b._n")).alias(name))


def resolve_count(n: int | None, frac: float | None, total: int) -> int:
    wanted = n if n is not None else round(frac * total) if frac is not None else total
    return max(0, min(total, wanted))


def frame_pool(grains: DataFrame, k: int, seed: int) -> DataFrame:
    return grains.select("frame_id").distinct().orderBy(hashed("frame_id", seed), "frame_id").limit(k)


def reserved(grains: DataFrame, mask: Column, k: int, seed: int, taken: DataFrame | None = None) -> DataFrame:
    rows = grains.filter(mask)
    if taken is not None:
        rows = rows.join(taken.select("grain_uid"), "grain_uid", "left_anti")
    return rows.orderBy(hashed("grain_uid", seed), "grain_uid").limit(k)


def hypercube_points(k: int, dims: int, seed: int) -> np.ndarray:
    """k points, one in each of k slices of every axis."""
    rng = np.random.default_rng(seed)
    return (np.stack([rng.permutation(k) for _ in range(dims)], 1) + rng.random((k, dims))) / max(k, 1)


class Matching:
    """Points and rows, each point with its nearest row that no point before it has.

    A point asks its rows one after the other; a row that two ask for goes to the earlier point, and the other asks on.  In whatever
    order they ask, the end is that of the points choosing in turn, so rows need to be known only as far as they are asked for.
    """

    def __init__(self, k: int) -> None:
        self.near: list[list[str]] = [[] for _ in range(k)]
        self.asked = [0] * k
        self.holder: dict[str, int] = {}

    def ask(self, points: list[int]) -> list[int]:
        """Lets points ask; gives those that have asked all the rows they know."""
        waiting, stuck = list(points), []
        while waiting:
            i = waiting.pop()
            while self.asked[i] < len(self.near[i]):
                uid = self.near[i][self.asked[i]]
                self.asked[i] += 1
                other = self.holder.get(uid)
                if other is None or i < other:
                    self.holder[uid] = i
                    if other is not None:
                        waiting.append(other)
                    break
            else:
                stuck.append(i)
        return stuck


#: Rows whose places on every axis are counted first, as marks between which the others lie.
MARKS = 16_384


def passed(x: np.ndarray, uid: np.ndarray, mark_x: np.ndarray, mark_uid: np.ndarray) -> np.ndarray:
    """How many marks, in the order of (x, uid), are up to each row."""
    first, last = np.searchsorted(mark_x, x, "left"), np.searchsorted(mark_x, x, "right")
    out = first.copy()
    tied = np.flatnonzero(first < last)
    tied = tied[np.argsort(first[tied], kind="stable")]
    for rows in np.split(tied, np.flatnonzero(np.diff(first[tied])) + 1):
        if len(rows):
            a, b = first[rows[0]], last[rows[0]]
            out[rows] = a + np.searchsorted(mark_uid[a:b], uid[rows], "right")
    return out


def columns_of(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
    uid = np.empty(batch.num_rows, object)
    uid[:] = batch.column(0).to_pylist()
    return uid, [c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]


class Marks:
    """Some rows, and of each axis their values and ids in its order, with how many rows of the whole table are before each."""

    def __init__(self, rows: DataFrame, marked: list) -> None:
        spark, axes = rows.sparkSession, range(len(rows.columns) - 1)
        self.uid = np.empty(len(marked), object)
        self.uid[:] = [r[0] for r in marked]
        values = [np.array([r[1 + d] for r in marked], float) for d in axes]
        self.order = [np.lexsort((self.uid, x)) for x in values]
        self.at = [(x[o], self.uid[o]) for x, o in zip(values, self.order, strict=True)]
        at = spark.sparkContext.broadcast(self.at)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = np.zeros((len(axes), len(at.value[0][0]) + 1), np.int64)
            for b in batches:
                uid, xs = columns_of(b)
                for d, x in enumerate(xs):
                    n[d] += np.bincount(passed(x, uid, *at.value[d]), minlength=n.shape[1])
            d, p = np.nonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int32()), pa.array(p, pa.int32()), pa.array(n[d, p])], ["d", "p", "n"])

        n = np.zeros((len(axes), len(marked) + 1), np.int64)
        for r in rows.mapInArrow(count, "d int, p int, n long").groupBy("d", "p").agg(F.sum("n").alias("n")).collect():  # marks and axes
            n[r.d, r.p] = r.n
        self.total = int(n[0].sum())
        self.before = n.cumsum(axis=1)[:, :-1]

    def ranks(self) -> np.ndarray:
        """Of each marked row its rank on every axis."""
        out = np.zeros((len(self.uid), len(self.order)))
        for d, o in enumerate(self.order):
            out[o, d] = (self.before[d] + 0.5) / max(self.total, 1)
        return out


def nearest_rows(rows: DataFrame, marks: Marks, points: np.ndarray, wanted: list[int], m: int) -> dict[int, list[str]]:
    """Ids of the m nearest rows, or a few more, of each wanted point, nearest first; ``rows`` has grain_uid and then a column an axis.

    Marks bound a row's ranks, and so how far it is from a point.  A task keeps rows that may be among a point's m nearest ones of its
    own; those that still may be when tasks meet are few, and their ranks are counted exactly.
    """
    shared = rows.sparkSession.sparkContext.broadcast((marks.at, marks.before))
    total = marks.total

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, before = shared.value
        axes = range(len(at))
        least = [(np.append(0, n) + 0.5) / total for n in before]
        most = [(np.append(n, total) - 0.5) / total for n in before]
        kept = {i: (np.zeros(0), np.zeros(0), np.zeros(0, object), np.zeros((0, len(at)))) for i in wanted}
        for b in batches:
            uid, xs = columns_of(b)
            p = [passed(x, uid, *at[d]) for d, x in enumerate(xs)]
            low, high = [least[d][p[d]] for d in axes], [most[d][p[d]] for d in axes]
            values = np.stack(xs, 1).astype(float)
            for i in wanted:
                near = sum(np.maximum(np.maximum(low[d] - points[i, d], points[i, d] - high[d]), 0) ** 2 for d in axes)
                far = sum(np.maximum(np.abs(low[d] - points[i, d]), np.abs(high[d] - points[i, d])) ** 2 for d in axes)
                old = kept[i]
                some = near <= reach(old[1], m)
                new = [np.concatenate([a, c[some]]) for a, c in zip(old, (near, far, uid, values), strict=True)]
                some = new[0] <= reach(new[1], m)
                kept[i] = tuple(c[some] for c in new)
        for i, (near, far, uid, values) in kept.items():
            yield pa.RecordBatch.from_arrays([pa.array([i] * len(uid), pa.int32()), pa.array(near), pa.array(far), pa.array(uid.tolist(), pa.string()), pa.array(list(values), pa.list_(pa.float64()))], ["i", "near", "far", "uid", "x"])

    found = rows.mapInArrow(bounded, "i int, near double, far double, uid string, x array<double>")
    # tasks' own rows are few; of a point, those that no m others are surely nearer than
    w = Window.partitionBy("i").orderBy("far", "uid")
    kept = found.withColumn("_k", F.row_number().over(w)).withColumn("_m", F.max(F.when(F.col("_k") == m, F.col("far"))).over(Window.partitionBy("i")))
    kept = kept.filter(F.col("_m").isNull() | (F.col("near") <= F.col("_m") * (1 + SLACK) + SLACK)).collect()
    own = {r.uid: (r.uid, *r.x) for r in kept}
    exact = Marks(rows, list(own.values()))
    rank = dict(zip(exact.uid.tolist(), exact.ranks(), strict=True))
    out: dict[int, list[tuple[float, str]]] = {i: [] for i in wanted}
    surely = {r.i: r._m for r in kept}
    for r in kept:
        far = float(((rank[r.uid] - points[r.i]) ** 2).sum())
        if surely[r.i] is None or far <= surely[r.i]:  # rows as far as that are all here
            out[r.i].append((far, r.uid))
    return {i: [u for _, u in sorted(near)] for i, near in out.items()}


#: Share by which sums of squares may be off.
SLACK = 1e-12


def reach(far: np.ndarray, m: int) -> float:
    """How far a row may be to be among the m nearest of some."""
    return float("inf") if len(far) < m else float(np.partition(far, m - 1)[m - 1]) * (1 + SLACK) + SLACK


#: Rows of each point that are fetched at first; points that ask for more get twice as many each time.
FETCHED = 8


def hypercube_sample(grains: DataFrame, axes: list[str], k: int, seed: int) -> DataFrame:
    """k rows spread over the quantiles of the axes, chosen from all rows whose axes are finite: each point of the design takes, in
    turn, the nearest row that is left.

    Rows are never sorted: a few thousand marks, whose places are counted, bound all ranks, and exact ones are counted for rows near to a
    point.  Those reach the driver, which settles who takes which; points that all of theirs are taken from are looked for again, with more.
    """
    some = grains
    for x in axes:
        some = some.filter(finite(F.col(x)))
    some = some.select("grain_uid", *[F.col(x).cast("double").alias(f"_x{d}") for d, x in enumerate(axes)])
    points, match = hypercube_points(k, len(axes), seed), Matching(k)
    stuck, known = list(range(k)), dict.fromkeys(range(k), 0)
    marks = Marks(some, some.orderBy(hashed("grain_uid", seed), "grain_uid").limit(MARKS).collect()) if k else None
    while stuck and marks.total:
        m = max([2 * known[i] for i in stuck] + [FETCHED])
        for i, near in nearest_rows(some, marks, points, stuck, m).items():
            match.near[i] = near
        more = [i for i in stuck if len(match.near[i]) > known[i]]  # others have asked every row there is
        known.update((i, len(match.near[i])) for i in more)
        stuck = match.ask(more)
    chosen = grains.sparkSession.createDataFrame([(u,) for u in match.holder], "grain_uid string")
    return grains.join(F.broadcast(chosen), "grain_uid", "left_semi")  # k ids


def label_sample(grains: DataFrame, axes: list[str], reserve: dict[str, int], seed: int, *, n: int | None = None, frac: float | None = None, n_frames: int | None = None, frac_frames: float | None = None) -> DataFrame:
    """Rows of a pool of frames: some reserved for rare flags, the rest by hypercube.  Counts come before shares; neither means all."""
    if n_frames is not None or frac_frames is not None:
        total = grains.agg(F.count_distinct("frame_id")).first()[0]
        grains = grains.join(frame_pool(grains, resolve_count(n_frames, frac_frames, total), seed), "frame_id", "left_semi")
    size = grains.count()
    k = resolve_count(n, frac, size)
    if k >= size:
        return grains
    out = None
    for flag, n in reserve.items():
        got = reserved(grains, F.col(f"flag_{flag}"), min(n, k), seed, out)
        out = got if out is None else out.unionByName(got)
    taken = out.count() if out is not None else 0
    rest = grains if out is None else grains.join(out.select("grain_uid"), "grain_uid", "left_anti")
    spread = hypercube_sample(rest, axes, max(0, k - taken), seed)
    return spread if out is None else out.unionByName(spread)


def strata(rows: DataFrame, x: str, n: int = 5) -> DataFrame:
    """Adds stratum, 0 to n - 1, by quantile edges of x; equal edges fall together."""
    found = ranks.percentiles(rows, [], x, [k / n for k in range(1, n)]).first()
    edges = found.p if found and found.p else []
    stratum = sum(((F.col(x) > e).cast("int") for e in sorted(set(edges))), F.lit(0))
    return rows.withColumn("stratum", stratum)


def stratified(rows: DataFrame, x: str, cap: int, key: str, seed: int = 0, n: int = 5) -> DataFrame:
    """All rows if there are at most cap, else cap // strata of each stratum of x."""
    if rows.limit(cap + 1).count() <= cap:
        return rows
    cut = strata(rows, x, n)
    groups = cut.select("stratum").distinct().count()
    w = Window.partitionBy("stratum").orderBy(hashed(key, seed), key)  # a limit by group, which no task sees more of than it keeps
    return cut.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= cap // groups).drop("_k", "stratum")


def paged(rows: DataFrame, key: str, *by: str, size: int = PAGE, small: bool | None = None) -> DataFrame:
    """Adds position and page, from 1, in the order of key within each group; ``small`` where groups are, however large the table."""
    at = ranks.placed(rows, list(by), [key], "_k", small)
    return at.withColumn("position", (F.col("_k") + 1).cast("int")).withColumn("page", (F.floor(F.col("_k") / F.lit(size)) + 1).cast("int")).drop("_k")


def rejected_pages(grains: DataFrame, flags: list[str], size: int = PAGE) -> DataFrame:
    """Flagged and (by the stored gate) rejected rows, page by page for each flag."""
    stack = ", ".join(f"'{f}', {f}" for f in flags)
    long = grains.filter("not qc_pass").select("grain_uid", F.expr(f"stack({len(flags)}, {stack}) as (flag, is_set)")).filter("is_set")
    return paged(long.drop("is_set"), "grain_uid", "flag", size=size)
