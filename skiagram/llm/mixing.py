"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

A source is cut, in id order, into blocks of ``block`` documents; a block takes one slot.  A source of target weight w (the
weights sum to 1) may start its i-th block (from 1) from slot floor((i - 1) / w) on and must have it done by slot ceil(i / w).
Earliest-deadline-first over the released blocks meets every deadline on one machine of full utilisation, which keeps each
source within less than one block of weight x slots at every moment.

The schedule is made from the weights alone, as far as the last block of the table needs; it stops earlier and repeats after
``period`` slots if all weights are whole numbers of slots there, or after ``MOST_SLOTS``, where the rounding adds less than one
block to the deviation for each repetition.  So block j of a source of c blocks in L slots sits in slot (j div c) * L +
slot(source, j mod c).  A source that has run out leaves its slots empty; its documents are all placed by then and the others go
on in deadline order.  No row is dropped or repeated.  Weights that leave out a source of the table, weights under one slot in
``MOST_SLOTS`` and tables of more than ``MOST_SOURCES`` sources are errors, so what the driver makes and broadcasts is bounded.

Ranks within a source come from one range-partitioned sort by (source, id): a row's rank is its place in its partition plus the
source's rows in the partitions before, so a source that holds a third of all rows is numbered by many tasks, however its ids are
spread.  The sorted rows are written to the shared folder, so a lost executor can't change the order.  Null sources form a source
of their own, null ids come first, equal ids are ordered by the tie columns and then by a hash of the row (equal rows are
interchangeable).  Columns of the table that are named like those added keep their values; the added ones then get underscores.
An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from skiagram.llm.shared import staged, unused_name

#: Slots of a schedule and sources that the driver handles at most, and the fineness of the weights.
MOST_SLOTS, MOST_SOURCES, FINE = 1 << 20, 1 << 16, 1 << 60


def shares(weights: dict[str | None, float], period: int) -> dict[str | None, int]:
    """Whole shares of a period by largest remainder; ties go to the smaller name.  A weight too small for one is an error."""
    names = sorted((s for s, w in weights.items() if w > 0), key=lambda s: (s is not None, s or ""))
    total = sum(Fraction(weights[s]) for s in names)
    exact = {s: Fraction(weights[s]) / total * period for s in names}
    out = {s: int(exact[s]) for s in names}
    for s in sorted(names, key=lambda s: out[s] - exact[s])[: period - sum(out.values())]:
        out[s] += 1
    if not all(out.values()):
        raise ValueError("the period is too short for the smallest weight")
    return out


def schedule(share: dict[str | None, int], length: int) -> Iterator[tuple[str | None, int, int]]:
    """(source, turn, slot) of earliest-deadline-first over Pfair windows of the weights share / sum of shares."""
    period, names = sum(share.values()), list(share)
    waiting, ready = [(0, k, 0) for k in range(len(names))], []
    for slot in range(length):
        while waiting and waiting[0][0] <= slot:
            _, k, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * period // share[names[k]]), k, i))
        deadline, k, i = heapq.heappop(ready)
        if deadline <= slot:
            raise AssertionError("a deadline was missed")
        yield names[k], i, slot
        heapq.heappush(waiting, ((i + 1) * period // share[names[k]], k, i + 1))


def period_schedule(share: dict[str | None, int]) -> list[tuple[str | None, int, int, int]]:
    """(source, turn within the period, slot, share) of one period."""
    return [(s, i, slot, share[s]) for s, i, slot in schedule(share, sum(share.values()))]


def source_slots(weights: dict[str | None, float], blocks: dict[str | None, int], period: int) -> tuple[dict[str | None, list[int]], int]:
    """Slots of each source and the length after which they repeat, for so many blocks of each source."""
    if left_out := [s for s in blocks if not weights.get(s, 0) > 0]:
        raise ValueError(f"sources without a weight: {left_out[:10]}")
    fine = shares(weights, FINE)
    if all(abs(c * period - round(c * period / FINE) * FINE) * 10**9 < FINE and c * period >= FINE // 2 for c in fine.values()):
        fine, length = shares(weights, period), period
    else:
        if min(fine.values()) * MOST_SLOTS < FINE:
            raise ValueError(f"a weight is less than one slot in {MOST_SLOTS}")
        needed = max(-(-n * FINE // fine[s]) for s, n in blocks.items())
        length = min(max(needed, period, -(-FINE // min(fine.values()))), MOST_SLOTS)
    slots: dict[str | None, list[int]] = {s: [] for s in fine}
    for s, _, slot in schedule(fine, length):
        slots[s].append(slot)
    return slots, length


def source_ranks(rows: DataFrame, key: str, id_col: str, ties: list[str]) -> DataFrame:
    """Adds ``_rank``, from 0, by (id, ties) within each value of ``key``; sorted once, in ranges, and written."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = [F.col(f"`{f.name}`") for f in rows.schema.fields if not isinstance(f.dataType, MapType | VariantType)]
    order = [F.col(f"`{c}`") for c in (key, id_col, *ties)]
    at, part, rank = "_at", "_part", "_rank"
    dealt = rows.withColumn("_tie", F.xxhash64(*hashed)).repartitionByRange(n, *order, "_tie").sortWithinPartitions(*order, "_tie")
    placed = staged(dealt.drop("_tie").withColumn(at, F.monotonically_increasing_id()).withColumn(part, F.shiftright(at, 33)))
    # a row for each source of a partition; sorted, so no more rows than partitions and sources together
    runs = placed.groupBy(part, key).agg(F.min(at).alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(key).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(part, key, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    return placed.join(F.broadcast(runs), [part, key]).withColumn(rank, F.col(at) + F.col("_shift")).drop(at, part, "_shift")


def source_rows(docs: DataFrame, source: str) -> dict[str | None, int]:
    """Number of rows of each source; one row for each of at most MOST_SOURCES sources reaches the driver."""
    rows = docs.groupBy(source).agg(F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: group them first")
    return {r[0]: r[1] for r in rows}


def mixed(docs: DataFrame, weights: dict[str | None, float] | None = None, *, source: str = "source", id_col: str = "doc_id", ties: tuple[str, ...] = (), block: int = 16, period: int = 1000, power: float = 0.5) -> DataFrame:
    """``docs`` plus mix_block (of its source), mix_slot and mix_order (sort by it to read the mixture).

    ``weights`` maps every source to its target weight; without it the weights are proportional to a power of the number of
    rows, but at least two slots in ``MOST_SLOTS``.
    """
    names = {c: unused_name(docs, c) for c in ("mix_block", "mix_slot", "mix_order")}
    rows = source_rows(docs, source)
    if not rows:
        return docs.withColumns({n: F.lit(0).cast("long") for n in names.values()}).limit(0)
    if not weights:
        weights = {s: float(n) ** power for s, n in rows.items()}
        least = sum(weights.values()) * 4 / MOST_SLOTS
        weights = {s: max(w, least) for s, w in weights.items()}
    plan, length = source_slots(weights, {s: math.ceil(n / block) for s, n in rows.items()}, period)
    own = [f"c{k}" for k in range(len(docs.columns))]  # the user's columns, out of the way
    at = {c: n for c, n in zip(docs.columns, own, strict=True)}
    coded = docs.toDF(*own).withColumn("_key", F.coalesce(F.concat(F.lit("="), F.col(at[source]).cast("string")), F.lit("")))
    # one row for each source, MOST_SLOTS numbers at most in all
    slots = docs.sparkSession.createDataFrame([("" if s is None else f"={s}", len(x), x) for s, x in plan.items()], "_key string, _share long, _slots array<long>")
    ranked = source_ranks(coded, "_key", at[id_col], [at[t] for t in ties]).join(F.broadcast(slots), "_key")
    j = F.floor(F.col("_rank") / F.lit(block)).cast("long")
    slot = F.floor(F.col("_block") / F.col("_share")) * F.lit(length) + F.element_at("_slots", (F.pmod("_block", F.col("_share")) + 1).cast("int"))
    ranked = ranked.withColumn("_block", j).withColumn("_slot", slot).withColumn("_order", F.col("_slot") * F.lit(block) + F.pmod(F.col("_rank"), F.lit(block)))
    return ranked.select(*[F.col(o).alias(c) for c, o in at.items()], *[F.col(f"_{c[4:]}").alias(n) for c, n in names.items()])


def in_mix_order(docs: DataFrame, weights: dict[str | None, float] | None = None, **options) -> DataFrame:
    """The columns of ``docs`` only, dealt and sorted so that files read one after the other give the mixture."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = mixed(docs, weights, **options)
    order = unused_name(docs, "mix_order")
    return rows.repartitionByRange(n, order).sortWithinPartitions(order).select(*[F.col(f"`{c}`") for c in docs.columns])
