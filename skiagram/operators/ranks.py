"""Places of rows in an order, within groups that may be few and large.

A window puts each group into one task.  That is the cheaper way for a table whose estimated size is small, or whose groups are;
beyond, rows are sorted once by range partitions over (group, order) and written, and a row's place is its place in its partition plus
the rows of its group in the partitions before.  Both give the same places.  Percentiles of a large table need no places: they are selected
between brackets that sketches give.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skiagram.sources import tables

#: Estimated bytes up to which a table counts as small, and of a partition of one that isn't.  Catalyst estimates by bytes of files, which
#: are a tenth of the rows' or less once they are sorted.
SMALL, PART = 32 << 20, 8 << 20


def estimated(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(df: DataFrame) -> bool:
    """By Catalyst's estimate, which is the product of both sides' sizes for a join it knows nothing of, so it errs upwards."""
    return estimated(df) <= SMALL


def partitions(df: DataFrame, most: int = 20) -> int:
    """As many as shuffles have, or more for a large table; estimates err upwards, so no more than so many times that."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(n, min(most * n, -(-estimated(df) // PART)))


def placed(rows: DataFrame, by: list[str], order: list[str], name: str = "place", small: bool | None = None) -> DataFrame:
    """Adds the place, from 0, of each row in the order of columns that tell rows of a group apart."""
    if is_small(rows) if small is None else small:
        w = Window.partitionBy(*(by or [F.lit(0)])).orderBy(*order)
        return rows.withColumn(name, F.row_number().over(w).cast("long") - 1)
    spark = rows.sparkSession
    n = partitions(rows)
    at, part, shift = f"{name}_at", f"{name}_part", f"{name}_shift"
    dealt = rows.repartitionByRange(n, *by, *order).sortWithinPartitions(*by, *order).withColumn(at, F.monotonically_increasing_id())
    folder = tables.working_folder(spark)
    dealt.withColumn(part, F.shiftright(at, 33)).write.parquet(folder)
    kept = spark.read.schema(f"{dealt._jdf.schema().toDDL()}, {part} bigint").parquet(folder)
    # a row for each group of a partition: no more than partitions and groups together
    runs = kept.groupBy(part, *by).agg(F.min(at).alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(*(by or [F.lit(0)])).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn(shift, F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).drop("_first", "_n")
    if len(few := runs.limit(MOST_GROUPS + 1).collect()) <= MOST_GROUPS:  # the rows stay where they are
        runs = F.broadcast(spark.createDataFrame(few, runs.schema))
    joined = kept.alias("a").join(runs.alias("b"), matched("a", "b", [part, *by]))
    return joined.select(*[F.col(f"a.{c}") for c in rows.columns], (F.col(f"a.{at}") + F.col(f"b.{shift}")).alias(name))


#: Rank error of sketches, as one in so many rows; shares of a group that brackets may reach to either side, for large to small
#: groups; and the number of groups up to which they are broadcast.
ACCURACY, WIDTHS, MOST_GROUPS = 100_000, (1e-4, 1e-2, 1.0), 10_000


def matched(a: str, b: str, by: list[str]) -> Column:
    """Equality of keys, in which null is a value as any other."""
    same: Column = F.lit(True)
    for c in by:
        same = same & F.col(f"{a}.`{c}`").eqNullSafe(F.col(f"{b}.`{c}`"))
    return same


def bracketed(rows: DataFrame, by: list[str], x: str, shares: list[float]) -> DataFrame:
    """Rows with ``_low`` and ``_high``, values between which each percentile of their group lies, by sketches of a proven error."""
    spark, k = rows.sparkSession, len(shares)
    at = [min(max(q + d, 0.0), 1.0) for off in WIDTHS for d in (-off, off) for q in shares]
    groups = rows.groupBy(*by).agg(F.percentile_approx(x, F.array(*map(F.lit, at)), ACCURACY).alias("_edges"), F.count("*").alias("_n"))
    few = groups.limit(MOST_GROUPS + 1).collect()
    first = F.lit(2 * k * (len(WIDTHS) - 1) + 1)
    for level in range(len(WIDTHS) - 2, -1, -1):  # the narrowest that is two places and the sketch's error wide
        first = F.when(F.col("_n") * (WIDTHS[level] - 4 / ACCURACY) >= 2, 2 * k * level + 1).otherwise(first)
    split = [F.slice("_edges", first, k).alias("_low"), F.slice("_edges", first + k, k).alias("_high")]
    if len(few) <= MOST_GROUPS:  # a few numbers a group: broadcast, and the rows stay where they are
        edges = F.broadcast(spark.createDataFrame(few, groups.schema).select(*by, *split))
    else:  # many groups, none of which has much of the rows' keys: joined by key
        edges = groups.select(*by, *split)
    joined = rows.alias("r").join(edges.alias("e"), matched("r", "e", by))
    return joined.select(*[F.col(f"r.`{c}`") for c in rows.columns], "e._low", "e._high")


def selected(rows: DataFrame, by: list[str], x: str, shares: list[float]) -> DataFrame:
    """``percentiles`` by selection: no sort of the rows, nothing written, one shuffle of sketches and one of counts.

    A value inside a bracket is counted by itself, the others by the bracket that they lie behind, so a group's counts are as many as
    the distinct values in its brackets.  Those give the value at any place exactly.
    """
    inside = F.exists(F.arrays_zip("_low", "_high"), lambda b: (F.col(x) >= b["_low"]) & (F.col(x) <= b["_high"]))
    behind = F.array_max(F.filter("_high", lambda h: h < F.col(x)))
    keyed = bracketed(rows, by, x, shares).select(*by, inside.alias("_inside"), F.when(inside, F.col(x)).otherwise(behind).alias("_v"))
    counts = keyed.groupBy(*by, "_v", "_inside").agg(F.count("*").alias("_n"))
    # behind a value come first its own rows, then those outside of brackets
    up_to = Window.partitionBy(*(by or [F.lit(0)])).orderBy(F.col("_v").asc_nulls_first(), F.col("_inside").desc())
    runs = counts.withColumn("_end", F.sum("_n").over(up_to)).withColumn("_all", F.sum("_n").over(Window.partitionBy(*(by or [F.lit(0)]))))
    place = lambda q, f: f(F.lit(q) * (F.col("_all") - 1))
    here = lambda k: (F.col("_end") - F.col("_n") <= k) & (F.col("_end") > k)
    value = F.when(F.col("_inside"), F.col("_v")).otherwise(F.raise_error(F.lit("a percentile lies outside its bracket")).cast("double"))
    taken = []
    for k, q in enumerate(shares):
        for name, f in (("a", F.floor), ("b", F.ceil)):
            taken.append(F.max(F.when(here(place(q, f)), value)).alias(f"_{name}{k}"))
    got = runs.groupBy(*by).agg(F.max("_all").alias("_all"), *taken)
    mixed = []
    for k, q in enumerate(shares):
        share = F.lit(q) * (F.col("_all") - 1) - place(q, F.floor)
        mixed.append(F.when(share == 0, F.col(f"_a{k}")).otherwise((1 - share) * F.col(f"_a{k}") + share * F.col(f"_b{k}")))
    return got.select(*by, F.when(F.col("_all").isNotNull(), F.array(*mixed)).alias("p"))


def percentiles(rows: DataFrame, by: list[str], x: str, shares: list[float], small: bool | None = None) -> DataFrame:
    """One row a group that has a value, with an array of exact percentiles of x; nulls don't count, null keys are a group.

    A small table's values are counted in a map a group; a large one's are selected.  Both give the same rows; without groups and
    values, one of null."""
    some = rows.filter(F.col(x).isNotNull()).select(*by, F.col(x).cast("double").alias(x))
    if is_small(some) if small is None else small:
        return some.groupBy(*by).agg(F.percentile(x, F.array(*map(F.lit, shares))).alias("p"))
    return selected(some, by, x, shares)
