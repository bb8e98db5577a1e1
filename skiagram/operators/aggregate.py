"""Summaries of gated grains: by sample and camera, by frame, by size class, and the accepted rows.

Every aggregate is partial before its one shuffle.  Exact percentiles keep a map of a group's values in small tables; beyond, those by
sample, whose groups are few and grow with the corpus, come from ranks (``ranks``), and those by frame from two sizes a row that are
brought together by frame as they are, as maps made before the shuffle would hold every value and more.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skiagram.functions.gate import ecd_bin_index, ecd_label, flag_columns, nan_to_null
from skiagram.operators import ranks

SHAPE = ("aspect_ratio", "solidity", "convexity", "circularity", "extent", "eccentricity", "wadell_roundness", "wadell_sphericity", "curvature_entropy")

#: Columns that summaries read, besides flags.
READ = ("sample_id", "camera", "frame_id", "ecd_um", "feret_min_um", *SHAPE)


def percentiles(x: str, accepted: Column) -> list[Column]:
    """D10, D50, D90 of accepted rows; any NaN among them makes all three NaN, no rows make null."""
    value = F.when(accepted, F.col(x))
    bad = F.coalesce(F.max(F.isnan(value)), F.lit(False))
    p = F.percentile(value, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    return [F.when(bad, float("nan")).otherwise(F.get(p, k)).alias(f"{x}_d{d}") for k, d in enumerate((10, 50, 90))]


PERCENT, SHARES = ("ecd_um", "feret_min_um"), [0.1, 0.5, 0.9]


def summary_columns(grains: DataFrame, ok: Column, by_rank: bool = False) -> list[Column]:
    """Aggregates of a group; with ``by_rank``, whether a size is NaN in place of its percentiles."""
    out = [F.count("*").alias("n_total"), F.count_if(ok).alias("n_accepted"), F.count_if(~ok).alias("n_rejected")]
    out += [F.count_if(F.col(f)).alias(f"n_{f}") for f in flag_columns(grains)]
    for x in PERCENT:
        if x in grains.columns:
            out += percentiles(x, ok) if not by_rank else [F.coalesce(F.max(F.when(ok, F.isnan(x))), F.lit(False)).alias(f"_{x}_nan")]
    for x in SHAPE:
        if x in grains.columns:
            value = F.when(ok, nan_to_null(F.col(x)))
            out += [F.avg(value).alias(f"{x}_mean"), F.stddev_samp(value).alias(f"{x}_sd")]
    return out


def frame_percentiles(rows: DataFrame, keys: list[str], measured: list[str]) -> DataFrame:
    """Exact percentiles of many groups, none of which has much of the rows; a column _x of each size."""
    values = rows.select(*keys, *[F.col(x).cast("double").alias(x) for x in measured]).repartition(ranks.partitions(rows), *keys)
    return values.groupBy(*keys).agg(*[F.percentile(x, F.array(*map(F.lit, SHARES))).alias(f"_{x}") for x in measured])


def with_percentiles(made: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Columns of percentiles where summary_columns left whether a size is NaN; keys match null by null."""
    columns = []
    for c in made.columns:
        x = c[1:-4]
        if c.endswith("_nan"):
            columns += [F.when(F.col(f"m.{c}"), float("nan")).otherwise(F.get(F.col(f"p._{x}"), F.lit(k))).alias(f"{x}_d{d}") for k, d in enumerate((10, 50, 90))]
        else:
            columns.append(F.col(f"m.{c}"))
    return made.alias("m").join(found.alias("p"), ranks.matched("m", "p", keys), "left").select(*columns)


def rank_percentiles(rows: DataFrame, keys: list[str], measured: list[str]) -> DataFrame:
    """Exact percentiles of few and large groups; a column _x of each size."""
    found = rows.select(*keys).distinct()
    for x in measured:
        p = ranks.percentiles(rows, keys, x, SHARES, small=False).withColumnRenamed("p", f"_{x}")
        found = found.alias("a").join(p.alias("b"), ranks.matched("a", "b", keys), "left").select("a.*", f"b._{x}")
    return found


def summarised(grains: DataFrame, keys: list[str], found: Callable | None = None) -> DataFrame:
    """One row for each observed key; rows with a null key are left out.  ``found`` gives the percentiles of a large table."""
    ok = F.coalesce(F.col("qc_pass"), F.lit(False))
    measured = [x for x in PERCENT if x in grains.columns]
    rows = grains.dropna(subset=keys)
    made = rows.groupBy(*keys).agg(*summary_columns(grains, ok, found is not None))
    return with_percentiles(made, found(rows.filter(ok), keys, measured), keys) if found and measured else made


def summary(grains: DataFrame, small: bool | None = None) -> DataFrame:
    """Groups are few and grow with the corpus: percentiles of a large table come from ranks."""
    small = ranks.is_small(grains) if small is None else small
    return summarised(grains, ["sample_id", "camera"], None if small else rank_percentiles)


def per_frame(grains: DataFrame, small: bool | None = None) -> DataFrame:
    small = ranks.is_small(grains) if small is None else small
    return summarised(grains, ["sample_id", "camera", "frame_id"], None if small else frame_percentiles)


def by_class(grains: DataFrame) -> DataFrame:
    """Rows with the index of their size class; those without one are left out."""
    return grains.withColumn("bin_index", ecd_bin_index(F.col("ecd_um"))).filter("bin_index is not null")


def rejection_by_ecd(grains: DataFrame) -> DataFrame:
    out = by_class(grains).dropna(subset=["sample_id", "camera"]).groupBy("sample_id", "camera", "bin_index").agg(F.count("*").alias("n_total"), F.count_if(~F.col("qc_pass")).alias("n_rejected"))
    return out.select("sample_id", "camera", ecd_label(F.col("bin_index")).alias("ecd_bin"), "bin_index", "n_total", "n_rejected", (F.col("n_rejected") / F.col("n_total")).alias("rejection_rate"))


def rejection_by_ecd_global(grains: DataFrame) -> DataFrame:
    """By the stored qc_pass, over all samples."""
    out = by_class(grains).groupBy("bin_index").agg(F.count("*").alias("n_total"), F.avg((~F.col("qc_pass")).cast("int")).alias("rejection_rate"))
    return out.select(ecd_label(F.col("bin_index")).alias("ecd_bin"), "bin_index", "n_total", "rejection_rate")


#: Levels of ``levels`` by their grouping id: bits of the keys that are summed over, of (sample_id, camera, frame_id, bin_index).
PER_FRAME, PER_CLASS, PER_SAMPLE = 0b0001, 0b0010, 0b0011


def levels(grains: DataFrame, small: bool = True) -> DataFrame:
    """Summaries by sample and camera, by frame and by size class in one scan and one shuffle; ``level`` tells them apart.

    That counts each row once for each level before the shuffle, with maps of a group's values.  Of a table that isn't small only counts
    and moments are made so; percentiles are found level by level."""
    ok = F.coalesce(F.col("qc_pass"), F.lit(False))
    rows = grains.withColumn("bin_index", ecd_bin_index(F.col("ecd_um"))).dropna(subset=["sample_id", "camera"])
    out = summary_columns(grains, ok, not small)
    names = ["sample_id", "camera", "frame_id", "bin_index"]
    keys = [F.col(k) for k in names]
    sets = [keys[:2], keys[:3], [*keys[:2], keys[3]]]
    made = rows.groupingSets(sets, *keys).agg(F.grouping_id().alias("level"), *out)
    named = ((F.col("level") != PER_FRAME) | F.col("frame_id").isNotNull()) & ((F.col("level") != PER_CLASS) | F.col("bin_index").isNotNull())
    made = made.filter(named)
    measured = [x for x in PERCENT if x in grains.columns]
    if small or not measured:
        return made
    some = rows.filter(ok)
    parts = [(PER_SAMPLE, rank_percentiles(some, names[:2], measured)), (PER_FRAME, frame_percentiles(some, names[:3], measured)), (PER_CLASS, rank_percentiles(some, [*names[:2], "bin_index"], measured))]
    found = None
    for level, part in parts:
        of_level = [F.col(c) if c in part.columns else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in names]
        part = part.select(*of_level, F.lit(level).cast("long").alias("level"), *[f"_{x}" for x in measured])
        found = part if found is None else found.unionByName(part)
    return with_percentiles(made, found, [*names, "level"])


def of_levels(made: DataFrame) -> dict[str, DataFrame]:
    """The tables that ``summary``, ``per_frame`` and ``rejection_by_ecd`` give, from ``levels``."""
    at = lambda level, *drop: made.filter(F.col("level") == level).drop("level", *drop)
    rejected = made.filter(F.col("level") == PER_CLASS)
    rate = (F.col("n_rejected") / F.col("n_total")).alias("rejection_rate")
    return {
        "summary": at(PER_SAMPLE, "frame_id", "bin_index"),
        "per_frame": at(PER_FRAME, "bin_index"),
        "rejection_by_ecd": rejected.select("sample_id", "camera", ecd_label(F.col("bin_index")).alias("ecd_bin"), "bin_index", "n_total", "n_rejected", rate),
    }


def frame_hint(grains: DataFrame, n: int = 5) -> DataFrame:
    """The first few frame ids, for a message."""
    return grains.select("frame_id").distinct().orderBy("frame_id").limit(n)


def in_order(table: DataFrame) -> DataFrame:
    """A finished summary in the order of its groups, size classes by their edges."""
    by = [c for c in ("sample_id", "camera", "frame_id", "bin_index") if c in table.columns]
    return table.orderBy(*by) if by else table


def accepted(grains: DataFrame) -> DataFrame:
    return grains.filter("qc_pass")


def flag_counts(grains: DataFrame) -> DataFrame:
    flags = flag_columns(grains)
    stack = ", ".join(f"'{f}', {f}" for f in flags)
    return grains.select("sample_id", "camera", F.expr(f"stack({len(flags)}, {stack}) as (flag, is_set)")).groupBy("sample_id", "camera", "flag").agg(F.count_if("is_set").alias("n_set"))


def aggregated(gated: DataFrame) -> dict[str, DataFrame]:
    """The three tables of a gated table that is too large for maps of values; persist it, as each reads it."""
    return {"summary": summary(gated, False), "rejection_by_ecd": rejection_by_ecd(gated), "per_frame": per_frame(gated, False)}
