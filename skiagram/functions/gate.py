"""Quality flags and the acceptance gate as column expressions.

Comparisons with NaN or null are false: Spark orders NaN above every number, so each one is guarded.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skiagram.config import FLAGS, Qc

# Grain-size class edges in micrometres.
ECD_EDGES = (0.0, 62.5, 125.0, 250.0, 500.0, 1000.0, 2000.0, 4000.0, float("inf"))


def above(x: Column, limit: float) -> Column:
    return F.coalesce(~F.isnan(x) & (x > limit), F.lit(False))


def below(x: Column, limit: float) -> Column:
    return F.coalesce(~F.isnan(x) & (x < limit), F.lit(False))


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def finite(x: Column) -> Column:
    return F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))


def qc_flags(qc: Qc) -> dict[str, Column]:
    c = F.col
    return {
        "flag_defocus": above(c("edge_width_px"), qc.defocus_edge_width_px) | below(c("contrast"), qc.defocus_contrast_min),
        "flag_border": F.coalesce(c("touches_border"), F.lit(False)),
        "flag_too_small": below(c("ecd_px"), qc.min_ecd_px),
        "flag_sliver": above(c("qc_aspect_ratio"), qc.sliver_aspect_ratio) & F.coalesce(~F.isnan("ecd_px") & (c("ecd_px") <= qc.sliver_max_ecd_px), F.lit(False)),
        "flag_possible_agglomerate": below(c("qc_solidity"), qc.agglomerate_solidity_max),
        "flag_no_polygon": F.coalesce(~c("has_polygon"), F.lit(False)),
    }


def flag_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("flag_")]


def gate(df: DataFrame, disqualifying: list[str]) -> Column:
    """True where none of the disqualifying flags is set; no flags at all accept every row."""
    missing = [f for f in disqualifying if f not in df.columns]
    if missing:
        raise KeyError(f"no such flag columns: {missing}")
    flags = [F.coalesce(F.col(f), F.lit(False)) for f in disqualifying]
    return ~reduce(lambda a, b: a | b, flags) if flags else F.lit(True)


def flagged(df: DataFrame, qc: Qc) -> DataFrame:
    """All flags from the metrics, and qc_pass; re-flagging needs no image."""
    df = df.withColumns(qc_flags(qc))
    return df.withColumn("qc_pass", gate(df, qc.disqualifying_flags))


def regated(df: DataFrame, qc: Qc) -> DataFrame:
    """The stored qc_pass is never trusted: it is made anew from the flags."""
    return df.withColumn("qc_pass", gate(df, qc.disqualifying_flags))


def bin_labels(edges: tuple[float, ...] = ECD_EDGES) -> list[str]:
    return [f"{a:g}-{b:g}" if b != float("inf") else f"{a:g}+" for a, b in zip(edges, edges[1:], strict=False)]


def ecd_bin_index(x: Column, edges: tuple[float, ...] = ECD_EDGES) -> Column:
    """Index of the half-open class [low, high); null for negative, NaN, infinite: as many edges as x has reached, less one."""
    reached = reduce(lambda a, b: a + b, [(x >= e).cast("int") for e in edges[1:-1]], F.lit(0))
    return F.when(~F.isnan(x) & (x >= edges[0]) & (x < edges[-1]), reached)


def ecd_label(index: Column, edges: tuple[float, ...] = ECD_EDGES) -> Column:
    """The name of a class by its index; to be attached after an aggregation by the index."""
    return F.get(F.array(*map(F.lit, bin_labels(edges))), index)


def ecd_bin(x: Column, edges: tuple[float, ...] = ECD_EDGES) -> Column:
    return ecd_label(ecd_bin_index(x, edges), edges)


def active_flags(names: tuple[str, ...] = FLAGS) -> Column:
    return F.concat_ws(",", *[F.when(F.col(f), F.lit(f)) for f in names])


def predicted_status(disqualifying: list[str]) -> Column:
    return F.when(reduce(lambda a, b: a | b, [F.col(f) for f in disqualifying], F.lit(False)), "reject").otherwise("accept")
