"""Grain, frame, polygon and tile tables made from the benchmark's star schema, and the same in DuckDB's SQL."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skiagram.config import Config
from skiagram.functions.gate import flagged

GRAINS_SQL = """
base AS (SELECT 'P_' || l_returnflag AS sample_id, CASE l_linestatus WHEN 'O' THEN 'basic' ELSE 'zoom' END AS camera,
  'P_' || l_returnflag || '_' || CASE l_linestatus WHEN 'O' THEN 'b' ELSE 'z' END || '_' || lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS frame_id, * FROM lineitem),
metrics AS (SELECT sample_id, camera, frame_id, l_linenumber AS label,
  frame_id || ':' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS grain_uid,
  l_extendedprice / 20 AS ecd_um, (l_extendedprice / 20) * (0.5::DOUBLE + l_discount) AS feret_min_um, l_quantity AS ecd_px, 1 + l_tax * 100 AS edge_width_px,
  1 - 4 * l_discount AS contrast, 1 + l_linenumber / 2.0::DOUBLE AS qc_aspect_ratio, 1 - l_tax * 2.1::DOUBLE AS qc_solidity,
  l_orderkey % 20 = 0 AS touches_border, l_partkey % 50 <> 0 AS has_polygon, 1 - l_discount AS circularity, l_partkey, l_orderkey FROM base),
flags AS (SELECT *, edge_width_px > 5.25 OR contrast < 0.70 AS flag_defocus, touches_border AS flag_border, ecd_px < 10 AS flag_too_small,
  qc_aspect_ratio > 3.0 AND ecd_px <= 40 AS flag_sliver, qc_solidity < 0.90 AS flag_possible_agglomerate, NOT has_polygon AS flag_no_polygon,
  qc_solidity AS solidity, qc_aspect_ratio AS aspect_ratio FROM metrics),
grains AS (SELECT *, NOT (flag_defocus OR flag_border OR flag_too_small OR flag_sliver OR flag_no_polygon) AS qc_pass FROM flags)"""

FRAMES_SQL = """
frames AS (SELECT DISTINCT 'data/' || frame_id || '.bmp' AS frame_path, frame_id, sample_id, camera, length(frame_id) * 1000 + CAST(right(frame_id, 4) AS BIGINT) AS size,
  1700000000 + CAST(right(frame_id, 4) AS BIGINT) AS mtime FROM grains)"""

RINGS_SQL = """
points AS (SELECT vec_id, k, (50 + 10 * CAST(embedding[k + 1] AS DOUBLE)) * cos(2 * pi() * k / 64.0::DOUBLE) + 64 AS x,
  (50 + 10 * CAST(embedding[k + 1] AS DOUBLE)) * sin(2 * pi() * k / 64.0::DOUBLE) + 64 AS y FROM embeddings, range(64) t(k)),
edges AS (SELECT vec_id, k, x, y, coalesce(lead(x) OVER w, first_value(x) OVER w) AS nx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS ny
  FROM points WINDOW w AS (PARTITION BY vec_id ORDER BY k))"""

TILES_SQL = """
pixels AS (SELECT vec_id, k, CAST(embedding[k + 1] AS DOUBLE) + 1 AS v FROM embeddings, range(64) t(k)),
tiles AS (SELECT vec_id, k, v / median(v) OVER (PARTITION BY vec_id) AS p FROM pixels)"""


def grains(spark: SparkSession, sf_dir: str, cfg: Config | None = None) -> DataFrame:
    return grains_of(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), cfg or Config())


def grains_of(lines: DataFrame, cfg: Config) -> DataFrame:
    """Flagged and gated grains from rows of lineitem, of a table or a batch of a stream."""
    c = F.col
    code = F.when(c("l_linestatus") == "O", "b").otherwise("z")
    rows = lines.select(
        F.concat(F.lit("P_"), "l_returnflag").alias("sample_id"),
        F.when(c("l_linestatus") == "O", "basic").otherwise("zoom").alias("camera"),
        F.concat(F.lit("P_"), c("l_returnflag"), F.lit("_"), code, F.lit("_"), F.lpad(c("l_suppkey").cast("string"), 7, "0")).alias("frame_id"),
        c("l_linenumber").alias("label"),
        F.concat_ws("-", c("l_orderkey").cast("string"), c("l_linenumber").cast("string"), c("l_partkey").cast("string")).alias("_key"),
        (c("l_extendedprice") / 20).alias("ecd_um"),
        ((c("l_extendedprice") / 20) * (0.5 + c("l_discount"))).alias("feret_min_um"),
        c("l_quantity").cast("double").alias("ecd_px"),
        (1 + c("l_tax") * 100).alias("edge_width_px"),
        (1 - 4 * c("l_discount")).alias("contrast"),
        (1 + c("l_linenumber") / F.lit(2.0)).alias("qc_aspect_ratio"),
        (1 - c("l_tax") * 2.1).alias("qc_solidity"),
        (c("l_orderkey") % 20 == 0).alias("touches_border"),
        (c("l_partkey") % 50 != 0).alias("has_polygon"),
        (1 - c("l_discount")).alias("circularity"),
        c("l_partkey"),
        c("l_orderkey"),
    )
    rows = rows.withColumn("grain_uid", F.concat_ws(":", "frame_id", "_key")).drop("_key")
    rows = flagged(rows, cfg.qc)
    return rows.withColumns({"solidity": c("qc_solidity"), "aspect_ratio": c("qc_aspect_ratio")})


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = grains(spark, sf_dir).select("frame_id", "sample_id", "camera").distinct()
    tail = F.expr("cast(right(frame_id, 4) as bigint)")
    return rows.select(F.concat(F.lit("data/"), "frame_id", F.lit(".bmp")).alias("frame_path"), "frame_id", "sample_id", "camera", (F.length("frame_id") * 1000 + tail).alias("size"), (F.lit(1700000000) + tail).alias("mtime"))


def rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, xs, ys: 64 vertices around (64, 64)."""
    turn = 2 * math.pi
    e = F.transform("embedding", lambda v: v.cast("double"))
    at = lambda f: F.transform(F.col("_e"), lambda v, k: (50 + 10 * v) * f(turn * k / F.lit(64.0)) + 64)
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", e.alias("_e")).select("vec_id", at(F.cos).alias("xs"), at(F.sin).alias("ys"))


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, pixels: 8 x 8 values in row order."""
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", F.transform("embedding", lambda v: v.cast("double") + 1).alias("pixels"))
