"""Identity of a frame from its path: sample, run, camera, index, blank or data; column expressions only."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skiagram.config import Config


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def java_regex(pattern: str) -> tuple[str, dict[str, int]]:
    """The pattern anchored at the start, in Java's spelling, and the index of each named group."""
    return "^(?:" + pattern.replace("(?P<", "(?<") + ")", dict(re.compile(pattern).groupindex)


def parsed(frames: DataFrame, cfg: Config, *, sample_id: str | None = None, camera: str | None = None, path: str = "frame_path") -> DataFrame:
    """Adds stem, sample_id, run, camera, frame_index, is_blank; drops rows whose sample or camera can't be told.

    Overrides come first, the file name second.  An override camera that no code maps to is an error, as is a code without one.
    """
    if camera is not None and camera not in cfg.filename.camera_map.values():
        raise ValueError(f"unknown camera {camera!r}")
    pattern, groups = java_regex(cfg.filename.sample_regex)
    s = F.col("stem")
    matched = s.rlike(pattern)
    pick = lambda name: F.nullif(F.regexp_extract(s, pattern, groups[name]), F.lit("")) if name in groups else F.lit(None).cast("string")
    code = pick("cam")
    names = F.create_map(*[F.lit(x) for kv in cfg.filename.camera_map.items() for x in kv])
    digits = F.nullif(F.regexp_extract(s, r"(\d+)$", 1), F.lit(""))
    out = (
        frames.withColumn("stem", stem(F.col(path)))
        .withColumn("_matched", matched)
        .withColumn("_frame", pick("frame"))
        .withColumn("sample_id", F.lit(sample_id) if sample_id is not None else pick("sample"))
        .withColumn("run", pick("run"))
        .withColumn("_code", code)
        .withColumn("camera", F.lit(camera) if camera is not None else names[F.col("_code")])
        .withColumn("is_blank", F.when(F.col("_matched") & F.lit("frame" in groups), F.col("_frame").isNull()).otherwise(s.rlike(cfg.filename.blank_regex)))
        .withColumn("frame_index", F.when(~F.col("is_blank"), F.coalesce(F.col("_frame"), digits).try_cast("bigint")))
    )
    return out.filter(F.col("sample_id").isNotNull() & F.col("camera").isNotNull()).drop("_matched", "_frame", "_code")


def with_blanks(frames: DataFrame, path: str = "frame_path") -> DataFrame:
    """Data frames with the blank of their (sample, run, camera); the last path in component order wins, none gives null."""
    key = ["sample_id", "run", "camera"]
    blanks = frames.filter("is_blank").groupBy(*key).agg(F.max_by(path, F.split(path, "/")).alias("blank_path"))
    data = frames.filter("not is_blank").alias("d")
    b = blanks.alias("b")
    on = (F.col("d.sample_id") == F.col("b.sample_id")) & (F.col("d.camera") == F.col("b.camera")) & F.col("d.run").eqNullSafe(F.col("b.run"))
    return data.join(b, on, "left").select("d.*", "b.blank_path")


def frame_order() -> list[Column]:
    return [F.col("sample_id"), F.coalesce("run", F.lit("")), F.col("camera"), F.col("frame_index").asc_nulls_first(), F.col("stem")]


def fingerprint(size: Column, mtime: Column) -> Column:
    return F.concat_ws(":", size.cast("string"), F.floor(mtime).cast("long").cast("string"))


def grain_uid(frame_id: Column, label: Column) -> Column:
    return F.concat_ws(":", frame_id, label.cast("string"))


def uid_suffix(uid: Column) -> Column:
    return F.substring_index(uid, ":", -1)
