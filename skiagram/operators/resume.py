"""Resuming a run: which frames are still to do, what is carried forward, and what a run counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skiagram.config import Config


def check_frames(frames: DataFrame, cfg: Config) -> None:
    """Raises before any output: frames that share an id, cameras without a calibration."""
    twice = frames.groupBy("frame_id").count().filter("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"frame ids that occur more than once: {[r.frame_id for r in twice]}")
    missing = [r.camera for r in uncalibrated(frames, cfg).collect()]  # one row for each camera
    if missing:
        raise KeyError(f"no calibration for {missing}")


def uncalibrated(frames: DataFrame, cfg: Config) -> DataFrame:
    known = list(cfg.calibration.known())
    cameras = frames.select("camera").distinct()
    return cameras.filter(~F.col("camera").isin(known)) if known else cameras


def todo(frames: DataFrame, manifest: DataFrame, *, reprocess_errors: bool = False) -> DataFrame:
    """Frames without a manifest row of the same id and fingerprint."""
    done = manifest.filter("status <> 'error'") if reprocess_errors else manifest
    return frames.join(done.select("frame_id", "fingerprint"), ["frame_id", "fingerprint"], "left_anti")


def carried(frames: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """Manifest after a run: new rows, and the old rows of present frames that were skipped."""
    skipped = old.join(frames.select("frame_id", "fingerprint"), ["frame_id", "fingerprint"], "left_semi").join(new.select("frame_id"), "frame_id", "left_anti")
    return new.unionByName(skipped.select(*new.columns))


def latest(records: DataFrame, key: str, order: str) -> DataFrame:
    """Last row of each key, whole."""
    last = records.groupBy(key).agg(F.max_by(F.struct(*records.columns), order).alias("r"))
    return last.select("r.*")


def of_frames(rows: DataFrame, frames: DataFrame) -> DataFrame:
    """Rows of the frames that are named."""
    return rows.join(frames.select("frame_id"), "frame_id", "left_semi")


def upserted(old: DataFrame, new: DataFrame, touched: DataFrame, key: str = "frame_id") -> DataFrame:
    """Rows of touched frames are replaced, or gone if the frame has none now."""
    return old.join(touched.select(key), key, "left_anti").select(*new.columns).unionByName(new)


def run_counters(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("status").agg(F.count("*").alias("n_frames"), F.sum("n_objects").cast("long").alias("n_objects"))
