"""Runs over a folder: detect, aggregate, report data, overlays, labelling sample, smaller frames.

A detect run evaluates the frame kernel once, into a staged table in the output folder; grains, contours, manifest and errors
are derived from it.  Grains and contours lie in folders of (sample, camera); a run rewrites the folders that its frames touch,
leaving out the old rows of those frames, so repeated runs replace exactly their own rows and many small files never pile up.
"""

from __future__ import annotations

import json
import time

import yaml
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from skiagram.config import Config, config_hash
from skiagram.functions.gate import FLAGS, regated
from skiagram.operators import aggregate, detect, ranks, resume, review, sampling, schema
from skiagram.sources import colocated, tables
from skiagram.sources import frames as frame_source

KEYS = ["sample_id", "camera"]
STATES = ("ok", "empty", "error")
COLOCATED, LAYOUT = "colocated", "layout.json"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_grains(spark: SparkSession, out: str, cfg: Config) -> DataFrame | None:
    """The grain table, or none where no run has left one."""
    path = f"{out}/grains"
    return tables.read_table(spark, path, cfg.output.format, schema.grains(cfg.measure.efd_order)) if tables.exists(spark, path) else None


def grains_at(spark: SparkSession, path: str, cfg: Config) -> DataFrame | None:
    """The grain table of a run, or the one at the path itself, a folder or a file."""
    if tables.exists(spark, f"{path}/grains"):
        return read_grains(spark, path, cfg)
    return tables.read_table(spark, path, cfg.output.format, schema.grains(cfg.measure.efd_order)) if tables.exists(spark, path) else None


def read_contours(spark: SparkSession, out: str, cfg: Config, frame_ids: DataFrame | list[str] | None = None) -> DataFrame:
    """Outlines, of some frames if told; empty where there are none."""
    rows = tables.read_table(spark, f"{out}/contours", cfg.output.format, schema.KEYED_CONTOURS)
    if frame_ids is None:
        return rows
    return rows.filter(F.col("frame_id").isin(frame_ids)) if isinstance(frame_ids, list) else resume.of_frames(rows, frame_ids)


def run_colocate(spark: SparkSession, run: str, cfg: Config, buckets: int | None = None) -> int:
    """Copies grains and contours of a finished run into common buckets of the frame id, for joins without a shuffle; overlays and
    labelling samples read the copies until the run changes.  Returns the number of buckets: a file each, so some for every core."""
    grains = read_grains(spark, run, cfg)
    if grains is None:
        raise FileNotFoundError(f"no grains under {run}")
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place, staged = f"{run}/{COLOCATED}", f"{run}/_{COLOCATED}"
    tables.remove(spark, staged)
    colocated.write(grains, f"{staged}/grains", n)
    colocated.write(read_contours(spark, run, cfg), f"{staged}/contours", n)
    write_text(spark, f"{staged}/{LAYOUT}", json.dumps({"buckets": n}))
    tables.moved(spark, staged, place)
    return n


def read_joined(spark: SparkSession, run: str, cfg: Config) -> tuple[DataFrame, DataFrame] | None:
    """Grains and contours of a run to be joined by frame: co-located ones where they have been made, else as they are stored."""
    place, shape = f"{run}/{COLOCATED}", schema.grains(cfg.measure.efd_order)
    if tables.exists(spark, f"{place}/{LAYOUT}"):
        n = json.loads(spark.read.text(f"{place}/{LAYOUT}", wholetext=True).first()[0])["buckets"]
        return colocated.read(spark, f"{place}/grains", shape, n), colocated.read(spark, f"{place}/contours", schema.KEYED_CONTOURS, n)
    grains = read_grains(spark, run, cfg)
    return None if grains is None else (grains, read_contours(spark, run, cfg))


def replace_rows(spark: SparkSession, out: str, name: str, new: DataFrame, touched: DataFrame, cfg: Config, shape: StructType) -> None:
    """Puts the new rows of touched frames in place of their old ones.  The written whole is staged first, so a lost executor or
    driver never leaves a folder half read and half written."""
    path, staged, fmt = f"{out}/{name}", f"{out}/_staged/{name}", cfg.output.format
    old = tables.read_table(spark, path, fmt, shape)
    partitioned = fmt == "parquet" and cfg.output.partition
    if partitioned:
        old = old.join(F.broadcast(touched.select(*KEYS).distinct()), KEYS, "left_semi")  # one row a sample and camera
    whole = resume.upserted(old, new.select(*shape.names), touched).select(*shape.names)
    whole.write.mode("overwrite").parquet(staged)
    rows = spark.read.schema(shape).parquet(staged)
    if not partitioned:
        tables.write_table(rows.repartition("frame_id").sortWithinPartitions("grain_uid"), path, fmt)
        return
    by_frame = rows.repartitionByRange(*KEYS, "frame_id").sortWithinPartitions(*KEYS, "grain_uid")
    by_frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*KEYS).parquet(path)
    emptied = touched.select(*KEYS).distinct().join(rows.select(*KEYS).distinct(), KEYS, "left_anti")
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for r in emptied.collect():  # samples and cameras, never frames
        tables.remove(spark, f"{path}/sample_id={escape(r.sample_id)}/camera={escape(r.camera)}")


def swap(spark: SparkSession, df: DataFrame, out: str, name: str, cfg: Config) -> None:
    """Writes a table beside the one it is made from, then puts it in its place."""
    tables.write_table(df, f"{out}/_staged/{name}", cfg.output.format)
    tables.moved(spark, f"{out}/_staged/{name}", f"{out}/{name}")


def run_detect(spark: SparkSession, root: str, out: str, cfg: Config, *, force: bool = False, sample_id: str | None = None, camera: str | None = None, files: DataFrame | None = None, again: DataFrame | None = None) -> dict:
    """Detects what is new or changed under a root (or among given files) and returns the run's counts; files that ``again`` names by
    frame_path are done whatever the manifest says."""
    began = time.time()
    listed = frame_source.listing(spark, root) if files is None else files
    found = frame_source.discovered(listed, cfg, sample_id=sample_id, camera=camera)
    resume.check_frames(found, cfg)  # before anything is written
    if force:
        for name in ("grains", "contours", "manifest", "errors"):
            tables.remove(spark, f"{out}/{name}")
    before = tables.read_table(spark, f"{out}/manifest", cfg.output.format, schema.MANIFEST)
    done_before = before if again is None else before.join(again.select("frame_path"), "frame_path", "left_anti")
    todo = resume.todo(found, done_before).persist()  # small rows, counted before they are dealt out
    staged = f"{out}/_staged/results"
    measured, flagged, listed_now = (Observation(name) for name in ("frames", "grains", "manifest"))  # counted while they are written
    detect.results(todo, cfg).observe(measured, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(staged)
    todo.unpersist()
    done = spark.read.schema(schema.results(cfg.measure.efd_order)).parquet(staged)
    tables.remove(spark, f"{out}/{COLOCATED}")  # made from tables that change now

    replace_rows(spark, out, "grains", detect.grains(done, cfg).observe(flagged, *[F.count_if(f).alias(f) for f in FLAGS]), done, cfg, schema.grains(cfg.measure.efd_order))
    if cfg.output.save_contours:
        replace_rows(spark, out, "contours", detect.contours(done), done, cfg, schema.KEYED_CONTOURS)
    # given files are part of the root only: what they don't name stays
    kept = resume.carried(found, before, detect.manifest(done, cfg)) if files is None else resume.upserted(before, detect.manifest(done, cfg), done)
    failed_before = tables.read_table(spark, f"{out}/errors", cfg.output.format, schema.ERRORS)
    failed = resume.upserted(failed_before, detect.errors(done), done).join(kept.select("frame_id"), "frame_id", "left_semi")
    failed.write.mode("overwrite").parquet(f"{out}/_staged/failed")
    states = [F.count_if(F.col("status") == s).alias(s) for s in STATES]
    swap(spark, kept.observe(listed_now, *states, F.sum("n_objects").alias("n_objects")), out, "manifest", cfg)
    failed = spark.read.schema(schema.ERRORS).parquet(f"{out}/_staged/failed")
    if failed.isEmpty():
        tables.remove(spark, f"{out}/errors")
    else:
        swap(spark, failed, out, "errors", cfg)

    counts = listed_now.get
    summary = {
        "frames": {s: counts[s] for s in STATES if counts[s]},
        "n_objects": counts["n_objects"] or 0,
        "processed": measured.get["n"],
        "rejection_counts": flagged.get,
        "config_hash": config_hash(cfg),
        "wall_seconds": round(time.time() - began, 3),
    }
    write_text(spark, f"{out}/run_config.yaml", yaml.safe_dump(cfg.model_dump(mode="json"), sort_keys=True))
    write_text(spark, f"{out}/summary.json", json.dumps(summary, indent=2, sort_keys=True))
    tables.remove(spark, f"{out}/_staged")
    return summary


def run_aggregate(spark: SparkSession, run: str, out: str, cfg: Config) -> list[str]:
    """Writes summary, rejection_by_ecd, accepted and per_frame; nothing where the run has no grains."""
    grains = grains_at(spark, run, cfg)
    if grains is None:
        return []
    gated = regated(grains, cfg.qc)
    kept = gated.select([c for c in gated.columns if c in aggregate.READ or c == "qc_pass" or c.startswith("flag_")])
    small = ranks.is_small(kept)
    base = aggregate.levels(kept).persist() if small else kept.persist()  # read once, whichever it is
    try:
        made = (aggregate.of_levels(base) if small else aggregate.aggregated(base)) | {"accepted": aggregate.accepted(gated)}
        return [tables.write_table(aggregate.in_order(df) if name != "accepted" else df, f"{out}/{name}", cfg.output.format) for name, df in made.items()]
    finally:
        base.unpersist()


def run_report(spark: SparkSession, run: str, out: str, cfg: Config, root: str | None = None, cap: int = 96) -> list[str]:
    """Writes the tables behind the figures; with the frames' root also sheet tiles, the sheets drawn from them, and the illumination."""
    grains = grains_at(spark, run, cfg)
    if grains is None:
        return []
    made = {"focus_scatter": review.focus_scatter(grains), "rejection_by_ecd_global": aggregate.rejection_by_ecd_global(grains)}
    if root is not None:
        at = review.resolved_frames(grains.select("frame_path").distinct(), frame_source.listing(spark, root))
        some = sampling.stratified(grains.filter("qc_pass"), "ecd_um", cap, "grain_uid")
        made["accepted_sheet"] = review.tiles(sampling.paged(some, "grain_uid"), at)
        pages = sampling.rejected_pages(grains, list(FLAGS)).join(grains, "grain_uid")
        made["rejected_sheets"] = review.tiles(pages, at)
        made["illumination"] = review.illumination(at, cfg)
        both = made["accepted_sheet"].withColumn("flag", F.lit("accepted")).unionByName(made["rejected_sheets"])
        made["sheets"] = review.sheets(both, f"{out}/contact_sheets")
    return [tables.write_table(df, f"{out}/{name}", "parquet") for name, df in made.items()]


def run_overlay(spark: SparkSession, run: str, root: str, out: str, cfg: Config, frame_ids: list[str] | None = None, *, factor: int = 1, labels: bool | None = None) -> DataFrame:
    """Writes one PNG a frame with accepted outlines green and rejected ones red; returns a row a frame, its error if it has one."""
    both = read_joined(spark, run, cfg)
    if both is None:
        raise FileNotFoundError(f"no grains under {run}")
    grains, contours = both if frame_ids is None else (t.filter(F.col("frame_id").isin(frame_ids)) for t in both)
    drawn = review.outlined(grains, contours, frame_source.listing(spark, root), labels)
    review.overlays(drawn, out, factor).write.mode("overwrite").parquet(f"{out}/_overlays")
    return spark.read.parquet(f"{out}/_overlays")


def run_overviews(spark: SparkSession, run: str, root: str, cfg: Config, factor: int) -> DataFrame | None:
    """Overlays of every frame with a particle, in the run's folder; nothing where there are none."""
    if read_grains(spark, run, cfg) is None or read_grains(spark, run, cfg).isEmpty():
        return None
    return run_overlay(spark, run, root, f"{run}/overviews", cfg, factor=factor)


def run_groundtruth(spark: SparkSession, run: str, cfg: Config, n: int | None = None, seed: int = 0, *, frac: float | None = None, n_frames: int | None = None, frac_frames: float | None = None, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The sample to label, with predicted status and flags and where its frames lie (in a folder, if told, else as stored), and
    its outlines."""
    both = read_joined(spark, run, cfg)
    if both is None:
        raise FileNotFoundError(f"no grains under {run}")
    chosen = sampling.label_sample(both[0], cfg.groundtruth.lhs_axes, cfg.groundtruth.reserved, seed, n=n, frac=frac, n_frames=n_frames, frac_frames=frac_frames)
    at = chosen.select("frame_id", "frame_path").distinct()
    at = review.label_frames(at, frame_source.listing(spark, folder)) if folder else at.withColumnRenamed("frame_path", "path")
    ids = chosen.select("frame_id", "grain_uid")
    sample = review.with_predictions(chosen, cfg).join(at.select("frame_id", "path"), "frame_id")
    return sample, both[1].join(ids, ["frame_id", "grain_uid"], "left_semi")


def make_smaller(spark: SparkSession, root: str, out: str, factor: int) -> DataFrame:
    """Writes every frame as block means under its own name; a row a frame."""
    return review.shrunk_frames(frame_source.listing(spark, root), out, factor)


