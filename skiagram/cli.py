"""Command line: detect, aggregate, report, overlay, groundtruth, colocate, make-fixtures."""

from __future__ import annotations

import argparse
import sys

from skiagram.config import load_config
from skiagram.operators import aggregate, labelling
from skiagram.plans import jobs
from skiagram.session import session

PLACES = {"detect": ("frames", "out"), "aggregate": ("grains", "out"), "report": ("grains", "frames", "out"), "overlay": ("run", "frames", "out"), "groundtruth": ("run",), "colocate": ("run",), "make-fixtures": ("frames", "out")}
NOTHING = "no grains found at {}: the run detected nothing"


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="skiagram", description=__doc__)
    p.add_argument("--master", help="Spark master; by default local, with as many cores as --jobs tells")
    sub = p.add_subparsers(dest="command", required=True)
    made = {}
    for name, places in PLACES.items():
        made[name] = c = sub.add_parser(name)
        for place in places:
            c.add_argument(place)
        if name != "make-fixtures":
            c.add_argument("--config", help="YAML over the defaults")
    yes_no = argparse.BooleanOptionalAction
    c = made["detect"]
    c.add_argument("--jobs", type=int, help="cores to use, -1 for all, instead of runtime.n_jobs")
    c.add_argument("--force", action="store_true", help="clear the run and process every frame")
    c.add_argument("--overview", action=yes_no, default=False, help="draw overlays of all frames with particles into OUT/overviews")
    c.add_argument("--overview-factor", type=int, default=4)
    c.add_argument("--sample-id", help="sample of all frames, whatever their names")
    c.add_argument("--camera", help="camera of all frames, whatever their names")
    c = made["overlay"]
    c.add_argument("--frames", dest="frame_ids", help="required: frame ids, separated by commas")
    c.add_argument("--factor", type=int, default=4)
    c.add_argument("--labels", action=yes_no, help="draw labels, or not; by default where a frame has few particles")
    c = made["groundtruth"]
    for kind in ("frames", "grains"):
        c.add_argument(f"--n-{kind}", type=int)
        c.add_argument(f"--frac-{kind}", type=float)
    c.add_argument("--seed", type=int, default=0)
    c.add_argument("--out", help="label file; by default RUN/groundtruth.csv")
    c.add_argument("--frames-dir", help="where the frames lie now")
    c.add_argument("--keys", help="keys to press, separated by spaces, instead of reading them")
    made["colocate"].add_argument("--buckets", type=int, help="files of each table; by default the session's shuffle partitions")
    made["make-fixtures"].add_argument("--factor", type=int, default=4)
    return p


def label(a: argparse.Namespace, spark, cfg) -> None:
    """Labels a sample key by key: a line of status, then a key, until q or the end."""
    folder = (a.out or f"{a.run}/groundtruth.csv").removesuffix(".csv")
    sample, outlines = jobs.run_groundtruth(spark, a.run, cfg, a.n_grains, a.seed, frac=a.frac_grains, n_frames=a.n_frames, frac_frames=a.frac_frames, folder=a.frames_dir)
    sample.write.mode("overwrite").parquet(f"{folder}_sample")
    outlines.write.mode("overwrite").parquet(f"{folder}_contours")
    sample, log = spark.read.parquet(f"{folder}_sample"), f"{folder}_log"
    labelling.take_over(spark, f"{folder}.csv", log)
    keys = a.keys.split() if a.keys is not None else (line.strip() for line in sys.stdin)
    for line in labelling.walk(spark, sample, log, keys, cfg):
        print(line)
    labelling.write_labels(spark, log, jobs.read_grains(spark, a.run, cfg), cfg, f"{folder}.csv")
    done = labelling.progress(sample, labelling.events(spark, log)).first()
    print(f"{done.n_labelled} of {done.n_total} labelled in {folder}.csv")


def main(argv: list[str] | None = None) -> int:
    p = parser()
    a = p.parse_args(argv)
    cfg = load_config(getattr(a, "config", None))
    if a.command == "detect" and a.camera is not None and a.camera not in (known := sorted(set(cfg.filename.camera_map.values()))):
        p.error(f"--camera: {a.camera!r} is not a configured camera (one of {known})")
    cores = cfg.runtime.n_jobs if getattr(a, "jobs", None) is None else a.jobs
    spark = session(a.master or f"local[{cores if cores > 0 else '*'}]")
    if a.command == "detect":
        done = jobs.run_detect(spark, a.frames, a.out, cfg, force=a.force, sample_id=a.sample_id, camera=a.camera)
        print(f"{done['processed']} frames processed, {done['n_objects']} grains: {done['frames']}")
        if a.overview:
            drawn = jobs.run_overviews(spark, a.out, a.frames, cfg, a.overview_factor)
            print("no grains detected: nothing to draw" if drawn is None else f"{drawn.filter('error is null').count()} overviews in {a.out}/overviews")
    elif a.command == "aggregate":
        print("\n".join(jobs.run_aggregate(spark, a.grains, a.out, cfg)) or NOTHING.format(a.grains))
    elif a.command == "report":
        print("\n".join(jobs.run_report(spark, a.grains, a.out, cfg, a.frames)) or NOTHING.format(a.grains))
    elif a.command == "overlay":
        grains = jobs.read_grains(spark, a.run, cfg)
        if grains is None:
            print(NOTHING.format(a.run))
            return 0
        ids = [i.strip() for i in (a.frame_ids or "").split(",") if i.strip()]
        if not ids:
            hint = ", ".join(r.frame_id for r in aggregate.frame_hint(grains).collect())
            print(f"--frames is required: frame ids, separated by commas. There are {hint}, for example.")
            return 1
        done = jobs.run_overlay(spark, a.run, a.frames, a.out, cfg, ids, factor=a.factor, labels=a.labels)
        print(f"{done.filter('error is null').count()} overlays in {a.out}, {done.filter('error is not null').count()} frames failed")
    elif a.command == "colocate":
        print(f"grains and contours in {jobs.run_colocate(spark, a.run, cfg, a.buckets)} buckets of {a.run}/{jobs.COLOCATED}")
    elif a.command == "groundtruth":
        label(a, spark, cfg)
    else:
        print(f"{jobs.make_smaller(spark, a.frames, a.out, a.factor).count()} frames in {a.out}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
