"""Configuration files, command line, labelling, overlays: what a user touches."""

import csv
import math

import numpy as np
import pytest
import yaml
from pyspark.sql import functions as F

from skiagram import cli
from skiagram.config import FLAGS, config_hash, layered, load_config
from skiagram.kernel import outlines
from skiagram.kernel import synthetic as S
from skiagram.operators import labelling, review, sampling, schema
from skiagram.plans import jobs
from skiagram.sources import frames as frame_source
from skiagram.sources import images, tables

#: The keys of the configuration file that users have, with their defaults.
FILE = """
calibration: {um_per_px: {basic: null, zoom: null}}
filename:
  sample_regex: '(?P<sample>.+?)_(?P<cam>[bz])_(?:(?P<frame>\\d+)|back)$'
  camera_map: {b: basic, z: zoom}
  blank_regex: '(?i)(?:^|[_-])back$'
flatfield: {method: auto, morph_kernel_px: 201}
threshold: {method: half_max, half_max_fraction: 0.5, core_percentile: 5, min_object_depth: 0.40}
detect: {min_area_px: 25, fill_holes: true}
measure: {efd_order: 15, efd_resample_n: 256, wadell_smoothing: 1.0, curvature_resample_n: 256, curvature_smoothing: 2.0, curvature_bins: 32}
qc:
  min_ecd_px: 10
  defocus_edge_width_px: 5.25
  defocus_contrast_min: 0.70
  sliver_aspect_ratio: 3.0
  sliver_max_ecd_px: 40
  agglomerate_solidity_max: 0.90
  disqualifying_flags: [flag_defocus, flag_border, flag_too_small, flag_sliver, flag_no_polygon]
output: {format: csv, save_contours: true, partition: true}
runtime: {n_jobs: -1}
groundtruth:
  classes:
    - {key: '0', value: 0, name: exclude}
    - {key: '1', value: 1, name: include}
    - {key: '2', value: 2, name: special}
  lhs_axes: [ecd_px, edge_width_px, contrast, qc_aspect_ratio, qc_solidity]
  reserved: {border: 2, no_polygon: 1}
  crop_pad_px: 24
  mask_alpha: 0.35
  show_predicted_status: false
"""


def test_the_whole_file_is_the_default(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text(FILE)
    assert load_config(p) == load_config() and config_hash(load_config(p)) == config_hash(load_config())
    assert load_config().output.format == "csv"
    p.write_text("")
    assert load_config(p) == load_config()


@pytest.mark.parametrize("bad", ["flatfield: {method: bogus}", "threshold: {method: bogus}", "output: {format: xml}", "qc: {disqualifying_flags: [defocus]}", "qc: {nothing: 1}", "groundtruth: {classes: [{key: '0', name: x}]}"])
def test_mistakes_fail_at_load(tmp_path, bad):
    p = tmp_path / "c.yaml"
    p.write_text(bad)
    with pytest.raises(ValueError):
        load_config(p)


def test_layers():
    assert layered({"a": {"b": 1, "c": 2}, "d": 1}, {"a": {"b": 3}}, {"d": {"e": 1}}) == {"a": {"b": 3, "c": 2}, "d": {"e": 1}}
    assert layered({"a": {"b": 1}}, {"a": None}, {"a": {"c": 2}}) == {"a": {"c": 2}}
    with pytest.raises(KeyError, match="calibration"):
        load_config().um_per_px("basic")
    assert load_config(overlay={"calibration": {"um_per_px": {"basic": 5.0}}}).um_per_px("basic") == 5.0


def grain_rows(spark, n):
    """Grains g0, g1, ... of which every second touches the border."""
    flags = {f: F.lit(False) for f in FLAGS} | {"flag_border": F.col("id") % 2 == 1, "qc_pass": F.col("id") % 2 == 0}
    about = {"grain_uid": F.concat(F.lit("g"), "id"), "frame_id": F.lit("f"), "sample_id": F.lit("S"), "camera": F.lit("basic"), "ecd_px": F.col("id") + 10.25}
    return spark.range(n).withColumns(flags | about).drop("id")


def told(spark, log):
    return {r.grain_uid: (r.label, r.label_name) for r in labelling.current(labelling.events(spark, log)).collect()}


def test_sittings_come_together_in_the_log(spark, tmp_path):
    cfg, log, grains = load_config(), str(tmp_path / "log"), grain_rows(spark, 3)
    lines = list(labelling.walk(spark, grains, log, ["2", "x", "0", "left", "1", "q", "2"], cfg, "morning"))
    assert [x[:5] for x in lines] == ["[2/3]", "[2/3]", "[3/3]", "[2/3]", "[3/3]"]
    assert told(spark, log) == {"g0": (2, "special"), "g1": (1, "include")}
    assert labelling.progress(grains, labelling.events(spark, log)).first().asDict() == {"grain_uid": "g2", "n_labelled": 2, "n_total": 3}
    # a second sitting opens at the open row, goes no further than the ends and takes a label back
    lines = list(labelling.walk(spark, grains, log, ["n", "p", "p", "p", "u", "u", "i", "m"], cfg, "noon"))
    assert lines[0].startswith("[3/3]  g2") and lines[3].endswith("label: 2") and lines[4].endswith("label: -")
    assert lines[6] == "[1/3]  g0   |   S / basic   |   ecd 10.2 px   |   predicted: accept   |   label: -"
    assert told(spark, log) == {"g1": (1, "include")}
    assert {(r.grain_uid, r.n_given, r.n_different) for r in labelling.changes(labelling.events(spark, log)).collect()} == {("g0", 1, 1), ("g1", 2, 2)}
    assert labelling.events(spark, log).count() == 4  # taking back what isn't there is no event
    assert {tuple(r) for r in labelling.agreement(labelling.events(spark, log), grains).collect()} == {("include", "reject", "flag_border", 1)}


def test_label_file_from_the_log_and_back(spark, tmp_path):
    cfg, log, path, grains = load_config(), str(tmp_path / "log"), str(tmp_path / "g.csv"), grain_rows(spark, 2)
    assert list(labelling.walk(spark, grains.limit(0), log, ["1"], cfg)) == [] and labelling.events(spark, log).count() == 0
    labelling.append(spark, log, [("gone", 1, "include", "2024-01-01T00:00:00", "a", 0), ("g1", 0, "exclude", "2024-01-02T00:00:00", "a", 1), (None, 0, "exclude", "2024-01-02T00:00:00", "a", 2), ("g1", 2, "special", "2024-01-02T00:00:00", "b", 0)])
    labelling.write_labels(spark, log, grains, cfg, path)
    with open(path, newline="") as f:
        rows = list(csv.DictReader(f))
    assert list(rows[0]) == schema.LABELS.names and [f.name for f in tmp_path.iterdir() if "csv" in f.name and not f.name.startswith(".")] == ["g.csv"]
    assert [(r["grain_uid"], r["label"], r["qc_status"], r["flags"]) for r in rows] == [("g1", "2", "reject", "flag_border"), ("gone", "1", "", "")]
    assert labelling.read_labels(spark, path).filter("label = 2").first().ecd_px == 11.25
    other = str(tmp_path / "other")
    for _ in range(2):  # the second time there is a log
        labelling.take_over(spark, path, other)
    assert told(spark, other) == told(spark, log) and labelling.events(spark, other).count() == 2
    labelling.write_labels(spark, str(tmp_path / "none"), grains, cfg, path)
    assert labelling.read_labels(spark, path).count() == 0


def test_views_follow_from_keys_alone():
    cfg = load_config()
    at = labelling.View(1, True, False)
    assert labelling.pressed(at, "1", 3, cfg) == (at._replace(at=2), (1, "include"))
    assert labelling.pressed(at, "backspace", 3, cfg) == (at, (None, None))
    assert labelling.pressed(at, "right", 2, cfg) == (at, None)
    assert labelling.pressed(at, "m", 3, cfg)[0].outline is False and labelling.pressed(at, "i", 3, cfg)[0].verdict is True
    assert labelling.opened(["a", "b"], {"a": 1}, cfg).at == 1 and labelling.opened(["a"], {"a": 1}, cfg).at == 0
    row = {"grain_uid": "b", "sample_id": "S", "camera": "basic", "ecd_px": math.nan, "qc_status": "reject", "flags": "flag_border"}
    assert labelling.line(at._replace(verdict=True), row, 3, 0) == "[2/3]  b   |   S / basic   |   predicted: reject (flag_border)   |   label: 0"


def test_counts():
    assert [sampling.resolve_count(*x) for x in ((5, None, 3), (-1, None, 3), (None, 0.5, 5), (None, 0.5, 3), (None, 2.0, 3), (None, None, 7), (2, 0.9, 7))] == [3, 0, 2, 2, 3, 7, 2]


def test_polygons_are_repaired():
    t = np.arange(24) * 2 * np.pi / 24
    ring = np.column_stack([10 * np.cos(t), 10 * np.sin(t)])
    valid = outlines.Polygon(ring, [ring / 2])
    assert outlines.repaired(valid) is valid
    bow = outlines.repaired(outlines.Polygon(np.array([(0.0, 0), (10, 10), (10, 0), (0, 10)]), []))
    assert outlines.area(bow) == pytest.approx(25) and not len(outlines.meetings(bow.exterior)[0])
    square = np.array([(0.0, 0), (10, 0), (10, 10), (0, 10)])
    wide = outlines.repaired(outlines.Polygon(square, [square * 2 - 5]))
    assert outlines.area(wide) == 100 and not wide.holes
    apart = outlines.repaired(outlines.Polygon(square, [square / 5 + 2, square / 5 + 30]))
    assert outlines.area(apart) == 96
    assert outlines.repaired(outlines.Polygon(np.array([(0.0, 0), (1, 0), (2, 0)]), [])) is None
    t = (np.arange(200) + 0.3) * 2 * np.pi / 200
    eight = np.column_stack([10 * np.sin(t), 10 * np.sin(t) * np.cos(t)])
    assert outlines.area(outlines.repaired(outlines.Polygon(eight, []))) == pytest.approx(200 / 3, rel=0.01)


def put(folder, name, image):
    (folder / name).write_bytes(images.encode_bmp(image))


@pytest.fixture()
def run(tmp_path):
    d = tmp_path / "in"
    (d / "deep").mkdir(parents=True)
    put(d, "S1_b_back.bmp", S.frame(128, 128, []))
    put(d, "S1_b_0000001.bmp", S.frame(128, 128, [S.Disc("ellipse", 64, 64, 18, 18)]))
    put(d / "deep", "S1_b_0000002.bmp", S.frame(128, 128, [S.Disc("ellipse", 40, 64, 12, 18), S.Disc("ellipse", 100, 64, 12, 18)]))
    (tmp_path / "c.yaml").write_text(yaml.safe_dump({"calibration": {"um_per_px": {"basic": 5.0, "zoom": 1.0}}}))
    return tmp_path


def command(run, *args):
    return cli.main(["--master", "local[4]", *(str(x) for x in args), *([] if args[0] == "make-fixtures" else ["--config", str(run / "c.yaml")])])


def test_commands_end_to_end(spark, run, capsys):
    out = run / "out"
    assert command(run, "detect", run / "in", out, "--jobs", "1", "--overview") == 0
    assert {p.name for p in (out / "overviews").glob("*.png")} == {"S1_b_0000001_overlay.png", "S1_b_0000002_overlay.png"}
    assert b"accepted=1, rejected=0" in (out / "overviews" / "S1_b_0000001_overlay.png").read_bytes()
    assert command(run, "aggregate", out / "grains", run / "agg") == 0 and command(run, "aggregate", out, run / "agg2") == 0
    cfg = load_config(run / "c.yaml")
    per_frame = spark.read.option("header", "true").csv(str(run / "agg" / "per_frame"))
    assert [r.frame_id for r in per_frame.collect()] == ["S1_b_0000001", "S1_b_0000002"]
    assert command(run, "report", out, run / "in", run / "rep") == 0
    capsys.readouterr()
    assert command(run, "overlay", out, run / "in", run / "png") == 1
    assert "--frames is required" in (said := capsys.readouterr().out) and "S1_b_0000002" in said
    assert command(run, "overlay", out, run / "in", run / "png", "--frames", "S1_b_0000001, S1_b_0000002", "--factor", "2", "--labels") == 0
    png = images.decode((run / "png" / "S1_b_0000001_overlay.png").read_bytes())
    assert png.shape == (64, 64)
    assert command(run, "groundtruth", out, "--n-grains", "2", "--seed", "1", "--keys", "1 0 q", "--frames-dir", run / "in") == 0
    got = labelling.read_labels(spark, str(out / "groundtruth.csv")).collect()
    assert [(r.label, r.label_name, r.qc_status) for r in got] == [(1, "include", "accept"), (0, "exclude", "accept")]
    assert command(run, "groundtruth", out, "--frac-grains", "1.0", "--frac-frames", "0.5", "--out", run / "l.csv", "--keys", "") == 0
    assert command(run, "colocate", out, "--buckets", "2") == 0 and "2 buckets" in capsys.readouterr().out
    assert command(run, "make-fixtures", run / "in", run / "small", "--factor", "4") == 0
    assert jobs.run_detect(spark, str(run / "in"), str(out), cfg)["processed"] == 0


def test_commands_without_grains(spark, run, capsys):
    (run / "in" / "S1_b_0000001.bmp").unlink()
    put(run / "in" / "deep", "S1_b_0000002.bmp", S.frame(128, 128, []))
    assert command(run, "detect", run / "in", run / "out", "--overview") == 0
    assert not (run / "out" / "overviews").exists()
    assert command(run, "aggregate", run / "nowhere", run / "agg") == 0 and not (run / "agg").exists()
    with pytest.raises(SystemExit):
        command(run, "detect", run / "in", run / "x", "--camera", "none")
    assert "not a configured camera" in capsys.readouterr().err
    with pytest.raises(FileNotFoundError):
        jobs.run_groundtruth(spark, str(run / "nowhere"), load_config(), 1)


def test_marks_and_labels_on_overlays():
    blank = np.full((80, 80, 3), 200, np.uint8)
    row = {"centroid_x": 80.0, "centroid_y": 80.0, "wkt": None, "qc_pass": False, "label": 12}
    plain, marked = review.annotated(blank, [row], 2, False), review.annotated(blank, [row], 2, True)
    is_colour = lambda a, c: (a == c).all(axis=2)
    assert is_colour(plain, review.UNOUTLINED).sum() == 17 and not is_colour(plain, review.REJECTED).any()
    assert is_colour(marked, review.REJECTED).sum() > 40
    assert (review.annotated(blank, [row | {"centroid_x": math.nan}], 2, True) == blank).all()
    both = review.painted(np.full((60, 60), 200, np.uint8), [{"qc_pass": k == 0, "wkt": w} for k, w in enumerate(("POLYGON ((5 5, 20 5, 20 20, 5 20, 5 5))", "POLYGON ((30 30, 70 30, 70 50, 30 50, 30 30))", "POLYGON EMPTY", None))], 1)
    assert is_colour(both, review.ACCEPTED).any() and is_colour(both, review.REJECTED).any()


def test_smaller_without_aliases():
    flat = np.full((64, 48, 3), 90, np.uint8)
    assert (images.smoothed_smaller(flat, 4) == 90).all() and images.smoothed_smaller(flat, 4).shape == (16, 12, 3)
    stripes = np.tile(np.array([[0, 255]], np.uint8), (64, 32))
    assert np.ptp(images.smoothed_smaller(stripes, 4)[4:-4, 4:-4]) <= 4
    assert images.smoothed_smaller(stripes, 1) is stripes


def test_listing_in_tasks_and_order(spark, run):
    found = frame_source.in_path_order(frame_source.listing(spark, str(run / "in"))).collect()
    assert [r.frame_path.rsplit("/", 1)[1] for r in found] == ["S1_b_0000001.bmp", "S1_b_back.bmp", "S1_b_0000002.bmp"]
    assert frame_source.listing(spark, str(run / "nothing")).count() == 0


def test_tables_are_set_aside_and_formats(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(3).write.parquet(a)
    spark.range(5).write.parquet(b)
    tables.moved(spark, b, a)
    assert spark.read.parquet(a).count() == 5 and sorted(p.name for p in tmp_path.iterdir()) == ["a"]
    df = spark.createDataFrame([("x", "True", "1"), ("y", "False", "True"), (None, None, None)], "a string, b string, c string")
    assert tables.with_booleans(df).dtypes == [("a", "string"), ("b", "boolean"), ("c", "string")]
    tables.write_partitioned(df.withColumn("k", F.col("a")), str(tmp_path / "f"), "feather", ["k"])
    assert {p.name for p in (tmp_path / "f").iterdir()} == {"k=x", "k=y", "k=None"}
    assert tables.with_extension("t", "csv") == tables.with_extension("t.csv", "csv") == "t.csv"
