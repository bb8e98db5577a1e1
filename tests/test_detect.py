"""Frames to tables: whole runs on synthetic frames, resumed, changed and broken."""

import json
import os

import pytest

from skiagram.config import load_config
from skiagram.kernel import synthetic as S
from skiagram.operators import detect, review
from skiagram.plans import jobs
from skiagram.sources import tables
from skiagram.sources.images import decode, encode_bmp
from skiagram.streaming.frames import detect_stream

CFG = load_config(overlay={"calibration": {"um_per_px": {"basic": 2.0, "zoom": 1.0}}, "output": {"format": "parquet"}})


def put(folder, name, image):
    (folder / name).write_bytes(encode_bmp(image))


@pytest.fixture()
def frames(tmp_path):
    d = tmp_path / "in"
    d.mkdir()
    put(d, "S1_b_0000001.bmp", S.frame(128, 128, [S.Disc("ellipse", 40, 40, 14, 14), S.Disc("ellipse", 90, 90, 12, 10)]))
    put(d, "S1_b_0000002.bmp", S.frame(128, 128, [S.Disc("rect", 3, 60, 20, 12)]))
    put(d, "S1_b_0000003.bmp", S.frame(128, 128, []))
    put(d, "S1_b_back.bmp", S.frame(128, 128, []))
    put(d, "001_z_0000001.bmp", S.frame(128, 128, [S.Disc("blob", 60, 60, 20, 16)]))
    (d / "S1_b_0000009.bmp").write_bytes(b"BM broken")
    (d / "._S1_b_0000008.bmp").write_bytes(b"x")
    return d


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_run_resume_and_change(spark, frames, tmp_path):
    out = str(tmp_path / "out")
    first = jobs.run_detect(spark, str(frames), out, CFG)
    assert first["frames"] == {"ok": 3, "empty": 1, "error": 1} and first["n_objects"] == 4 and first["processed"] == 5
    grains = jobs.read_grains(spark, out, CFG)
    assert rows(grains, "grain_uid", "sample_id", "flag_border", "qc_pass") == [
        ("001_z_0000001:1", "001", False, True),
        ("S1_b_0000001:1", "S1", False, True),
        ("S1_b_0000001:2", "S1", False, True),
        ("S1_b_0000002:1", "S1", True, False),
    ]
    assert len(grains.columns) == 110
    assert jobs.read_contours(spark, out, CFG, ["S1_b_0000001"]).count() == 2
    methods = rows(tables.read_table(spark, f"{out}/manifest", "parquet", jobs.schema.MANIFEST), "frame_id", "flatfield_method")
    assert methods[0] == ("001_z_0000001", "morphological") and methods[1] == ("S1_b_0000001", "blank")
    errors = tables.read_table(spark, f"{out}/errors", "parquet", jobs.schema.ERRORS)
    assert rows(errors, "frame_id") == [("S1_b_0000009",)]
    assert json.load(open(f"{out}/summary.json"))["n_objects"] == 4 and not os.path.exists(f"{out}/_staged")

    assert jobs.run_detect(spark, str(frames), out, CFG)["processed"] == 0
    put(frames, "001_z_0000001.bmp", S.frame(120, 128, []))
    put(frames, "S1_b_0000009.bmp", S.frame(128, 128, [S.Disc("ellipse", 60, 60, 14, 14)]))
    again = jobs.run_detect(spark, str(frames), out, CFG)
    assert again["processed"] == 2 and again["n_objects"] == 4 and "error" not in again["frames"]
    left = jobs.read_grains(spark, out, CFG)
    assert [r[0] for r in rows(left, "grain_uid")] == ["S1_b_0000001:1", "S1_b_0000001:2", "S1_b_0000002:1", "S1_b_0000009:1"]
    assert not os.path.exists(f"{out}/errors")

    assert len(jobs.run_aggregate(spark, out, str(tmp_path / "agg"), CFG)) == 4
    assert spark.read.parquet(str(tmp_path / "agg/summary")).first().n_total == 4
    assert len(jobs.run_report(spark, out, str(tmp_path / "rep"), CFG, str(frames))) == 6
    drawn = spark.read.parquet(str(tmp_path / "rep" / "sheets")).collect()
    assert {(r.flag, r.n_tiles, r.n_shown) for r in drawn} == {("accepted", 3, 3), ("flag_border", 1, 1)}
    sheet = decode((tmp_path / "rep" / "contact_sheets" / "accepted_001.png").read_bytes())
    assert sheet.shape == (96, 576) and (sheet[:, :288] < 100).any() and (sheet[:, 288:] == 255).all()
    drawn = jobs.run_overlay(spark, out, str(frames), str(tmp_path / "png"), CFG)
    assert drawn.count() == 3 and drawn.filter("error is not null").count() == 0
    assert decode((tmp_path / "png" / "S1_b_0000001_overlay.png").read_bytes()).shape == (128, 128)
    sample, outlines = jobs.run_groundtruth(spark, out, CFG, 3, folder=str(frames))
    assert sample.count() == 3 and outlines.count() == 3
    assert jobs.make_smaller(spark, str(frames), str(tmp_path / "small"), 4).count() == 6


@pytest.mark.parametrize("fmt", ["csv", "feather"])
def test_other_formats_give_the_same_rows(spark, frames, tmp_path, fmt):
    cfg = load_config(overlay={"calibration": {"um_per_px": {"basic": 2.0, "zoom": 1.0}}, "output": {"format": fmt}})
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    jobs.run_detect(spark, str(frames), a, CFG)
    jobs.run_detect(spark, str(frames), b, cfg)
    assert jobs.run_detect(spark, str(frames), b, cfg)["processed"] == 0
    cols = ("grain_uid", "sample_id", "run", "label", "area_um2", "touches_border", "qc_pass", "efd_3_a")
    assert rows(jobs.read_grains(spark, a, CFG), *cols) == rows(jobs.read_grains(spark, b, cfg), *cols)


def test_missing_calibration_writes_nothing(spark, frames, tmp_path):
    out = tmp_path / "out"
    with pytest.raises(KeyError):
        jobs.run_detect(spark, str(frames), str(out), load_config(overlay={"calibration": {"um_per_px": {"basic": 1.0}}}))
    assert not out.exists()


def test_stream_equals_batch(spark, frames, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    jobs.run_detect(spark, str(frames), a, CFG)
    for _ in range(2):
        q = detect_stream(spark, str(frames), b, CFG, str(tmp_path / "cp"))
        q.awaitTermination(120)
        assert q.exception() is None
        cols = ("grain_uid", "area_px", "qc_pass")
        assert rows(jobs.read_grains(spark, a, CFG), *cols) == rows(jobs.read_grains(spark, b, CFG), *cols)


def test_first_unlabelled_and_neighbours(spark):
    order = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2)], "grain_uid string, position int")
    assert review.first_unlabelled(order, order.filter("grain_uid = 'a'")) == 1
    assert review.first_unlabelled(order, order) == 0
    assert rows(review.neighbours(order), "grain_uid", "previous_uid", "next_uid") == [("a", "a", "b"), ("b", "a", "c"), ("c", "b", "c")]


def test_small_drawn_frames_are_dealt_in_large_tasks(spark):
    found = detect.drawn(spark.range(1500), CFG)
    assert found.rdd.getNumPartitions() <= max(2 * spark.sparkContext.defaultParallelism, 3)
    few = detect.drawn(spark.range(20, 24), CFG)
    assert rows(few, "key", "n_objects", "a", "b") == [(k, 1, 8.0 + k % 9, (8.0 + k % 9) * (1 - k % 4 / 8)) for k in range(20, 24)]
