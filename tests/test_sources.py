"""Co-located tables, feather scans, arriving files and blanks that come late."""

import math
import os
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skiagram.config import load_config
from skiagram.kernel import synthetic as S
from skiagram.operators import review, schema
from skiagram.plans import catalog, jobs
from skiagram.sources import arrivals, colocated, feather, tables
from skiagram.sources.images import encode_bmp
from skiagram.streaming.frames import detect_stream

CFG = load_config(overlay={"calibration": {"um_per_px": {"basic": 2.0, "zoom": 1.0}}, "output": {"format": "parquet"}})


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


# --------------------------------------------------------------------------------------------------------------- co-located


def test_colocated_tables_join_and_count_without_a_shuffle(spark, tmp_path):
    grains = spark.range(400).select(F.concat(F.lit("f"), F.col("id") % 23).alias("frame_id"), F.concat(F.lit("f"), F.col("id") % 23, F.lit(":"), F.col("id")).alias("grain_uid"), (F.col("id") % 3 == 0).alias("qc_pass"))
    contours = grains.filter("qc_pass").select("frame_id", "grain_uid", F.lit("POLYGON EMPTY").alias("wkt"))
    a, b = (colocated.read(spark, colocated.write(t, f"{tmp_path}/it's {n}", 4), t.schema, 4) for n, t in (("a", grains), ("b", contours)))
    joined = review.with_contours(a, b)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
        per_frame = joined.groupBy("frame_id").agg(F.count("wkt").alias("n"))
        assert "Exchange" not in plan(per_frame) and "Exchange" not in plan(b.join(a.filter("qc_pass").select("frame_id"), "frame_id", "left_semi"))
        assert rows(joined.select("grain_uid", "wkt")) == rows(review.with_contours(grains, contours).select("grain_uid", "wkt"))
        assert rows(per_frame) == rows(contours.groupBy("frame_id").agg(F.count("wkt").alias("n")).unionByName(grains.select("frame_id").distinct().join(contours, "frame_id", "left_anti").withColumn("n", F.lit(0).cast("long"))))
        one = review.with_contours(a.filter("frame_id = 'f7'"), b.filter("frame_id = 'f7'"))
        assert "Exchange" not in plan(one) and one.count() == grains.filter("frame_id = 'f7'").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len([f for f in os.listdir(f"{tmp_path}/it's a") if f.endswith(".parquet")]) == 4
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("colocated")]
    empty = colocated.read(spark, colocated.write(grains.limit(0), f"{tmp_path}/none", 4), grains.schema, 4)
    assert empty.count() == 0


def test_query_reads_stored_tables_where_they_lie(spark):
    got = catalog.grains_with_contours_colocated(spark, "/root/testdata/sf0.001")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(got.select("*"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def put(folder, name, image):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_bytes(encode_bmp(image))
    return str(path)


def test_overlays_read_copies_until_the_run_changes(spark, tmp_path):
    d, out = tmp_path / "in", str(tmp_path / "out")
    put(d, "S1_b_0000001.bmp", S.frame(128, 128, [S.Disc("ellipse", 40, 40, 14, 14), S.Disc("ellipse", 90, 90, 12, 10)]))
    jobs.run_detect(spark, str(d), out, CFG)
    plain = [rows(t.select("grain_uid", "frame_id")) for t in jobs.read_joined(spark, out, CFG)]
    assert jobs.run_colocate(spark, out, CFG, 2) == 2
    assert all("/out/colocated/" in f for t in jobs.read_joined(spark, out, CFG) for f in t.inputFiles())
    assert [rows(t.select("grain_uid", "frame_id")) for t in jobs.read_joined(spark, out, CFG)] == plain
    assert jobs.run_overlay(spark, out, str(d), str(tmp_path / "png"), CFG, ["S1_b_0000001"]).filter("error is null").count() == 1
    assert jobs.run_groundtruth(spark, out, CFG, 1)[1].count() == 1
    put(d, "S1_b_0000002.bmp", S.frame(128, 128, [S.Disc("ellipse", 60, 60, 14, 14)]))
    told = jobs.run_detect(spark, str(d), out, CFG)
    assert told["processed"] == 1 and told["frames"] == {"ok": 2} and told["n_objects"] == 3 and set(told["rejection_counts"]) == set(jobs.FLAGS)
    assert not os.path.exists(f"{out}/colocated") and jobs.read_joined(spark, out, CFG)[0].count() == 3
    with pytest.raises(FileNotFoundError):
        jobs.run_colocate(spark, str(tmp_path / "nowhere"), CFG)


# ------------------------------------------------------------------------------------------------------------------ feather


@pytest.fixture()
def feathers(spark, tmp_path):
    """A table of texts, integers, doubles with NaN, infinities and nulls, in folders by k."""
    rows = [(f"r{n}", None if n % 7 == 0 else n, math.nan if n % 5 == 0 else n / 4, "ab"[n % 2] if n % 11 else None, n % 3 == 0) for n in range(60)] + [("inf", 5, math.inf, "a", None)]
    df = spark.createDataFrame(rows, "name string, n int, x double, k string, flag boolean").repartition(3)
    return df, tables.write_partitioned(df, str(tmp_path / "t"), "feather", ["k"])


@pytest.mark.parametrize("where", ["x > 3", "x >= 3 and n < 40", "x < 3", "x <= 2.5", "x = 2.5", "n in (3, 4, 7)", "n is null", "n is not null and k = 'a'", "k in ('b', 'c')", "k is null", "name = 'r3'", "flag", "x > 3 or n = 1", "n > 2.5", "k = 'none'", "name like 'r1%'", "n <> 3"])
def test_feather_filters_are_those_of_spark(spark, feathers, where):
    df, path = feathers
    for on in ("true", "false"):
        spark.conf.set(feather.PUSHDOWN, on)
        try:
            assert rows(feather.read(spark, path, df.schema).filter(where)) == rows(df.filter(where))
        finally:
            spark.conf.set(feather.PUSHDOWN, "true")


def test_feather_reads_what_is_asked_for(spark, feathers, monkeypatch):
    df, path = feathers
    assert rows(feather.read(spark, f"file://{path}").select(*df.columns)) == rows(df)  # a URI, without a schema
    some = feather.read(spark, path, schema.of(name=schema.TEXT, missing=schema.REAL)).filter("name = 'r3'")
    assert rows(some) == [str(("r3", None))]
    assert re.search(r"PythonDataSource|BatchScan", plan(some)) and "Filter (" not in plan(some).replace("isnotnull", "")
    reader = feather.FilteringReader(df.schema, path)
    from pyspark.sql.datasource import EqualTo, GreaterThan, Not

    left = list(reader.pushFilters([EqualTo(("k",), "a"), GreaterThan(("x",), 1.0), Not(EqualTo(("n",), 1)), GreaterThan(("flag",), True)]))
    assert [type(f) for f in left] == [Not, GreaterThan]
    assert {os.path.basename(os.path.dirname(p.path)) for p in reader.partitions()} == {"k=a"}  # other folders aren't opened
    assert set(pa.Table.from_batches([b for p in reader.partitions() for b in reader.read(p)])["k"].to_pylist()) == {"a"}
    monkeypatch.setattr(feather, "LARGE", 1)
    cut = feather.FeatherReader(df.schema, path).partitions()
    assert all(p.last == p.first + 1 for p in cut)
    assert sum(b.num_rows for p in cut for b in feather.FeatherReader(df.schema, path).read(p)) == df.count()
    assert feather.read(spark, f"{path}/nothing", df.schema).count() == 0
    with pytest.raises(Exception, match="feather"):
        feather.read(spark, f"{path}/nothing").count()


def test_a_large_table_of_few_keys_is_dealt_in_shares(spark, tmp_path, monkeypatch):
    """One key is not one task, however many rows it has."""
    from skiagram.operators import ranks

    df = spark.range(4000).selectExpr("id", "'a' as k")
    monkeypatch.setattr(ranks, "SMALL", 0)
    sizes = tables.dealt(df, ["k"]).rdd.glom().map(len).collect()
    assert sum(sizes) == 4000 and max(sizes) < 2500
    path = tables.write_partitioned(df, str(tmp_path / "large"), "feather", ["k"])
    assert len(feather.files_of(path)) > 1 and rows(feather.read(spark, path, df.schema)) == rows(df)


# ----------------------------------------------------------------------------------------------------------------- arrivals


def test_offsets_are_times_of_arrival(tmp_path):
    (tmp_path / "deep").mkdir()
    a, b = tmp_path / "a_b_1.bmp", tmp_path / "deep" / "a_b_2.BMP"
    a.write_bytes(b"1")
    (tmp_path / ".hidden.bmp").write_bytes(b"1")
    (tmp_path / "notes.txt").write_bytes(b"1")
    reader = arrivals.ArrivalReader(str(tmp_path), 0)
    seen = lambda start, end: [r[0] for p in reader.partitions(start, end) for r in reader.read(p)]
    one = reader.latestOffset()
    assert seen(reader.initialOffset(), one) == [str(a)]
    b.write_bytes(b"2")
    os.utime(b, (1, 1))  # an old file that arrives now
    two = reader.latestOffset()
    assert seen(one, two) == [str(b)]
    a.write_bytes(b"12")
    three = reader.latestOffset()
    assert seen(two, three) == [str(a)] and seen(one, two) == [str(b)] and seen(three, three) == []
    a.unlink()
    b.unlink()
    assert reader.latestOffset() == three
    assert arrivals.ArrivalReader(f"file://{tmp_path}", 3600).latestOffset() == {"until": 0}
    assert arrivals.ArrivalReader(f"{tmp_path}/nothing", 0).latestOffset() == {"until": 0}


def compared(spark, out):
    grains = jobs.read_grains(spark, out, CFG).select("grain_uid", F.round("area_px", 6), "qc_pass")
    manifest = tables.read_table(spark, f"{out}/manifest", "parquet", schema.MANIFEST).select("frame_id", "fingerprint", "status", "n_objects", "flatfield_method")
    return rows(grains), rows(manifest)


def test_late_blanks_and_changed_frames_on_a_stream(spark, tmp_path):
    """After every run the stream's tables are those of a batch run over the same files."""
    d, out = tmp_path / "in", str(tmp_path / "out")
    shade = [S.Disc("ellipse", 40, 40, 14, 14), S.Disc("ellipse", 90, 90, 12, 10)]

    def run(k):
        q = detect_stream(spark, str(d), out, CFG, str(tmp_path / "cp"), settle=0)
        assert q.awaitTermination(300) and q.exception() is None
        fresh = str(tmp_path / f"batch{k}")
        jobs.run_detect(spark, str(d), fresh, CFG)
        assert compared(spark, out) == compared(spark, fresh)
        return {r.frame_id: r.flatfield_method for r in tables.read_table(spark, f"{out}/manifest", "parquet", schema.MANIFEST).collect()}

    put(d, "S1_b_0000001.bmp", S.frame(128, 128, shade))
    put(d, "S2_z_0000001.bmp", S.frame(128, 128, shade[:1]))
    assert run(0) == {"S1_b_0000001": "morphological", "S2_z_0000001": "morphological"}
    put(d, "S1_b_back.bmp", S.frame(128, 128, []))  # late: the frame comes again
    put(d, "S1_b_0000002.bmp", S.frame(128, 128, shade[1:]))
    assert run(1) == {"S1_b_0000001": "blank", "S1_b_0000002": "blank", "S2_z_0000001": "morphological"}
    put(d, "S1_b_0000002.bmp", S.frame(128, 128, []))  # changed in place
    put(d, "S1_b_0000003.bmp", S.frame(128, 128, shade))  # its blank came two runs ago
    assert run(2) == {"S1_b_0000001": "blank", "S1_b_0000002": "blank", "S1_b_0000003": "blank", "S2_z_0000001": "morphological"}
