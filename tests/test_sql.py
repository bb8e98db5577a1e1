"""SQL functions against the column expressions and hand-made cases, and a run's tables as views."""

import math

import pytest
from pyspark.sql import functions as F

from skiagram.config import Config, load_config
from skiagram.functions import gate, identity, sql
from skiagram.operators import schema
from skiagram.sources import tables

METRICS = "edge_width_px, contrast, touches_border, ecd_px, qc_aspect_ratio, qc_solidity, has_polygon"


@pytest.fixture(scope="module")
def metrics(spark):
    values = [None, math.nan, math.inf, -1.0, 0.7, 0.9, 3.0, 5.25, 5.3, 9.99, 10.0, 40.0, 41.0]
    rows = [(k, values[k % 13], values[(k * 5) % 13], (None, True, False)[k % 3], values[(k * 3 + 1) % 13], values[(k * 7) % 13], values[(k * 11) % 13], (True, None, False)[k % 3]) for k in range(500)]
    return spark.createDataFrame(rows, "k long, edge_width_px double, contrast double, touches_border boolean, ecd_px double, qc_aspect_ratio double, qc_solidity double, has_polygon boolean")


@pytest.mark.parametrize("cfg", [Config(), load_config(overlay={"qc": {"disqualifying_flags": [], "min_ecd_px": 0.7}}), load_config(overlay={"qc": {"disqualifying_flags": ["flag_sliver", "flag_border"]}})])
def test_flags_and_gate_are_those_of_the_expressions(spark, metrics, cfg):
    sql.register(spark, cfg)
    made = spark.sql(f"SELECT k, f.*, grain_accepted(f) AS qc_pass, grain_active_flags(f) AS active FROM (SELECT k, grain_flags({METRICS}) AS f FROM {{m}})", m=metrics)
    plain = gate.flagged(metrics, cfg.qc).select("k", *gate.FLAGS, "qc_pass", gate.active_flags().alias("active"))
    assert sorted(made.collect()) == sorted(plain.collect())
    assert "Python" not in made._jdf.queryExecution().executedPlan().toString()
    sizes = spark.createDataFrame([(x,) for x in (None, math.nan, math.inf, -0.1, 0.0, 62.4, 62.5, 3999.9, 4000.0, 1e9)], "x double")
    got = spark.sql("SELECT x, grain_size_index(x) AS i, grain_size_class(x) AS c FROM {s}", s=sizes).collect()
    assert str(got) == str(sizes.select("x", gate.ecd_bin_index(F.col("x")).alias("i"), gate.ecd_bin(F.col("x")).alias("c")).collect())


@pytest.mark.parametrize("pattern", [None, r"(?P<sample>[^_]+)_(?P<run>[^_]+)_(?P<cam>[bz])_(?:(?P<frame>\d+)|back)$", r"(?P<sample>it's)_(?P<cam>[bz])"])
def test_identity_is_that_of_the_expressions(spark, pattern):
    cfg = load_config(overlay={"filename": {"sample_regex": pattern}} if pattern else {})
    sql.register(spark, cfg, "frame_")
    paths = ["/d/S1_b_0000012.bmp", "/d/S1_z_back.bmp", "P_17_b_003.tiff", "/x/S_r2_b_7.png", "S_r2_z_back.png", "/d/notes.txt", "it's_b_4.bmp", "_b_1.bmp", "/d/a.b_z_99999999999999999999.bmp", ".bmp"]
    rows = spark.createDataFrame([(p,) for p in paths], "frame_path string")
    names = ("stem", "sample", "run", "camera", "is_blank", "frame_index")
    made = spark.sql(f"SELECT frame_path, {', '.join(f'frame_{n}(frame_path) AS {n}' for n in names)} FROM {{r}}", r=rows).filter("sample is not null and camera is not null")
    plain = identity.parsed(rows, cfg).select("frame_path", "stem", F.col("sample_id").alias("sample"), "run", "camera", "is_blank", "frame_index")
    assert sorted(map(str, made.collect())) == sorted(map(str, plain.collect())) and made.count()


def test_names_of_paths_take_few_patterns(spark):
    sql.register(spark)
    paths = ["", "/", "a/", ".bmp", "a.bmp", "a..bmp", "..", "a.", "x.y/b", "x/.y", "x/a.b.c", "a\n.bmp", "x/\n.bmp", "a.b\n", "\u2028.x", "\U0001f600.x", "a\r\nb.c", None]
    rows = spark.createDataFrame(list(enumerate(paths)), "n int, path string")
    assert spark.sql("SELECT n, grain_stem(path) AS s FROM {r}", r=rows).collect() == rows.select("n", identity.stem(F.col("path")).alias("s")).collect()
    made = spark.sql("SELECT grain_sample(path), grain_camera(path), max(grain_frame_index(path)) FROM {r} WHERE NOT grain_is_blank(path) GROUP BY ALL", r=rows)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert sum(plan.count(f) for f in ("regexp_extract(", "regexp_replace(", "split(", "RLIKE")) <= 20  # 48 once


def test_vertices_of_outlines(spark):
    sql.register(spark)
    texts = ["POLYGON ((0 0, 4 0, 4 3, 0 0))", " POLYGON((1.5 -2e1,2 3 , 1 1),(0 0, 1 0 ,0 1))", "POLYGON EMPTY", "", "LINESTRING (0 0, 1 1)", None, "POLYGON ((x y, 1 2))"]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, wkt string")
    got = {(r.n, r.ring, r.k): (r.x, r.y) for r in spark.sql("SELECT n, v.* FROM {r}, LATERAL grain_vertices(wkt) v", r=rows).collect()}
    want = {(0, 0, k): p for k, p in enumerate([(0, 0), (4, 0), (4, 3), (0, 0)])}
    want |= {(1, 0, k): p for k, p in enumerate([(1.5, -20), (2, 3), (1, 1)])} | {(1, 1, k): p for k, p in enumerate([(0, 0), (1, 0), (0, 1)])}
    assert got == want | {(6, 0, 0): (None, None), (6, 0, 1): (1, 2)}
    outer = spark.sql("SELECT n, count(v.k) AS n_vertices FROM {r} LEFT JOIN LATERAL grain_vertices(wkt) v GROUP BY n", r=rows)
    assert {r.n: r.n_vertices for r in outer.collect()} == {0: 4, 1: 6, 2: 0, 3: 0, 4: 0, 5: 0, 6: 2}


def test_edges_are_vertices_with_the_next_one(spark):
    from skiagram.plans import catalog

    sql.register(spark)
    texts = ["POLYGON ((0 0, 4 0, 4 3, 0 0))", " POLYGON((1.5 -2e1,2 3 , 1 1),(0 0, 1 0 ,0 1))", "POLYGON EMPTY", "", None, "POLYGON ((x y, 1 2))", "POLYGON ((1 2))"]
    rows = spark.createDataFrame(list(enumerate(texts)), "n int, wkt string")
    got = {(r.n, r.ring, r.k): tuple(r)[3:] for r in spark.sql("SELECT n, e.* FROM (SELECT n, grain_edges(wkt) AS edges FROM {r}) LATERAL VIEW inline(edges) e", r=rows).collect()}
    at = {(r.n, r.ring, r.k): (r.x, r.y) for r in spark.sql("SELECT n, v.* FROM {r}, LATERAL grain_vertices(wkt) v", r=rows).collect()}
    assert got == {(n, ring, k): (*p, *at[n, ring, k + 1]) for (n, ring, k), p in at.items() if (n, ring, k + 1) in at}
    plan = catalog.outlines_by_sql(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and plan.count("Join") == 0


def test_views_of_a_run(spark, tmp_path):
    cfg = load_config(overlay={"output": {"format": "parquet"}})
    shape = schema.grains(cfg.measure.efd_order)
    row = {f.name: None for f in shape} | {"grain_uid": "a:1", "frame_id": "a", "ecd_um": 100.0}
    tables.write_table(spark.createDataFrame([tuple(row[f.name] for f in shape)], shape), f"{tmp_path}/grains", "parquet")
    sql.register(spark, cfg)
    assert sql.register_run(spark, str(tmp_path), cfg, "run_") == ["run_grains", "run_contours", "run_manifest", "run_errors"]
    got = spark.sql("SELECT g.grain_uid, grain_size_class(ecd_um) AS c, count(o.wkt) AS n FROM run_grains g LEFT JOIN run_contours o USING (frame_id, grain_uid) GROUP BY ALL").collect()
    assert [tuple(r) for r in got] == [("a:1", "62.5-125", 0)] and spark.sql("SELECT * FROM run_errors").count() == 0
