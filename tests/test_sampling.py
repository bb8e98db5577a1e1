"""Ranks, percentiles, strata and samples against plain versions."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from skiagram.operators import aggregate, ranks, sampling


@pytest.fixture(scope="module")
def grains(spark):
    rng = random.Random(4)
    rows = [(f"g{k:04d}", f"f{k % 7}", "hot" if k % 3 else f"s{k % 5}" if k % 11 else None, round(rng.expovariate(0.01), 0), rng.random(), k % 10 == 0, k % 4 != 0) for k in range(400)]
    rows[5] = (*rows[5][:3], float("nan"), *rows[5][4:])
    rows[6] = (*rows[6][:3], None, *rows[6][4:])
    return spark.createDataFrame(rows, "grain_uid string, frame_id string, sample_id string, ecd_um double, contrast double, flag_border boolean, qc_pass boolean").repartition(5)


@pytest.mark.parametrize("by", [[], ["sample_id"]])
def test_places_do_not_depend_on_the_way(grains, by):
    got = [{r.grain_uid: r.place for r in ranks.placed(grains, by, ["ecd_um", "grain_uid"], small=small).collect()} for small in (True, False)]
    assert got[0] == got[1] and len(got[0]) == 400
    if not by:
        assert sorted(got[0].values()) == list(range(400))


@pytest.mark.parametrize("by", [[], ["sample_id"]])
def test_percentiles_do_not_depend_on_the_way(grains, by):
    some = grains.filter(~F.isnan("ecd_um"))
    got = [{tuple(r[c] for c in by): r.p for r in ranks.percentiles(some.dropna(subset=by), by, "ecd_um", [0.1, 0.5, 0.9, 1.0], small).collect()} for small in (True, False)]
    assert got[0].keys() == got[1].keys() and all(np.allclose(got[0][k], got[1][k]) for k in got[0])
    assert ranks.percentiles(some.limit(0), [], "ecd_um", [0.5], False).collect() == ranks.percentiles(some.limit(0), [], "ecd_um", [0.5], True).collect()


@pytest.mark.parametrize("small", [True, False])
def test_null_keys_are_a_group(grains, small):
    some = grains.filter("ecd_um is not null and not isnan(ecd_um)")
    rows = some.collect()
    n = len([r for r in rows if r.sample_id is None])
    assert n > 5
    got = {r.grain_uid: r["rank"] for r in sampling.quantile_ranked(some, "ecd_um", "grain_uid", "sample_id", small=small).collect()}
    assert len(got) == len(rows)
    own = sorted((r.ecd_um, r.grain_uid) for r in rows if r.sample_id is None)
    assert [got[u] for _, u in own] == [(k + 0.5) / n for k in range(n)]
    parts = {r.sample_id: r.p for r in ranks.percentiles(some, ["sample_id"], "ecd_um", [0.5], small).collect()}
    assert parts[None] == [np.percentile([x for x, _ in own], 50)] and len(parts) == len({r.sample_id for r in rows})
    assert sorted(r.place for r in ranks.placed(some, ["sample_id"], ["ecd_um", "grain_uid"], small=small).collect() if r.sample_id is None) == list(range(n))


@pytest.mark.parametrize("n", [1, 2, 5, 10, 199, 201, 999, 40_000])
def test_selected_percentiles_are_exact(spark, n):
    shares = [0.0, 0.1, 1 / 3, 0.5, 0.9, 0.999, 1.0]
    values = {"even": F.col("id") * 0.5, "tied": F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.pmod(F.hash("id"), F.lit(5)).cast("double")), "steep": F.exp(F.pmod(F.hash("id"), F.lit(600)) - 300.0), "alike": F.lit(-2.5)}
    rows = spark.range(n).select(F.explode(F.create_map(*[c for k, v in values.items() for c in (F.lit(k), v)])).alias("kind", "x")).repartition(3)
    got = {r.kind: r.p for r in ranks.percentiles(rows, ["kind"], "x", shares, False).collect()}
    pdf = rows.toPandas()
    assert set(got) == set(values)
    for kind, own in pdf.groupby("kind"):
        assert np.allclose(got[kind], np.percentile(own["x"], [100 * q for q in shares]), rtol=1e-12, atol=0), kind
    if n == 40_000:
        monotone = ranks.selected(rows, ["kind"], "x", [0.5])
        assert monotone._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2


def test_groups_beyond_a_broadcast_are_joined(grains, monkeypatch):
    some = grains.filter("ecd_um is not null and not isnan(ecd_um)")
    want = sorted(map(str, ranks.percentiles(some, ["sample_id"], "ecd_um", [0.1, 0.9], False).collect()))
    monkeypatch.setattr(ranks, "MOST_GROUPS", 2)
    assert sorted(map(str, ranks.percentiles(some, ["sample_id"], "ecd_um", [0.1, 0.9], False).collect())) == want


def test_levels_are_the_three_tables_in_one_pass(grains):
    rows = grains.withColumn("camera", F.lit("basic")).withColumn("flag_x", F.lit(True)).withColumn("frame_id", F.when(F.col("frame_id") != "f3", F.col("frame_id")))
    key = lambda df: sorted(str(sorted((c, round(v, 9) if isinstance(v, float) else v) for c, v in r.asDict().items())) for r in df.collect())
    made = aggregate.of_levels(aggregate.levels(rows))
    for name, plain in (("summary", aggregate.summary(rows, True)), ("per_frame", aggregate.per_frame(rows)), ("rejection_by_ecd", aggregate.rejection_by_ecd(rows))):
        assert key(made[name]) == key(plain), name
    assert key(aggregate.aggregated(rows)["summary"]) == key(made["summary"])
    plan = aggregate.levels(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_points_take_rows_as_if_in_turn():
    rng = random.Random(3)
    for _ in range(300):
        n, k = rng.randint(1, 12), rng.randint(0, 12)
        near = [rng.sample([f"r{x}" for x in range(n)], n) for _ in range(k)]
        taken = []
        for own in near:
            taken += [u for u in own if u not in taken][:1]
        match = sampling.Matching(k)
        match.near = [own[:1] for own in near]
        stuck = match.ask(rng.sample(range(k), k))
        while more := [i for i in stuck if len(match.near[i]) < n]:
            for i in more:
                match.near[i] = near[i][: 2 * len(match.near[i])]
            stuck = match.ask(more)
        assert sorted(match.holder) == sorted(taken)


def test_summary_of_large_tables(grains):
    rows = grains.withColumn("camera", F.lit("basic")).withColumn("flag_x", F.lit(True))
    a, b = (sorted(str(tuple(round(x, 9) if isinstance(x, float) else x for x in r)) for r in aggregate.summary(rows, small).collect()) for small in (True, False))
    assert a == b and len(a) == 6
    assert aggregate.summary(rows, False).columns == aggregate.summary(rows, True).columns


def test_hypercube_takes_the_nearest_of_all_rows(grains):
    pdf = grains.filter("ecd_um is not null and not isnan(ecd_um)").toPandas()
    axes, k = ["ecd_um", "contrast"], 12
    at = np.stack([(np.lexsort((pdf["grain_uid"], pdf[x])).argsort() + 0.5) / len(pdf) for x in axes], 1)
    left, want = set(range(len(pdf))), set()
    for point in sampling.hypercube_points(k, 2, 3):
        best = min(left, key=lambda i: (((at[i] - point) ** 2).sum(), pdf["grain_uid"][i]))  # noqa: B023
        left.discard(best)
        want.add(pdf["grain_uid"][best])
    got = {r.grain_uid for r in sampling.hypercube_sample(grains, axes, k, 3).collect()}
    assert got == want and len(got) == k
    few = grains.filter("grain_uid < 'g0009'")
    assert sampling.hypercube_sample(few, axes, 30, 3).count() == few.filter("ecd_um is not null and not isnan(ecd_um)").count()  # more points than rows
    assert sampling.hypercube_sample(grains, axes, 0, 3).count() == 0


def test_hypercube_of_rows_that_crowd(spark):
    """Points ask far beyond the few rows that are fetched at first."""
    rows = spark.range(90).select(F.concat(F.lit("g"), F.lpad("id", 3, "0")).alias("grain_uid"), F.col("id").cast("double").alias("x"), (-F.col("id")).cast("double").alias("y"))
    got = [r.grain_uid for r in sampling.hypercube_sample(rows, ["x", "y"], 60, 1).collect()]
    at = [((k + 0.5) / 90, (89 - k + 0.5) / 90) for k in range(90)]
    left = set(range(90))
    for p in sampling.hypercube_points(60, 2, 1):
        left.discard(min(left, key=lambda i: (((np.array(at[i]) - p) ** 2).sum(), i)))  # noqa: B023
    assert sorted(got) == [f"g{i:03d}" for i in range(90) if i not in left]


def test_label_sample_reserves_and_counts(grains):
    got = sampling.label_sample(grains.withColumn("flag_no_polygon", F.lit(False)), ["ecd_um", "contrast"], {"border": 2, "no_polygon": 1}, 7, n=9).collect()
    assert len({r.grain_uid for r in got}) == 9 and sum(r.flag_border for r in got) >= 2
    assert sampling.label_sample(grains, ["ecd_um"], {}, 1).count() == 400
    pool = sampling.label_sample(grains, ["contrast"], {"border": 1}, 1, frac=0.1, n_frames=2)
    assert pool.select("frame_id").distinct().count() <= 2 and pool.count() == round(0.1 * grains.join(sampling.frame_pool(grains, 2, 1), "frame_id", "left_semi").count())
    assert sampling.label_sample(grains, ["contrast"], {}, 1, frac_frames=0.5).select("frame_id").distinct().count() == 4


def test_strata_and_pages(grains):
    some = grains.filter("not isnan(ecd_um) and ecd_um is not null")
    sizes = [r["count"] for r in sampling.strata(some, "ecd_um").groupBy("stratum").count().collect()]
    assert sum(sizes) == some.count() and len(sizes) == 5 and max(sizes) < 100
    few = sampling.stratified(some, "ecd_um", 50, "grain_uid")
    assert few.count() == 50 and few.columns == some.columns
    assert sampling.stratified(some, "ecd_um", 500, "grain_uid").count() == some.count()
    pages = sampling.paged(some, "grain_uid").collect()
    assert sorted(r.position for r in pages) == list(range(1, len(pages) + 1)) and all(r.page == (r.position - 1) // 24 + 1 for r in pages)


def test_tables_beyond_one_task_are_not_small(spark, monkeypatch):
    """A window over six groups is six tasks; ten million rows are 80 MB by estimate and many times that in a sort."""
    large = spark.range(10_000_000)
    assert not ranks.is_small(large) and ranks.is_small(spark.range(1000))
    assert ranks.partitions(large) > ranks.partitions(spark.range(1000)) == 4
    monkeypatch.setattr(ranks, "SMALL", 0)
    rows = spark.range(500).select(F.concat(F.lit("g"), "id").alias("grain_uid"), F.lit(False).alias("qc_pass"), (F.col("id") % 2 == 0).alias("flag_a"), F.lit(True).alias("flag_b"))
    pages = sampling.rejected_pages(rows, ["flag_a", "flag_b"], 10)
    assert "Window" not in pages._jdf.queryExecution().executedPlan().toString()
    for flag, n in (("flag_a", 250), ("flag_b", 500)):
        own = sorted((r for r in pages.collect() if r.flag == flag), key=lambda r: r.grain_uid)
        assert [r.position for r in own] == list(range(1, n + 1)) and all(r.page == (r.position - 1) // 10 + 1 for r in own)


def test_hypercube_never_sorts_the_table(grains, monkeypatch):
    """Few marks, many ties: the same rows as by full ranks, and no task that takes rows by a window over all of them."""
    some = grains.filter("ecd_um is not null and not isnan(ecd_um)").withColumn("tied", F.floor(F.col("contrast") * 3).cast("double"))
    pdf = some.toPandas()
    axes, k = ["ecd_um", "tied"], 15
    at = np.stack([(np.lexsort((pdf["grain_uid"], pdf[x])).argsort() + 0.5) / len(pdf) for x in axes], 1)
    left, want = set(range(len(pdf))), set()
    for point in sampling.hypercube_points(k, 2, 5):
        best = min(left, key=lambda i: (((at[i] - point) ** 2).sum(), pdf["grain_uid"][i]))  # noqa: B023
        left.discard(best)
        want.add(pdf["grain_uid"][best])
    monkeypatch.setattr(ranks, "placed", None)  # no ranks of all rows
    for marks in (1, 7, 64):
        monkeypatch.setattr(sampling, "MARKS", marks)
        assert {r.grain_uid for r in sampling.hypercube_sample(some, axes, k, 5).collect()} == want, marks


def test_summaries_of_large_tables_are_those_of_small_ones(grains):
    """By level and by frame; values aren't gathered in maps before the shuffle, and not once for each level."""
    rows = grains.withColumn("camera", F.lit("basic")).withColumn("flag_x", F.lit(True)).withColumn("frame_id", F.when(F.col("frame_id") != "f3", F.col("frame_id")))
    key = lambda df: sorted(str(sorted((c, round(v, 9) if isinstance(v, float) else v) for c, v in r.asDict().items())) for r in df.collect())
    assert key(aggregate.levels(rows, False)) == key(aggregate.levels(rows, True))
    assert aggregate.levels(rows, False).columns == aggregate.levels(rows, True).columns
    assert key(aggregate.per_frame(rows, False)) == key(aggregate.per_frame(rows, True))
    plan = aggregate.per_frame(rows, False)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("partial_percentile") :]  # plans read upwards: rows come together before they are gathered
    assert re.search(r"hashpartitioning\([^\n]*REPARTITION_BY_NUM", below)


@pytest.mark.parametrize("name", ["sheet_tiles", "stratified_pages", "quantile_ranks"])
def test_places_in_frames_need_no_table_of_their_own(spark, monkeypatch, name):
    """Frames are many and small: a window over them, which reads only the columns that are asked for, however large the table."""
    from skiagram.plans import catalog
    from skiagram.sources import tables

    monkeypatch.setattr(ranks, "SMALL", 0)
    monkeypatch.setattr(tables, "working_folder", None)
    assert "Window" in catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
