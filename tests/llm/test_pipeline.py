"""The pipeline's order, its working tables, and awkward input through all stages."""

import os
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from skiagram.llm import mixing

pytest.importorskip("public_tokenizers")
import corpus_pipeline as pipeline  # noqa: E402

DOCUMENTS, LABELS = "doc_id long, text string, lang string, source string, n_chars long", "doc_id long, toxic int, quality int"


def put(spark, folder, n=40, seed=1, more=()):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(2, 7)))
    rows = [(k, " ".join(word() for _ in range(rng.randint(30, 60))), "en", "s" if k % 3 else "t", 1) for k in range(n)] + list(more)
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, int(k % 9 == 0), 1) for k in range(n)], LABELS).write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def stages(spark, folder, out, upto=len(pipeline.STAGES)):
    """As a caller does who writes each stage."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, f) in enumerate(pipeline.STAGES[:upto]):
        f(spark, docs, folder).write.parquet(f"{out}/{k}")
        docs = spark.read.parquet(f"{out}/{k}")
    return docs


def working(spark):
    base = spark.conf.get("spark.checkpoint.dir").removeprefix("file://")
    return {f for f in os.listdir(base) if f.startswith("skiagram-")}


def test_rows_come_in_the_order_of_the_mixture(spark, tmp_path):
    folder = put(spark, tmp_path)
    before = stages(spark, folder, tmp_path / "out", 3)
    want = [r.doc_id for r in mixing.mixed(before).orderBy("mix_order").collect()]
    last = stages(spark, folder, tmp_path / "all")
    assert [r.doc_id for r in last.orderBy("mix_order").collect()] == want
    files = sorted(f for f in os.listdir(tmp_path / "all" / "4") if f.endswith(".parquet"))
    assert [r.doc_id for f in files for r in spark.read.parquet(f"{tmp_path}/all/4/{f}").collect()] == want  # and lie in it
    assert [r.doc_id for r in pipeline.run(spark, folder).orderBy("mix_order").collect()] == want
    assert sorted(want) != want


def test_working_tables_stay_as_long_as_they_are_needed(spark, tmp_path):
    folder = put(spark, tmp_path)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    one, two = pipeline.drop_near_copies(spark, docs, folder), pipeline.cut_repeats(spark, docs, folder)  # of one table, read afterwards
    assert one.count() == two.count() == docs.count()
    lazily = docs
    for _, f in pipeline.STAGES:  # nothing written in between
        lazily = f(spark, lazily, folder)
    written = stages(spark, folder, tmp_path / "out")
    assert sorted(r.decoded_sha256 for r in lazily.collect()) == sorted(r.decoded_sha256 for r in written.collect())
    was = working(spark)
    pipeline.run(spark, folder)
    assert len(working(spark) - was) == 1  # the result


def test_a_stage_deletes_what_is_written(spark, tmp_path):
    folder = put(spark, tmp_path)
    stages(spark, folder, tmp_path / "a", 1)
    was = working(spark)
    docs = stages(spark, folder, tmp_path / "b", 2)
    made = working(spark) - was
    spark.read.parquet(f"{folder}/documents.parquet").write.parquet(f"{tmp_path}/other")
    pipeline.cut_repeats(spark, spark.read.parquet(f"{tmp_path}/other"), folder)  # a table of its own
    assert made and made <= working(spark)
    pipeline.cut_repeats(spark, docs, folder)
    assert not made & working(spark)


def test_two_runs_at_once(spark, tmp_path):
    a, b = put(spark, tmp_path / "a", seed=1), put(spark, tmp_path / "b", seed=2)
    alone = [sorted(r.ids_sha256 for r in pipeline.run(spark, d).collect()) for d in (a, b)]
    with ThreadPoolExecutor(2) as pool:
        both = [sorted(r.ids_sha256 for r in df.collect()) for df in pool.map(lambda d: pipeline.run(spark, d), (a, b))]
    assert both == alone


def test_empty_tables_and_clashing_columns(spark, tmp_path):
    folder = put(spark, tmp_path, more=[(None, None, None, None, None), (50, "", "en", None, 0), (51, "x " * 900, "en", "s", 1), (51, "x " * 900, "en", "s", 1)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = ("mix_order", "_order", "_rank", "score", "component_id", "n_bytes", "label", "_metadata", "ids")
    odd = tmp_path / "odd"
    docs.withColumns({n: F.lit(n) for n in names}).write.parquet(f"{odd}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{odd}/labels.parquet")
    key = lambda df: sorted((str(r.doc_id), r.ids_sha256) for r in df.collect())
    assert key(pipeline.run(spark, str(odd))) == key(pipeline.run(spark, folder))
    mixed = stages(spark, str(odd), tmp_path / "odd_out", 4)
    assert set(names) <= set(mixed.columns) and {r.mix_order for r in mixed.collect()} == {"mix_order"}
    none = tmp_path / "none"
    docs.limit(0).write.parquet(f"{none}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{none}/labels.parquet")
    assert pipeline.run(spark, str(none)).count() == 0
    unlabelled = tmp_path / "unlabelled"
    docs.write.parquet(f"{unlabelled}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").limit(0).write.parquet(f"{unlabelled}/labels.parquet")
    assert pipeline.run(spark, str(unlabelled)).filter("doc_id is null").count() == 1
