"""Jobs on copies of the tables: growing input, repeated runs and batches, command lines, and the queries against their SQL."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

from jobs import grain_stream, queries, review_queue
from jobs.common import settings
from skiagram.config import Config
from skiagram.operators import aggregate
from skiagram.plans import adapters
from skiagram.plans.catalog import rounded

SF, ROOT = "/root/testdata/sf0.001", os.path.dirname(os.path.dirname(__file__))


def rows(df):
    df = rounded(df, 8)  # sums of doubles depend on the order of rows
    return sorted(str(tuple(r[c] for c in sorted(df.columns))) for r in df.collect())


def fresh(spark, lines, made):
    return rows(made(adapters.grains_of(lines, Config())))


@pytest.fixture()
def arriving(spark, tmp_path):
    """A folder that gets a third of lineitem at each call."""
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    folder, aside = tmp_path / "lineitem", tmp_path / "aside"
    folder.mkdir()

    def more(k):
        part = lines.filter(F.pmod(F.hash("l_orderkey"), F.lit(3)) == k)
        part.coalesce(1).write.mode("overwrite").parquet(str(aside))
        name = next(f for f in os.listdir(aside) if f.endswith(".parquet"))
        shutil.copy(aside / name, folder / f"part-{k}.parquet")
        return spark.read.parquet(str(folder))

    return str(folder), more


def test_stream_over_growing_input(spark, arriving, tmp_path):
    folder, more = arriving
    out = str(tmp_path / "out")
    seen = 0
    for k in range(3):
        lines = more(k)
        took = grain_stream.run(spark, folder, out, {"files_a_batch": 1})
        assert took["n_read"] == lines.count() - seen and took["n_batches"] == 1  # only what is new
        seen = lines.count()
        for name, made in grain_stream.SUMMARIES.items():
            assert rows(grain_stream.output(spark, folder, out, name)) == fresh(spark, lines, made)
        assert grain_stream.output(spark, folder, out, "grains").count() == seen
    before = rows(grain_stream.output(spark, folder, out))
    assert grain_stream.run(spark, folder, out)["n_read"] == 0
    assert rows(grain_stream.output(spark, folder, out)) == before
    assert {f for f in os.listdir(f"{out}/per_frame") if "=" in f} == {f"sample_id=P_{x}" for x in "ANR"}


def test_batch_that_failed_midway_replaces_its_rows(spark, arriving, tmp_path, monkeypatch):
    folder, more = arriving
    out = str(tmp_path / "out")
    more(0)
    grain_stream.run(spark, folder, out)
    lines = more(1)

    def lost(df, path, keys, real=grain_stream.replaced):
        if path.endswith("summary"):
            raise RuntimeError("driver lost")
        real(df, path, keys)

    with monkeypatch.context() as m:
        m.setattr(grain_stream, "replaced", lost)
        with pytest.raises(Exception, match="driver lost"):
            grain_stream.run(spark, folder, out)
    assert grain_stream.output(spark, folder, out, "grains").count() == lines.count()
    assert grain_stream.run(spark, folder, out)["n_batches"] == 1
    assert grain_stream.output(spark, folder, out, "grains").count() == lines.count()
    for name, made in grain_stream.SUMMARIES.items():
        assert rows(grain_stream.output(spark, folder, out, name)) == fresh(spark, lines, made)


def test_untouched_samples_are_not_written_again(spark, tmp_path):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    lines.filter("l_returnflag = 'A'").coalesce(1).write.parquet(folder)
    grain_stream.run(spark, folder, out)
    at = lambda flag: sorted(os.listdir(f"{out}/per_frame/sample_id=P_{flag}/camera=zoom"))
    was = at("A")
    lines.filter("l_returnflag = 'R'").coalesce(1).write.mode("append").parquet(folder)
    assert grain_stream.run(spark, folder, out)["n_batches"] == 1
    assert at("A") == was and at("R")
    assert rows(grain_stream.output(spark, folder, out)) == fresh(spark, spark.read.parquet(folder), aggregate.per_frame)


def test_stream_of_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/lineitem.parquet").limit(0).write.parquet(str(tmp_path / "in"))
    grain_stream.run(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert grain_stream.output(spark, str(tmp_path / "in"), str(tmp_path / "out")).count() == 0


def test_review_queue_of_hand_made_records(spark, tmp_path):
    docs = [(1, "a long enough text " * 3, "en", "s"), (2, "a long enough text " * 3, "en", "s"), (3, None, "en", "s"), (4, " \n", "en", "s"), (5, "short", "de", "t"), (6, "x" * 30_000, "de", None), (None, "a long enough text " * 3, "en", "s"), (None, "another text, of a row that has no id at all", None, "s")]
    d, m, out = (str(tmp_path / n) for n in ("docs", "labels", "out"))
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(d)
    spark.createDataFrame([(1, 1, 0), (1, 0, 0), (6, None, 1), (5, 0, 0), (99, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(m)
    first = review_queue.run(spark, d, m, out, {"strata": 2})
    assert first == {"n_read": 8, "n_accepted": 3, "n_queued": 3}
    got = {r.doc_id: r.asDict() for r in review_queue.output(spark, out).collect()}
    assert set(got) == {1, 6, None}
    assert (got[1]["quality"], got[1]["is_labelled"], got[1]["flags"], got[1]["page"]) == (1, True, "", 1)
    assert (got[6]["is_labelled"], got[6]["flags"], got[6]["source"]) == (False, "flag_long", None)
    assert rows(spark.read.parquet(f"{out}/agreement")) == sorted(map(str, [("quality 1", 1, True), ("quality 0", 1, False)]))
    counts = {r.source: (r.n_flag_empty, r.n_flag_short, r.n_flag_repeated) for r in spark.read.parquet(f"{out}/flags").collect()}
    assert counts == {"s": (2, 2, 2), "t": (0, 1, 0), None: (0, 0, 0)}
    before = rows(review_queue.output(spark, out))
    assert review_queue.run(spark, d, m, out, {"strata": 2}) == first and rows(review_queue.output(spark, out)) == before
    spark.createDataFrame([(7, "a new record, of a length like that of others", "en", "s")], "doc_id long, text string, lang string, source string").write.mode("append").parquet(d)
    assert review_queue.run(spark, d, m, out)["n_queued"] == 4
    spark.read.parquet(d).limit(0).write.parquet(f"{d}0")
    assert review_queue.run(spark, f"{d}0", m, out) == {"n_read": 0, "n_accepted": 0, "n_queued": 0}


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    was = sorted(spark.sql("set").collect())
    ours, theirs = queries.QUERIES[name](spark, SF), con.sql(queries.SQL[name])
    cols = sorted(ours.columns)
    assert cols == sorted(theirs.columns)
    assert rows(ours) == sorted(str(tuple(r[theirs.columns.index(c)] for c in cols)) for r in theirs.fetchall())
    assert sorted(spark.sql("set").collect()) == was


def test_settings(spark, tmp_path):
    (tmp_path / "a.yaml").write_text("page: 3\n")
    assert settings(spark, str(tmp_path / "a.yaml"), review_queue.SETTINGS)["page"] == 3
    (tmp_path / "b.yaml").write_text("pages: 3\n")
    with pytest.raises(ValueError, match="pages"):
        settings(spark, str(tmp_path / "b.yaml"), review_queue.SETTINGS)
    for job, known in (("grain_stream", grain_stream.SETTINGS), ("review_queue", review_queue.SETTINGS)):
        assert settings(spark, f"{ROOT}/jobs/{job}.yaml", known)


@pytest.mark.parametrize(("job", "inputs"), [("grain_stream", ["--measurements", f"{SF}/lineitem.parquet"]), ("review_queue", ["--documents", f"{SF}/documents.parquet", "--labels", f"{SF}/labels.parquet"])])
def test_command_lines(spark, tmp_path, job, inputs):
    out = str(tmp_path / "out")
    done = subprocess.run([sys.executable, "-m", f"jobs.{job}", *inputs, "--out", out, "--master", "local[2]"], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert " read " in done.stderr and "wrote " in done.stderr
    assert os.path.isdir(f"{out}/{'per_frame' if job == 'grain_stream' else 'queue'}")


def test_a_task_writes_its_folders_without_a_sort(spark, tmp_path):
    """Rows of a few folders aren't sorted, which large tables spill; the session's setting is as before."""
    df = spark.range(200).selectExpr("id", "cast(id % 5 as string) as k")
    seen = []
    write = type(df).write.fget
    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(df), "write", property(lambda self: seen.append(spark.conf.get(grain_stream.WRITERS)) or write(self)))
        grain_stream.replaced(df, str(tmp_path / "t"), ["k"])
    assert seen == ["8"] and spark.conf.get(grain_stream.WRITERS) == "0"
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "t")).collect()) == list(range(200))
