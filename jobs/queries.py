"""The jobs as queries: each runs twice over the whole tables into one new folder, and its output is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobs import grain_stream, review_queue
from skiagram.plans.catalog import COUNTS, FLAG_COUNTS, PCT, SHAPES, G, rounded
from skiagram.sources import tables


def job1_grain_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, measurements = f"{tables.shared_folder(spark)}/grain_stream", f"{sf_dir}/lineitem.parquet"
    for _ in range(2):
        grain_stream.run(spark, measurements, out)
    return rounded(grain_stream.output(spark, measurements, out), 8)


def job2_review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{tables.shared_folder(spark)}/review_queue"
    for _ in range(2):
        review_queue.run(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/labels.parquet", out)
    return review_queue.output(spark, out)


QUERIES = {f.__name__: f for f in (job1_grain_stream, job2_review_queue)}

SQL = {
    "job1_grain_stream": f"WITH {G} SELECT sample_id, camera, frame_id, {COUNTS}, {FLAG_COUNTS}, {PCT}, {SHAPES} FROM grains GROUP BY ALL",
    "job2_review_queue": """
WITH d AS (SELECT doc_id, source, lang, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars, NOT regexp_matches(coalesce(text, ''), '[^\\x20\\x09-\\x0D]') AS flag_empty,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id FROM documents),
f AS (SELECT *, n_chars < 40 AS flag_short, n_chars > 20000 AS flag_long, NOT flag_empty AND coalesce(doc_id > first_id, doc_id IS NULL AND first_id IS NOT NULL) AS flag_repeated FROM d),
a AS (SELECT * FROM f WHERE NOT (flag_empty OR flag_short OR flag_repeated)),
e AS (SELECT list_distinct(quantile_cont(n_chars, [0.2, 0.4, 0.6, 0.8])) AS e FROM a),
s AS (SELECT a.*, CAST(len(list_filter(e, lambda x: x < n_chars)) AS INTEGER) AS stratum FROM a, e),
p AS (SELECT *, CAST(row_number() OVER (PARTITION BY source, stratum ORDER BY doc_id) AS INTEGER) AS position FROM s),
m AS (SELECT doc_id, CAST(max(quality) AS INTEGER) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id)
SELECT p.doc_id, lang, n_chars, CASE WHEN flag_long THEN 'flag_long' ELSE '' END AS flags, stratum, position, CAST((position - 1) // 24 + 1 AS INTEGER) AS page, quality, quality IS NOT NULL AS is_labelled, source
FROM p LEFT JOIN m ON p.doc_id = m.doc_id""",
}
