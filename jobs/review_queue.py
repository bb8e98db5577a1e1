"""A queue for hand review of text records: gated, cut into strata of length, paged within each source, with what is labelled marked.

    python -m jobs.review_queue --documents TABLE --labels TABLE --out FOLDER [--config jobs/review_queue.yaml]

As for particles, a record has flags, of which the disqualifying ones keep it out of the queue; the rest is cut at quantiles of its
length, so that reviewers see short and long records alike, and put on pages in the order of its id.  ``queue`` lies in folders of
the source, ``agreement`` counts labels by verdict and ``flags`` the flags by source.  A run replaces the three tables; the same
input gives the same rows.

Null and empty texts are flagged as empty.  Of equal texts all but the one with the smallest id are flagged as repeated; rows without
an id are never the first.  Rows of a record that share an id are rows of their own; several labels of an id count as the highest.
"""

from __future__ import annotations

import logging
import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobs import common
from skiagram.config import Qc
from skiagram.functions import gate
from skiagram.operators import aggregate, review, sampling

log = logging.getLogger("review_queue")
SETTINGS = {"least_chars": 40, "most_chars": 20000, "strata": 5, "page": 24, "disqualifying_flags": ["flag_empty", "flag_short", "flag_repeated"]}
FLAGS = ("flag_empty", "flag_short", "flag_long", "flag_repeated")
QUEUE = "doc_id bigint, lang string, n_chars bigint, flags string, stratum int, position int, page int, quality int, is_labelled boolean, source string"


def replaced(df: DataFrame, path: str) -> None:
    """The whole table is replaced, with the folders of sources that have no rows any more, whatever the session does by default."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("source").parquet(path)


def flagged(docs: DataFrame, told: dict) -> DataFrame:
    """Records with their length, flags and gate.  Equal texts are found by a digest, counted before they are shuffled."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", "source", "lang", F.length(text).cast("long").alias("n_chars"), F.sha2(text, 256).alias("print"), (~text.rlike(r"[^\x20\x09-\x0D]")).alias("flag_empty"))
    first = rows.filter("not flag_empty and doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("first_id"))
    rows = rows.join(first, "print", "left").drop("print")
    rows = rows.withColumns(
        {
            "flag_short": F.col("n_chars") < told["least_chars"],
            "flag_long": F.col("n_chars") > told["most_chars"],
            "flag_repeated": F.coalesce(F.col("doc_id") > F.col("first_id"), F.col("doc_id").isNull() & F.col("first_id").isNotNull()),
        }
    )
    return gate.regated(rows.drop("first_id"), Qc(disqualifying_flags=told["disqualifying_flags"]))


def run(spark: SparkSession, documents: str, labels: str, out: str, told: dict | None = None) -> dict[str, int]:
    """Writes queue, agreement and flags and returns what was read and written."""
    told = SETTINGS | (told or {})
    read, wrote = Observation("read"), Observation("wrote")
    # the gated rows are small beside the texts and read three times: written once, texts are scanned once
    gated = flagged(spark.read.parquet(documents), told).observe(read, F.count(F.lit(1)).alias("n"), F.coalesce(F.count_if("qc_pass"), F.lit(0)).alias("n_accepted"))
    replaced(gated, f"{out}/gated")
    gated = spark.read.schema(gated.schema).parquet(f"{out}/gated")
    marks = spark.read.parquet(labels).filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))

    cut = sampling.strata(aggregate.accepted(gated), "n_chars", told["strata"]).withColumn("flags", gate.active_flags(FLAGS))
    paged = sampling.paged(cut.select("doc_id", "source", "lang", "n_chars", "flags", "stratum"), "doc_id", "source", "stratum", size=told["page"])
    queue = paged.join(marks, "doc_id", "left").withColumn("is_labelled", F.col("quality").isNotNull()).observe(wrote, F.count(F.lit(1)).alias("n"))
    replaced(queue, f"{out}/queue")

    by_id = gated.filter("doc_id is not null").select(F.col("doc_id").alias("grain_uid"), "qc_pass")
    named = marks.select(F.col("doc_id").alias("grain_uid"), F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("label_name"))
    review.label_scores(named, by_id).write.mode("overwrite").parquet(f"{out}/agreement")
    counted = gated.groupBy("source").agg(*[F.count_if(f).alias(f"n_{f}") for f in FLAGS])
    counted.write.mode("overwrite").parquet(f"{out}/flags")
    log.info("read %d records of %s and the labels of %s, %d accepted", read.get["n"], documents, labels, read.get["n_accepted"])
    log.info("wrote %d rows to %s/queue, and %s/agreement and %s/flags", wrote.get["n"], out, out, out)
    return {"n_read": read.get["n"], "n_accepted": read.get["n_accepted"], "n_queued": wrote.get["n"]}


def output(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(QUEUE).parquet(f"{out}/queue")


if __name__ == "__main__":
    raise SystemExit(common.command_line(__doc__, {"documents": "Parquet table", "labels": "Parquet table"}, os.path.join(os.path.dirname(__file__), "review_queue.yaml"), SETTINGS, run, None))
