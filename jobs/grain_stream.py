"""Keeps gated particles and the summaries of their frames current while tables of measurements arrive.

    python -m jobs.grain_stream --measurements FOLDER --out FOLDER [--config jobs/grain_stream.yaml]

A file stream takes the files that its checkpoint doesn't know yet and ends.  Each batch is flagged and gated and written below
``grains``, in folders of sample, camera and batch; then the frame and sample summaries of the samples and cameras that it touches
are made from all their particles and put in place of the old ones.  Folders are replaced as a whole, so a batch that runs again
after a failure replaces its own rows, and a run without new files changes nothing.

Columns that aren't among the measurements are left out, rows without a sample or camera are kept but in no summary.
"""

from __future__ import annotations

import logging
import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from jobs import common
from skiagram.config import Config, load_config
from skiagram.functions import gate
from skiagram.operators import aggregate
from skiagram.plans import adapters
from skiagram.sources import tables

log = logging.getLogger("grain_stream")
SETTINGS = {"qc": {}, "files_a_batch": 1000}
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
KEYS = ["sample_id", "camera"]
KEPT = ["grain_uid", "frame_id", *KEYS, "label", "ecd_um", "feret_min_um", "ecd_px", "edge_width_px", "contrast", "qc_aspect_ratio", "qc_solidity", "touches_border", "has_polygon", "aspect_ratio", "solidity", "circularity", *gate.FLAGS, "qc_pass"]
SUMMARIES = {"per_frame": aggregate.per_frame, "summary": aggregate.summary}


def replaced(df: DataFrame, path: str, keys: list[str]) -> None:
    """Folders of the keys that the rows have are replaced, others stay.  A task has a few of them open at once, so that rows needn't be
    sorted by folder; one with more sorts the rest."""
    conf, was = df.sparkSession.conf, df.sparkSession.conf.get(WRITERS, None)
    conf.set(WRITERS, "8")
    try:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
    finally:
        conf.unset(WRITERS) if was is None else conf.set(WRITERS, was)


def stored(spark: SparkSession, path: str, shape: StructType) -> DataFrame:
    """A table with text keys, whatever their folders look like; empty where nothing has been written."""
    return spark.read.schema(shape).parquet(path) if tables.exists(spark, path) else spark.createDataFrame([], shape)


def shapes(rows: DataFrame, cfg: Config) -> dict[str, StructType]:
    grains = adapters.grains_of(rows, cfg).select(*KEPT)
    return {"grains": StructType(grains.schema.fields).add("batch", "long")} | {name: made(grains).schema for name, made in SUMMARIES.items()}


def take(rows: DataFrame, number: int, out: str, cfg: Config) -> dict[str, int]:
    """Stores one batch and renews the summaries that it touches."""
    spark, shape = rows.sparkSession, shapes(rows, cfg)
    seen = Observation("batch")
    grains = adapters.grains_of(rows, cfg).select(*KEPT)
    counted = grains.observe(seen, F.count(F.lit(1)).alias("n_read"), F.coalesce(F.count_if("qc_pass"), F.lit(0)).alias("n_accepted"))
    replaced(counted.withColumn("batch", F.lit(number).cast("long")), f"{out}/grains", [*KEYS, "batch"])
    store = stored(spark, f"{out}/grains", shape["grains"])
    touched = store.filter(F.col("batch") == number).select(*KEYS).distinct()  # folder names alone
    current = store.join(F.broadcast(touched), KEYS, "left_semi")
    for name, made in SUMMARIES.items():
        replaced(made(current), f"{out}/{name}", KEYS)
    log.info("batch %d: read %d measurements, wrote %d grains (%d accepted) to %s/grains, renewed %s of their samples", number, seen.get["n_read"], seen.get["n_read"], seen.get["n_accepted"], out, ", ".join(SUMMARIES))
    return seen.get


def arriving(spark: SparkSession, path: str, files_a_batch: int) -> DataFrame:
    """The files of a folder as a stream; of a table that is one file that file, as a stream's path must be a folder."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_a_batch)
    if tables.is_file(spark, path):
        folder, _, name = path.rpartition("/")
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def run(spark: SparkSession, measurements: str, out: str, told: dict | None = None) -> dict[str, int]:
    """Takes what is new in a folder of Parquet files (or is the one file of a table) and returns how much that was."""
    told = SETTINGS | (told or {})
    cfg = load_config(overlay={"qc": told["qc"]})
    total = {"n_batches": 0, "n_read": 0, "n_accepted": 0}

    def batch(rows: DataFrame, number: int) -> None:
        got = take(rows, number, out, cfg)
        total["n_batches"] += 1
        for k in ("n_read", "n_accepted"):
            total[k] += got[k]

    started = arriving(spark, measurements, told["files_a_batch"]).writeStream.foreachBatch(batch).option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start()
    started.awaitTermination()  # raises what the stream has raised
    log.info("%s: %d new measurements in %d batches, %d accepted", measurements, total["n_read"], total["n_batches"], total["n_accepted"])
    return total


def output(spark: SparkSession, measurements: str, out: str, name: str = "per_frame") -> DataFrame:
    """A table that the job keeps: grains, per_frame or summary."""
    return stored(spark, f"{out}/{name}", shapes(spark.read.parquet(measurements), Config())[name])


if __name__ == "__main__":
    raise SystemExit(common.command_line(__doc__, {"measurements": "folder of Parquet files"}, os.path.join(os.path.dirname(__file__), "grain_stream.yaml"), SETTINGS, run, None))
