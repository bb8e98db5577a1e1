"""The Spark session this engine expects; a cluster sets sizes of its own."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # frame and sample ids such as 001 must stay text
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # tables in buckets of frame_id are joined on (frame_id, grain_uid) where they lie; frames are many and small, so that is even
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # feather tables take filters themselves
    "spark.sql.python.filterPushdown.enabled": "true",
    # workers are the parallel part, not the libraries in them
    "spark.executorEnv.OMP_NUM_THREADS": "1",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName("skiagram")
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | more).getOrCreate()
