"""Frames under a root as a table of path, size and time, and their bytes in a worker."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skiagram.functions.identity import fingerprint, parsed, with_blanks
from skiagram.sources.images import SUFFIXES, decode

LISTING = "frame_path string, size long, mtime double"


def is_uri(path: str) -> bool:
    return "://" in path


def listing(spark: SparkSession, root: str) -> DataFrame:
    """Image files under a root.  A local root is walked, its folders by tasks, so that names with a leading underscore count;
    only a file's own leading dot hides it.  A URI is listed by Spark in parallel, contents unread; Spark hides names with an underscore."""
    if is_uri(root):
        glob = "*.{" + ",".join(s for x in SUFFIXES for s in (x, x.upper())) + "}"
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
        return of_files(files)
    top = [(e.path, e.is_dir()) for e in os.scandir(root)] if os.path.isdir(root) else []
    here = spark.createDataFrame([seen(p) for p, folder in top if not folder and is_frame(p)], LISTING)
    folders = [(p,) for p, folder in top if folder]
    if not folders:
        return here

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for root in b.column(0).to_pylist():
                for folder, _, names in os.walk(root):
                    rows = [seen(os.path.join(folder, n)) for n in names if is_frame(n)]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["frame_path", "size", "mtime"])

    # a task for each of a number of top folders: they are on a path that all workers share
    n = min(len(folders), 4 * spark.sparkContext.defaultParallelism)
    return here.unionByName(spark.createDataFrame(folders, "folder string").repartition(n).mapInArrow(walk, LISTING))


def is_frame(path: str) -> bool:
    name = os.path.basename(path)
    return not name.startswith(".") and name.rpartition(".")[2].lower() in SUFFIXES


def seen(path: str) -> tuple[str, int, float]:
    stat = os.stat(path)
    return path, stat.st_size, stat.st_mtime


def in_path_order(files: DataFrame) -> DataFrame:
    return files.orderBy("frame_path")


def of_files(files: DataFrame) -> DataFrame:
    """The listing's columns from binaryFile rows, batch or stream; the content column isn't read."""
    return files.select(F.col("path").alias("frame_path"), F.col("length").alias("size"), F.col("modificationTime").cast("double").alias("mtime"))


def discovered(files: DataFrame, cfg, *, sample_id: str | None = None, camera: str | None = None) -> DataFrame:
    """Data frames with identity, fingerprint and blank."""
    named = parsed(files, cfg, sample_id=sample_id, camera=camera).withColumn("frame_id", F.col("stem"))
    return with_blanks(named.withColumn("fingerprint", fingerprint(F.col("size"), F.col("mtime"))))


def read_bytes(path: str) -> bytes:
    if is_uri(path) or path.startswith("file:"):
        from pyarrow import fs

        path = "file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path
        system, inner = fs.FileSystem.from_uri(path)
        with system.open_input_stream(inner) as f:
            return f.read()
    with open(path, "rb") as f:
        return f.read()


def read_image(path: str) -> np.ndarray:
    return decode(read_bytes(path))


@lru_cache(maxsize=4)
def read_blank(path: str) -> np.ndarray:
    """Blanks are shared by many frames; a worker keeps the last four."""
    return read_image(path)
