"""Detection on a stream of arriving frames: each batch goes through the same job, so its fingerprints and upserts hold.

Frames and blanks arrive in any order.  The state of a sample, run and camera holds the blank that it has so far and the frames that
have come without one.  Such a frame is measured at once, by the morphological flat-field, and comes again as soon as a blank arrives,
so after every batch the tables are those of a batch run over what has arrived.  State is kept for as long as a blank may be late.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from skiagram.config import Config
from skiagram.functions.identity import parsed
from skiagram.plans import jobs
from skiagram.sources import arrivals

KEYS = ["sample_id", "run", "camera"]
FILE = ["frame_path", "size", "mtime"]
STORE, ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: How late a blank may be.
LATE = datetime.timedelta(days=2)
PAIRED = "frame_path string, size long, mtime double, blank_path string, again boolean"


class BlankPairing(StatefulProcessor):
    """Frames of one sample, run and camera with their blank, if it is there; those that had none again when it comes."""

    def __init__(self, late_ms: int) -> None:
        self.late_ms = late_ms

    def init(self, handle) -> None:
        self.blank = handle.getValueState("blank", "frame_path string")
        self.open = handle.getListState("open", "frame_path string, size long, mtime double", self.late_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        paths = new.loc[new.is_blank, "frame_path"].tolist()
        known = self.blank.get() if self.blank.exists() else None
        best = max([*paths, *([known[0]] if known else [])], key=lambda p: p.split("/"), default=None)  # the last path, as in a batch
        if best is not None and (known is None or known[0] != best):
            self.blank.update((best,))
        frames = new.loc[~new.is_blank, FILE].assign(again=False)
        if self.open.exists():
            held = pd.DataFrame(list(self.open.get()), columns=FILE).assign(again=True)
            frames = pd.concat([held[~held.frame_path.isin(frames.frame_path)], frames], ignore_index=True)  # a changed file replaces itself
        if best is None:
            self.open.put([(p, int(s), float(m)) for p, s, m in frames[FILE].itertuples(index=False)])
            frames = frames[~frames.again]
        elif self.open.exists():
            self.open.clear()
        if len(frames):
            yield frames.assign(blank_path=best)[[*FILE, "blank_path", "again"]].astype({"size": "int64", "mtime": "float64", "again": "bool"})

    def close(self) -> None:
        """Nothing is open beside the state."""


def paired(files: DataFrame, cfg: Config, late: datetime.timedelta = LATE) -> DataFrame:
    """Arriving files as data frames with their blank, as ``PAIRED``; the session's state store must be RocksDB."""
    named = parsed(files, cfg).select(*FILE, "sample_id", F.coalesce("run", F.lit("")).alias("run"), "camera", "is_blank")
    processor = BlankPairing(int(late.total_seconds() * 1000))
    return named.groupBy(*KEYS).transformWithStateInPandas(processor, PAIRED, "Append", "ProcessingTime")


def detect_stream(spark: SparkSession, root: str, out: str, cfg: Config, checkpoint: str, *, available_now: bool = True, settle: float = arrivals.SETTLE, late: datetime.timedelta = LATE) -> StreamingQuery:
    """Starts detection of what arrives under a root."""

    def batch(rows: DataFrame, number: int) -> None:
        rows = rows.persist()  # paths; the state has moved on when they are read again
        try:
            if rows.isEmpty():
                return
            blanks = rows.filter("blank_path is not null").select(F.col("blank_path").alias("frame_path"), F.lit(0).cast("long").alias("size"), F.lit(0.0).alias("mtime")).distinct()
            again = rows.filter("again").select("frame_path")
            jobs.run_detect(rows.sparkSession, root, out, cfg, files=rows.select(*FILE).unionByName(blanks), again=again)
        finally:
            rows.unpersist()

    was = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        writer = paired(arrivals.stream(spark, root, settle), cfg, late).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
    finally:  # the query has its own copy of the settings
        spark.conf.set(STORE, was) if was is not None else spark.conf.unset(STORE)
