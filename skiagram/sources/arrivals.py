"""Frames as a stream: files under a root in the order in which they arrive, a changed one again.

Spark's file source never takes a path twice.  Here an offset is a time of arrival, so it stays small whatever has been seen: a batch
holds the files that arrived after one offset and not after the next.  Locally a file arrives when its inode changes, by being
written, replaced or moved there, even with an old time of modification; elsewhere when its object was last written.  A file that has
arrived less than ``settle`` seconds ago is left for the next batch, as another may still arrive at the same time.
"""

from __future__ import annotations

import os
import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from skiagram.sources.feather import located
from skiagram.sources.frames import LISTING, is_frame, is_uri

NAME, SETTLE, A_TASK = "skiagram_frames", 1.0, 10_000


def arrived(root: str) -> Iterator[tuple[int, str, int, float]]:
    """Arrival in nanoseconds, path, size and time of modification of the frames under a root."""
    if is_uri(root) and not root.startswith("file:"):
        from pyarrow import fs

        system, inner = located(root)
        head = root[: root.index("://") + 3] + root.split("://", 1)[1].removesuffix(inner.lstrip("/")).rstrip("/")
        for f in system.get_file_info(fs.FileSelector(inner, recursive=True, allow_not_found=True)):
            if f.type == fs.FileType.File and is_frame(f.path):
                yield f.mtime_ns, f"{head}/{f.path.lstrip('/')}", f.size, f.mtime_ns / 1e9
        return
    for folder, _, names in os.walk(located(root)[1]):
        for path in (os.path.join(folder, n) for n in names if is_frame(n)):
            try:
                s = os.stat(path)
            except FileNotFoundError:  # gone since it was listed
                continue
            yield s.st_ctime_ns, path, s.st_size, s.st_mtime


@dataclass
class Files(InputPartition):
    rows: list[tuple[str, int, float]] = field(default_factory=list)


class ArrivalReader(DataSourceStreamReader):
    def __init__(self, root: str, settle: float) -> None:
        self.root, self.settle, self.last = root, settle, 0

    def initialOffset(self) -> dict:
        return {"until": 0}

    def latestOffset(self) -> dict:
        """Never goes back, whatever files go."""
        settled = time.time_ns() - int(self.settle * 1e9)
        self.last = max([self.last, *(at for at, *_ in arrived(self.root) if at <= settled)])
        return {"until": self.last}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        """Files that have changed since the batch was first planned aren't in it any more; they are in a later one."""
        self.last = max(self.last, end["until"])
        rows = sorted(row for at, *row in arrived(self.root) if start["until"] < at <= end["until"])
        return [Files([tuple(r) for r in rows[k : k + A_TASK]]) for k in range(0, len(rows), A_TASK)] or [Files()]

    def read(self, partition: Files) -> Iterator[tuple]:
        yield from partition.rows

    def commit(self, end: dict) -> None:
        """Nothing is kept beside the offset."""


class FrameSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return LISTING

    def streamReader(self, schema) -> ArrivalReader:
        return ArrivalReader(self.options["path"], float(self.options.get("settle", SETTLE)))


def stream(spark: SparkSession, root: str, settle: float = SETTLE) -> DataFrame:
    """frame_path, size and mtime of what arrives under a root."""
    spark.dataSource.register(FrameSource)
    return spark.readStream.format(NAME).option("settle", str(settle)).load(root)
