"""Feather (Arrow IPC) tables as a data source: planned partitions, the columns that are asked for, filters before rows leave the worker.

Files are listed once when the scan is planned, on any file system that pyarrow knows.  A large file is cut into ranges of its record
batches.  The schema that the reader is given is what is read from the files, other columns aren't decoded; columns that a file lacks
are null.  Filters on numbers and texts are applied batch by batch, and those on a key of folders named key=value leave out whole
files.  Spark hands filters over only where ``spark.sql.python.filterPushdown.enabled`` is set.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

NAME, SUFFIX, LARGE, PUSHDOWN = "skiagram_feather", ".feather", 64 << 20, "spark.sql.python.filterPushdown.enabled"


def located(path: str):
    """The file system of a path or URI, and the path there."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), os.path.abspath(path))


def files_of(path: str) -> list[tuple[str, int]]:
    """Path and size of the feather files at or under a path, in order; hidden ones are left out."""
    from pyarrow import fs

    system, inner = located(path)
    info = system.get_file_info(inner)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inner, recursive=True)) if info.type == fs.FileType.Directory else []
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and f.path.endswith(SUFFIX) and not f.base_name.startswith("."))


@dataclass
class Batches(InputPartition):
    """Record batches first to last (exclusive; None for all) of a file."""

    path: str
    first: int = 0
    last: int | None = None


class FeatherReader(DataSourceReader):
    def __init__(self, schema: StructType, path: str) -> None:
        self.schema, self.path = to_arrow_schema(schema), path
        self.conditions: list[pc.Expression] = []
        self.folders: dict[str, set[str]] = {}  # texts that a folder key must have

    def partitions(self) -> Sequence[InputPartition]:
        system, _ = located(self.path)
        out: list[InputPartition] = []
        for path, size in files_of(self.path):
            named = dict(s.split("=", 1) for s in path.split("/") if "=" in s)
            if any(k in named and named[k] not in may for k, may in self.folders.items()):
                continue
            if size <= LARGE:
                out.append(Batches(path))
                continue
            with system.open_input_file(path) as f:
                n = pa.ipc.open_file(f).num_record_batches
            step = max(1, n * LARGE // size)
            out += [Batches(path, k, min(k + step, n)) for k in range(0, n, step)]
        return out or [Batches("")]

    def read(self, partition: Batches) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        system, _ = located(self.path)
        with system.open_input_file(partition.path) as f:
            there = pa.ipc.open_file(f).schema.names
            wanted = [there.index(n) for n in self.schema.names if n in there]
            reader = pa.ipc.open_file(f, options=pa.ipc.IpcReadOptions(included_fields=wanted))
            for k in range(partition.first, reader.num_record_batches if partition.last is None else partition.last):
                b = reader.get_batch(k)
                columns = [b.column(c.name).cast(c.type) if wanted and c.name in b.schema.names and c.name in there else pa.nulls(b.num_rows, c.type) for c in self.schema]
                rows = pa.Table.from_arrays(columns, schema=self.schema)
                for condition in self.conditions:
                    rows = rows.filter(condition)
                yield from rows.to_batches()


COMPARED = {GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal, LessThan: pc.less, LessThanOrEqual: pc.less_equal, EqualTo: pc.equal}


class FilteringReader(FeatherReader):
    """Takes the filters that Arrow evaluates as Spark does: NaN is greater than any number there, so it passes those comparisons."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            made = self.condition(f) if len(getattr(f, "attribute", ())) == 1 and f.attribute[0] in self.schema.names else None
            if made is None:
                yield f
            else:
                self.conditions.append(made)

    def condition(self, f: Filter) -> pc.Expression | None:
        name = f.attribute[0]
        x, kind = pc.field(name), self.schema.field(name).type
        if isinstance(f, IsNull):
            return x.is_null()
        if isinstance(f, IsNotNull):
            return x.is_valid()
        text, number = pa.types.is_string(kind), pa.types.is_floating(kind) or pa.types.is_integer(kind)
        values = f.value if isinstance(f, In) else (getattr(f, "value", None),)
        if not all(isinstance(v, str) if text else number and isinstance(v, (int, float)) and not isinstance(v, bool) and v == v for v in values):
            return None
        if isinstance(f, (In, EqualTo)) and text:
            self.folders[name] = self.folders.get(name, set(values)) & set(values)
        if isinstance(f, In):
            return x.isin(pa.array(values, kind))
        if type(f) not in COMPARED:
            return None
        made = COMPARED[type(f)](x, pa.scalar(f.value, kind if text else None))
        return made | x.is_nan() if isinstance(f, (GreaterThan, GreaterThanOrEqual)) and pa.types.is_floating(kind) else made


class FeatherSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        """That of the first file, where the caller gives none."""
        found = files_of(self.options["path"])
        if not found:
            raise FileNotFoundError(f"no {SUFFIX} files at {self.options['path']}")
        system, _ = located(self.options["path"])
        with system.open_input_file(found[0][0]) as f:
            return from_arrow_schema(pa.ipc.open_file(f).schema)

    def reader(self, schema: StructType) -> FeatherReader:
        kind = FilteringReader if self.options.get("pushdown") == "true" else FeatherReader
        return kind(schema, self.options["path"])


def read(spark: SparkSession, path: str, shape: StructType | None = None) -> DataFrame:
    """The table at a path, with the columns of ``shape``; with filters pushed where the session lets Python sources have them."""
    spark.dataSource.register(FeatherSource)
    source = spark.read.format(NAME).option("pushdown", spark.conf.get(PUSHDOWN, "false"))
    return (source if shape is None else source.schema(shape)).load(path)
