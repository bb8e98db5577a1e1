"""Tables in parquet, csv or feather, whole or by partition folders; schemas are given, never guessed."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Shares of a key for each partition that they are dealt to; more make partitions more alike.
SHARES = 8

FORMATS = ("parquet", "csv", "feather")


def checked(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; one of {FORMATS}")
    return fmt


def with_extension(path: str, fmt: str) -> str:
    return path if path.endswith("." + checked(fmt)) else f"{path}.{fmt}"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def is_file(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.exists(p) and system.getFileStatus(p).isFile()


def remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def moved(spark: SparkSession, source: str, target: str) -> None:
    """The target is replaced by the source.  The old one is set aside first and goes last, so a driver that is lost in between
    leaves one of the two whole."""
    aside = f"{target}.old"
    remove(spark, aside)
    a, b, c = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target, aside))
    system = a.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(b) and not system.rename(b, c) or not system.rename(a, b):
        raise OSError(f"can't move {source} to {target}")
    remove(spark, aside)


def shared_folder(spark: SparkSession) -> str:
    """The name of a new folder below spark.checkpoint.dir, of the session or else of the context, which all workers share; below a
    temporary one in local mode where neither is set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all workers share")
        base = tempfile.mkdtemp(prefix="skiagram-")
    return f"{base.rstrip('/')}/tables-{uuid.uuid4().hex}"


def working_folder(spark: SparkSession) -> str:
    """A shared folder by its plain path, where it is a local one that all workers mount."""
    return shared_folder(spark).removeprefix("file://").removeprefix("file:")


def with_booleans(df: DataFrame) -> DataFrame:
    """Text columns whose values are all True or False, with at least one, as booleans; for tables read without a schema."""
    texts = [c for c, t in df.dtypes if t == "string"]
    if not texts:
        return df
    only = df.agg(*[F.bool_and(F.col(f"`{c}`").isin("True", "False", "true", "false")).alias(f"c{k}") for k, c in enumerate(texts)]).first()
    flags = {c for k, c in enumerate(texts) if only[k]}
    return df.select(*[F.col(f"`{c}`").cast("boolean").alias(c) if c in flags else F.col(f"`{c}`") for c in df.columns])


def read_table(spark: SparkSession, path: str, fmt: str, schema: StructType) -> DataFrame:
    """A table, or an empty one of the schema where there is none."""
    checked(fmt)
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    if fmt == "parquet":
        return spark.read.schema(schema).parquet(path)
    if fmt == "csv":
        return spark.read.schema(schema).option("header", "true").option("nanValue", "NaN").option("recursiveFileLookup", "true").csv(path)
    return read_feather(spark, path, schema)


def read_feather(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Each file, or a range of a large one, is read by one task, batch by batch; missing columns are null, others are left out."""
    from skiagram.sources import feather

    return feather.read(spark, path, schema)


def write_table(df: DataFrame, path: str, fmt: str) -> str:
    if checked(fmt) == "feather":
        return write_feather(df, path)
    out = df.write.mode("overwrite")
    out.parquet(path) if fmt == "parquet" else out.option("header", "true").option("nanValue", "NaN").csv(path)
    return path


def write_feather(df: DataFrame, path: str, keys: list[str] | None = None) -> str:
    """A folder of one feather file a task, or with keys one for each task and value of them in folders key=value (keys stay inside);
    on a path that all workers share; files of an older run go first.

    A file is named by its partition and put in place by a rename, so a task that runs again replaces its own."""
    keys = keys or []
    at = [df.columns.index(k) for k in keys]
    from pyspark.sql.pandas.types import to_arrow_schema

    remove(df.sparkSession, path)
    os.makedirs(path, exist_ok=True)
    shape = to_arrow_schema(df.schema)

    def store(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        context = TaskContext.get()
        rows, place, writer = 0, None, None

        def close() -> None:
            if writer is not None:
                writer.close()
                os.replace(f"{place}.{context.taskAttemptId()}", place)

        for b in batches:
            b = pa.RecordBatch.from_arrays([c.cast(t.type) for c, t in zip(b.columns, shape, strict=True)], schema=shape)
            values = list(zip(*(b.column(k).to_pylist() for k in at), strict=True)) if at else [()] * b.num_rows
            begin = 0
            for end in [k for k in range(1, len(values)) if values[k] != values[k - 1]] + [len(values)]:  # rows are sorted by keys
                folder = os.path.join(path, *(f"{k}={v}" for k, v in zip(keys, values[begin], strict=True))) if values else path
                now = os.path.join(folder, f"part-{context.partitionId():05d}.feather")
                if now != place:
                    close()
                    os.makedirs(folder, exist_ok=True)
                    place, writer = now, pa.ipc.new_file(f"{now}.{context.taskAttemptId()}", shape)
                writer.write_batch(b.slice(begin, end - begin))
                begin = end
            rows += b.num_rows
        close()
        yield pa.RecordBatch.from_pydict({"rows": [rows]})

    df.mapInArrow(store, "rows long").agg(F.sum("rows")).collect()
    return path


def write_partitioned(df: DataFrame, root: str, fmt: str, keys: list[str], *, partition: bool = True) -> str:
    """Parquet folders lack their keys inside; csv keeps them inline too; unpartitioned is one table."""
    if not partition or not keys:
        return write_table(df, os.path.join(root, f"data.{checked(fmt)}"), fmt)
    if checked(fmt) == "parquet":
        df.write.mode("overwrite").partitionBy(*keys).parquet(root)
    elif fmt == "csv":
        doubled = df.select("*", *[F.col(k).alias(f"_{k}") for k in keys])
        doubled.write.mode("overwrite").option("header", "true").option("nanValue", "NaN").partitionBy(*[f"_{k}" for k in keys]).csv(root)
    else:
        write_feather(dealt(df, keys).sortWithinPartitions(*keys), root, keys)
    return root


def dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows brought together by keys; those of a large table, whose keys may be few, in several shares of each key by a hash of the row."""
    from skiagram.operators import ranks

    if ranks.is_small(df):
        return df.repartition(*keys)
    n = ranks.partitions(df)
    return df.repartition(n, *keys, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(n * SHARES)))
