"""Tables of a run that lie in the same buckets, so that joins and aggregations by frame need no shuffle.

A frame's rows of every table go to the bucket of its id, sorted by uid.  Spark joins such tables on (frame_id, grain_uid), or counts by
frame, bucket by bucket where they lie, in sessions with the library's settings (``spark.sql.requireAllClusterKeysForCoPartition`` off;
else such a join shuffles as usual).  There is no metastore: a table is a folder of Parquet files by itself, and its buckets are
told to Spark when it is opened, under a name of that call's own which is gone when the call ends.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

KEY, ORDER = "frame_id", "grain_uid"


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def write(df: DataFrame, path: str, buckets: int) -> str:
    """A new table at a path where there is none, a file a bucket: rows are dealt by the same hash that tells buckets."""
    spark, name = df.sparkSession, f"colocated_{uuid.uuid4().hex}"
    try:
        df.repartition(buckets, KEY).write.format("parquet").option("path", path).bucketBy(buckets, KEY).sortBy(ORDER).saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")  # of an external table the files stay
    return path


def read(spark: SparkSession, path: str, shape: StructType, buckets: int) -> DataFrame:
    """A table that ``write`` has left; ``buckets`` must be what it was written with."""
    name = f"colocated_{uuid.uuid4().hex}"
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in shape)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({ORDER}) INTO {int(buckets)} BUCKETS LOCATION '{place}'")
    try:
        return spark.table(name)  # resolved here; the frame doesn't need the name any more
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
