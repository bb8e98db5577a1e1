"""Connected components by alternating large-star and small-star steps; links never leave the executors.

Each step is a minimum by node and a join.  Minima aggregate before they shuffle.  Nodes with a large share of all links are few
(``limit`` bounds how many); they meet their minimum by broadcast, so no task gets all links of one node.  The links are written
to the shared folder after every round, so lineage stays short, and the round before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skiagram.llm.shared import discard, staged


def limit(rows: int, df: DataFrame) -> int:
    """Rows of one key above which it counts as large: a quarter of a task's share.  So there are at most four large keys a task."""
    return max(rows // (4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))), 32)


def spread_join(rows: DataFrame, table: DataFrame, key: str, n: int) -> DataFrame:
    """``rows`` joined with a table of unique keys; keys with more than ``n`` rows by broadcast of their part of the table.

    ``rows`` should be written already, as they are read several times.
    """
    large = F.broadcast(rows.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > n).select(key))
    by_broadcast = rows.join(F.broadcast(table.join(large, key, "left_semi")), key)
    return by_broadcast.unionByName(rows.join(large, key, "left_anti").join(table, key))


def _moved(rows: DataFrame, least: DataFrame, n: int) -> DataFrame:
    """Links from the far ends of ``rows`` to the least node that their near end (a) is linked with."""
    large = least.filter(F.col("n") > n).select("a", "m")
    rest = rows.join(F.broadcast(large.select("a")), "a", "left_anti").join(least.filter(F.col("n") <= n).select("a", "m"), "a")
    return rows.join(F.broadcast(large), "a").unionByName(rest).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _large_star(links: DataFrame, n: int) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"), F.count("*").alias("n"))
    return _moved(both.filter("b > a"), least, n)


def _small_star(links: DataFrame, n: int) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
    return _moved(links, least, n).unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b); the component is its smallest id."""
    now_at: list[str] = []
    links = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), now_at)
    print_of = lambda df: tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    was = print_of(links)
    while was[0]:
        n = limit(was[0], links)
        half_at: list[str] = []
        half = staged(_large_star(links, n), half_at)
        before_at, now_at = [*now_at, *half_at], []
        links = staged(_small_star(half, n), now_at)
        discard(links.sparkSession, before_at)
        now = print_of(links)
        if now == was:
            break
        was = now
    roots = links.select(F.col("b").alias("id")).distinct().withColumn("component", F.col("id"))
    return links.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(roots)
