"""A corpus pipeline: toxic texts go, near copies go, repeated passages go, sources are mixed, texts become token ids.

Each stage gets what its predecessor kept, read back from Parquet, and all but the last return the columns of documents.
Near copies are texts of a five-word shingle similarity of 0.8 or more, directly or through others; the smallest doc_id stays.
The last stage's rows keep the order of the mixture: they lie in it and mix_order tells it.  Stages may be composed, written between
or not; their working tables go when what was made of them has been written.
SQL can't express the stages (a trained model, exact set joins over whole texts, byte spans), so there is no ORACLE_SQL.

All stages: an empty table gives no rows; texts of any length are read whole; other columns, whatever their names, are kept by
all but the last stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skiagram.llm import bpe, jaccard, mixing, repeats, toxicity
from skiagram.llm.shared import collecting, discard, staged, unused_name

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Folders of the working tables of stages called by themselves, by the name that their result carries.
_returned: dict[str, list[str]] = {}
#: The result's name in the metadata of doc_id, which Parquet files keep.
MADE_BY = "pipeline_stage"
#: Where the folders of a stage's working tables go, within ``run``.
_run: ContextVar[list[str] | None] = ContextVar("run", default=None)


def forget(spark: SparkSession, docs: DataFrame) -> None:
    """Deletes the working tables of the stage that made ``docs``, if it has been written and no longer reads them."""
    name = docs.schema["doc_id"].metadata.get(MADE_BY, "")
    folders = _returned.get(name)
    if folders and not any(folder.rpartition("/")[2] in file for file in docs.inputFiles() for folder in folders):
        discard(spark, _returned.pop(name))


def stage(f: Stage) -> Stage:
    @wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        own: list[str] = []
        if _run.get() is None:
            forget(spark, docs)
        with collecting(own):
            made = f(spark, docs, sf_dir)
        if _run.get() is not None:
            _run.get().extend(own)
            return made
        name = uuid.uuid4().hex
        _returned[name] = own
        return made.withMetadata("doc_id", {MADE_BY: name})

    return run_stage


def place(docs: DataFrame) -> Column:
    """Where a row stands in the files of a table that was written in an order; in the frame, where it isn't read from files."""
    try:
        at = docs.metadataColumn("_metadata")
        number = F.regexp_extract(at["file_name"], r"part-(\d+)", 1)
        order = F.shiftleft(F.coalesce(number.try_cast("long"), F.lit(0)), 40) + at["row_index"]
        docs.select(order)
        return order
    except AnalysisException:
        return F.monotonically_increasing_id()


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a toxicity score below 0.5.  Null and empty texts get the score of the bias, so they stay where toxic texts are
    the fewer; repeated rows share a verdict; rows without a label or a doc_id are judged like others but don't train."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that of the smallest doc_id.  Texts without a word (null, empty) are in no group and stay, as do
    rows without a doc_id; rows equal in doc_id and text are one document and stay together; rows that share a doc_id only are
    documents of their own."""
    return jaccard.first_of_components(docs, 5, 80, 100)


@stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, without bytes of 100-byte strings that start earlier; null texts stay null, texts may become empty; rows equal in
    doc_id and text are cut alike; a null doc_id comes first."""
    return repeats.without_repeats(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in the order of the mixture.  A null source is a source; null ids come first; equal ids are ordered by a hash of
    the row."""
    return mixing.in_mix_order(docs)


@stage
def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row of ids and digests for each row, in the order of the mixture, which mix_order tells; a null or empty text has no ids and
    the digests of nothing."""
    import public_tokenizers

    order = unused_name(docs, "mix_order")
    rows = docs.select("doc_id", "text", place(docs).alias(order)).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), order).sortWithinPartitions(order)
    return bpe.encode_column(rows.withColumnRenamed(order, "mix_order"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True, order_col="mix_order")


STAGES = [("toxicity", drop_toxic), ("near_copies", drop_near_copies), ("repeats", cut_repeats), ("mixing", mix_sources), ("tokens", to_tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written, and the tables of the one before go then.  Runs know nothing of each other."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before: list[str] = []
    for _, f in STAGES:
        now: list[str] = []
        working: list[str] = []
        was = _run.set(working)
        try:
            made = f(spark, docs, sf_dir)
        finally:
            _run.reset(was)
        docs = staged(made, now)
        discard(spark, [*before, *working])
        before = now
    return docs
