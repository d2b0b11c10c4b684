"""Helpers shared by the operators: the shared folder, table reading, the fold of a document."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of one Arrow batch that carry whole texts: long documents then stay within a worker's memory.
TEXT_BATCH_ROWS = "512"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`, or in a local session without it a fresh one."""
    context = spark.sparkContext
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not set_dir and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(set_dir or tempfile.mkdtemp(prefix="llm-"))
    return (set_dir or context.getCheckpointDir()).rstrip("/")


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; inside `temporary` it is deleted at the end."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Deletes the intermediate tables written inside, whose readers must be done by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            discard(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def cut(df: DataFrame) -> DataFrame:
    """Compute once into the shared folder; later reads survive the loss of executors.

    The files stay until `release`, or inside `temporary` until its end: Spark itself does not delete them.
    """
    shared_dir(df.sparkSession)
    kept = df.checkpoint()
    kept.cut_path = kept._jdf.logicalPlan().rdd().getCheckpointFile().get()
    if _scopes:
        _scopes[-1].append(kept.cut_path)
    return kept


def release(*frames: DataFrame) -> None:
    """Delete the files of frames made by `cut`, from which nothing is read any more."""
    for df in frames:
        discard(df.sparkSession, df.cut_path)


def forget_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files of frames that are gone: it does when the driver's JVM collects their handles."""
    spark._jvm.System.gc()


def small_batches(spark: SparkSession) -> None:
    """Hand whole texts to Python in small Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", TEXT_BATCH_ROWS)


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id is in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def hash_sample(df: DataFrame, key: str, most: int, seed: int) -> DataFrame:
    """At most `most` rows, those with the smallest seeded hashes of `key`.

    Only hashes below a bound that twice as many rows are expected to meet are sorted, so that no task gathers
    the candidates of all others.
    """
    total = df.count()
    drawn = F.xxhash64(F.lit(seed), key)
    share = min(1.0, 2 * most / max(1, total))
    below = df if share == 1 else df.where(drawn < int((share - 0.5) * 2**64))
    return below.orderBy(drawn, key).limit(most)


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def columns(batch: pa.RecordBatch, *names: str) -> Iterator[list]:
    return (column(batch, name) for name in names)
