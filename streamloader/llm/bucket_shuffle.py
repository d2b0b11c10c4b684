"""Two-pass external shuffle: scatter rows into memory-sized buckets, Fisher-Yates each, write them.

Pass one sends every row to a bucket drawn by a seeded hash.  The hash takes the row's id and its place
in the input, so that repeated rows spread like any others.  Pass two holds one bucket in a task,
shuffles it and writes it; the shuffled order is bucket after bucket.  Shards are equal runs of that
order, so their row counts are at most one apart.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamloader.llm.common import scratch_path

SEED = 20240607
# Text bytes (plus a fixed part for each row) that one task holds; hashing spreads rows evenly, so a
# bucket only exceeds this by chance or by a single long document.
BUCKET_BYTES = 16 << 20
ROW_BYTES = 64
SHARDS = 40
# Buckets whose counts one window task sums up; blocks of buckets are summed again.
BLOCK = 4096


def shuffle(
    docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
    seed: int = SEED, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """Write all rows in shuffled order; returns (record struct, bucket long, place long) read back from `path`.

    `record` holds the input's columns, whatever their names.  Null ids and null texts are rows like others.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "shuffled")
    size = F.coalesce(F.octet_length(text_col), F.lit(0)) + ROW_BYTES
    total = docs.agg(F.sum(size.cast("long"))).first()[0] or 0
    buckets = max(1, math.ceil(total / bucket_bytes))
    scattered = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
        F.monotonically_increasing_id().alias("origin"),
    ).withColumn("bucket", F.pmod(F.xxhash64(F.lit(seed), f"record.`{id_col}`", "origin"), F.lit(buckets)))
    out = T.StructType(
        [scattered.schema["record"], T.StructField("bucket", T.LongType()), T.StructField("place", T.LongType())]
    )

    def fisher_yates(key: tuple, rows: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        # Fetch order varies between attempts; the input order does not.
        order = np.argsort(rows.column("origin").to_numpy(), kind="stable")
        np.random.default_rng((seed, bucket)).shuffle(order)
        record = rows.column("record").combine_chunks().take(pa.array(order))
        bucket_of = pa.array(np.full(len(order), bucket), pa.int64())
        return pa.table({"record": record, "bucket": bucket_of, "place": pa.array(np.arange(len(order)))})

    scattered.groupBy("bucket").applyInArrow(fisher_yates, out).write.parquet(path)
    return spark.read.schema(out).parquet(path)


def bucket_offsets(shuffled: DataFrame) -> DataFrame:
    """(bucket, before): rows in earlier buckets, summed within blocks of buckets and then over blocks."""
    counts = shuffled.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("block", F.floor(F.col("bucket") / BLOCK))
    blocks = counts.groupBy("block").agg(F.sum("n").alias("n")).selectExpr(
        "block", "sum(n) over (order by block rows unbounded preceding) - n as block_before"
    )
    inner = counts.selectExpr(
        "block", "bucket", "sum(n) over (partition by block order by bucket rows unbounded preceding) - n as inside"
    )
    return inner.join(blocks, "block").selectExpr("bucket", "block_before + inside as before")


def place_in_shards(shuffled: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Adds shard and slot (both from 0) to rows with (bucket, place); shard sizes differ by one row at most."""
    total = shuffled.count()
    at = F.col("before") + F.col("place")
    shard = F.expr(f"cast(({{}}) * {shards}L div {max(total, 1)}L as int)".format("before + place"))
    # The first position of a shard is the least p with p * shards >= shard * total.
    first = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return (
        shuffled.join(bucket_offsets(shuffled), "bucket")
        .withColumn("shard", shard)
        .withColumn("slot", at - first)
        .drop("before")
    )


def write_shards(shuffled: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The shuffled rows as one folder per shard, each in slot order within its files."""
    placed = place_in_shards(shuffled, shards).select("record.*", "shard", "slot")
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
