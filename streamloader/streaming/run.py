"""Structured Streaming wiring: every micro-batch goes through the batch operators."""

from __future__ import annotations

import json
import threading
from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..plans.ingest import IngestOptions, ingest
from ..sinks import files
from ..sinks.tables import Tables
from ..sources.feed import number_by, write_topics

Trigger = dict[str, str | bool]

AVAILABLE_NOW: Trigger = {"availableNow": True}


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the stream of a checkpoint, the same after every restart."""
    return json.loads(files.read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def run_stream(
    messages: DataFrame,
    tables: Tables,
    options: IngestOptions,
    *,
    job: str,
    checkpoint: str,
    trigger: Trigger | None = None,
    on_counts: Callable[[int, dict], None] | None = None,
) -> StreamingQuery:
    """Ingest a stream of messages.

    Offsets and batch ids live in the checkpoint; `job` names it in the tables, so a batch that is
    replayed after a failure has no second effect.  A job name belongs to the stream that used it first: with
    another checkpoint the batches would be numbered anew, so that is refused.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        source = stream_id(batch.sparkSession, checkpoint)
        counts = ingest(batch, tables, options, job=job, batch_id=batch_id, source=source)
        if on_counts is not None:
            on_counts(batch_id, counts)

    writer = messages.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()


COUNTS = "ingest_counts"
# Key of rows for tables that are not listed.
OTHER_TABLES = ""


def observe_counts(rows: DataFrame, tables: Sequence[str]) -> DataFrame:
    """Named metrics on a stream of projected rows: accepted and refused rows of each table, the others' under "".

    They ride on the stream itself; `StreamCounts` reads them batch by batch.
    """
    refused = F.col("reason").isNotNull()
    conditions = [(t, F.col("dest_table").eqNullSafe(F.lit(t))) for t in tables]
    listed = F.coalesce(F.col("dest_table").isin(list(tables)), F.lit(False))
    entries = []
    for name, mine in [*conditions, (OTHER_TABLES, ~listed)]:
        both = F.struct(F.count_if(mine & ~refused).alias("accepted"), F.count_if(mine & refused).alias("refused"))
        entries += [F.lit(name), both]
    return rows.observe(COUNTS, F.create_map(*entries).alias("tables"))


class StreamCounts(StreamingQueryListener):
    """Counts of the streams of a session, per run, batch and table, from their progress events.

    Register it with `spark.streams.addListener`; it holds one small row for each.
    """

    def __init__(self) -> None:
        self.rows: list[tuple[str, int, str, int, int]] = []
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        metrics = progress.observedMetrics.get(COUNTS)
        if metrics is not None:
            for table, (accepted, refused) in sorted(metrics["tables"].items()):
                if accepted or refused:
                    self.rows.append((str(progress.runId), progress.batchId, table, accepted, refused))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Until the events of a query that has ended are here."""
        if not self._ended[str(query.runId)].wait(seconds):
            raise TimeoutError("the stream's last event did not arrive")

    def frame(self, spark: SparkSession) -> DataFrame:
        """(run, batch, dest_table, accepted, refused) of everything seen."""
        return spark.createDataFrame(self.rows, "run string, batch bigint, dest_table string, accepted bigint, refused bigint")


def merge_stream(
    rows: DataFrame,
    tables: Tables,
    table: str,
    order: Sequence[str],
    mode: str = "upsert",
    *,
    job: str,
    checkpoint: str,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Upsert (or insert-if-absent) a stream of typed rows into a keyed table.

    Within a micro-batch `order` decides which row of a key wins; later batches are newer.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        tables.claim(job, stream_id(batch.sparkSession, checkpoint))
        tables.write(tables.require(table), batch, f"{job}-{batch_id:012d}", order, mode)

    writer = rows.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()


def first_wins(rows: DataFrame, keys: Sequence[str], watermark: tuple[str, str] | None = None) -> DataFrame:
    """First row of each key of a stream, held in Spark's state.

    Without a watermark the state keeps every key ever seen.  With `(column, delay)` it forgets a key
    after the delay, and a key that returns later counts as new.
    """
    if watermark is None:
        return rows.dropDuplicates(list(keys))
    return rows.withWatermark(*watermark).dropDuplicatesWithinWatermark(list(keys))


# Next number of each topic after a batch, in a folder that readers of the feed pass over.
_NUMBERS = "_numbers"


def write_feed(
    messages: DataFrame,
    path: str,
    *,
    checkpoint: str,
    trigger: Trigger | None = None,
) -> StreamingQuery:
    """Publish a stream of feed messages; each topic is numbered on from its rows already published.

    A batch is staged by topic, numbered where it lies, and written to a folder of its own.  The next number of every topic is
    written last: a batch that has it is complete and is not published again, one that has not is written anew.
    """

    def publish(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = f"batch={batch_id:012d}"
        done = [n for n in files.list_names(spark, f"{path}/{_NUMBERS}") if files.exists(spark, f"{path}/{_NUMBERS}/{n}/_SUCCESS")]
        if name in done:
            return
        earlier = [n for n in done if n < name]
        starts = spark.read.schema("topic string, next bigint").parquet(f"{path}/{_NUMBERS}/{max(earlier)}") if earlier else None
        staged = files.scratch_path(spark, "feed")
        try:
            batch.hint("rebalance", "topic").write.partitionBy("topic").parquet(staged)
            held = spark.read.schema(batch.schema).parquet(staged).select(*batch.columns)
            numbered = number_by(held, "topic", starts).withColumns(
                {"offset": F.col("sequence"), "key": F.col("sequence").cast("string")}
            )
            write_topics(numbered, f"{path}/{name}", mode="overwrite")
            counts = held.groupBy("topic").agg(F.count(F.lit(1)).alias("next"))
            if starts is not None:
                counts = counts.unionByName(starts).groupBy("topic").agg(F.sum("next").alias("next"))
            counts.write.mode("overwrite").parquet(f"{path}/{_NUMBERS}/{name}")
        finally:
            files.delete_folder(spark, staged)

    writer = messages.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or AVAILABLE_NOW)).start()
