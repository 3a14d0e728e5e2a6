"""ST-1 with state: the progress of every channel, kept over restarts.

The original's mapper remembers the last id it worked on and whether a snapshot of
its state has completed.  Here a keyed state holds, per channel, the time of its last
message, the number of messages and the run that saw it last; a timer on event time
tells of channels that fell silent, and a listing gives the state that a stream
starts with, so that channels without any message are told of too.

Rows are reduced per task before they are keyed (one row per channel and Arrow batch),
so a channel with a third of all messages sends its key's task a few rows only.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.routing import micros
from ..session import scratch_path
from ..sinks.delivery import read_batches, write_batch

STATE = "last_us long, messages long, restarts int, run int"
PROGRESS = "channel string, last_us long, messages long, restarts int, silent boolean"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
FIRST_TIMER = 1               # milliseconds since the epoch: as soon as there is a watermark


class ChannelProgress(StatefulProcessor):
    """State of one channel; emits it whenever it changes and once the channel is silent."""

    def __init__(self, run: int, silence_ms: int) -> None:
        self.run, self.silence = run, silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("progress", STATE)

    def _out(self, channel: str, last, messages: int, restarts: int, silent: bool) -> Iterator[Row]:
        yield Row(channel=channel, last_us=last, messages=messages, restarts=restarts, silent=silent)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last, messages, restarts, run = self.state.get() if self.state.exists() else (None, 0, 0, self.run)
        seen = messages > 0
        for r in rows:
            messages += r["n"]
            last = r["us"] if last is None else max(last, r["us"])
        if seen and run != self.run:
            restarts += 1
        self.state.update((last, messages, restarts, self.run))
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        self.handle.registerTimer(last // 1000 + self.silence)
        yield from self._out(key[0], last, messages, restarts, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        last, messages, restarts, _ = self.state.get()
        yield from self._out(key[0], last, messages, restarts, True)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.state.update((None, 0, 0, self.run))
        self.handle.registerTimer(FIRST_TIMER)

    def close(self) -> None:
        pass


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            t = pa.Table.from_batches([b]).group_by("channel").aggregate([("us", "max"), ("us", "count")])
            yield pa.RecordBatch.from_arrays(
                [t.column("channel").combine_chunks(), t.column("us_max").combine_chunks(),
                 t.column("us_count").combine_chunks()], ["channel", "us", "n"])


def channel_progress(messages: DataFrame, listing: DataFrame | None = None, silence: str = "1 hour",
                     watermark: str = "10 minutes", run: int = 0) -> DataFrame:
    """The progress rows of a message stream (update mode): every channel whose state changed in a
    batch, and silent ones once the watermark is ``silence`` behind their last message.

    Messages without a channel or a time take no part.  ``listing`` (id): channels that the state
    starts with."""
    rows = (messages.filter("channel IS NOT NULL AND event_time IS NOT NULL")
            .select("channel", F.unix_micros("event_time").alias("us"))
            .mapInArrow(_reduced, "channel string, us long, n long")
            .withColumn("event_time", F.timestamp_micros("us")).withWatermark("event_time", watermark))
    start = None
    if listing is not None:
        start = listing.select(F.col("id").alias("channel")).distinct().groupBy("channel")
    return rows.groupBy("channel").transformWithState(
        ChannelProgress(run, micros(silence) // 1000), PROGRESS, "Update", "EventTime", start)


@contextmanager
def keyed_state(spark: SparkSession):
    """Within it, started queries keep their state in RocksDB, which keyed state needs."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def run_progress(spark: SparkSession, messages: DataFrame, out: str, run: int = 0, **options) -> None:
    """Process what is available now; give the next ``run`` and the same ``out`` to go on."""
    with keyed_state(spark):
        q = (channel_progress(messages, run=run, **options).writeStream.outputMode("update")
             .foreachBatch(lambda df, batch: write_batch(df, out + "/progress", batch))
             .option("checkpointLocation", out + "/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()


def latest_progress(spark: SparkSession, out: str) -> DataFrame:
    """One row per channel: what the last batch that told of it said."""
    rows = read_batches(spark, out + "/progress", spark.createDataFrame([], PROGRESS).schema)
    latest = F.max_by(F.struct("last_us", "messages", "restarts", "silent"), F.struct("batch_id", "silent"))
    return rows.groupBy("channel").agg(latest.alias("p")).select("channel", "p.*")


def progress_path(spark: SparkSession) -> str:
    return scratch_path(spark, "channel-progress")
