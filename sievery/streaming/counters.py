"""AGG-4 of a running stream: observed counters, one value per batch.

``observe_counters`` attaches named aggregates to a stream; Spark computes them in the
pass that processes the batch.  A ``StreamCounters`` listener gathers them, with the
rows that stateful operators dropped as later than the watermark.  A batch that is
replayed after a failure reports again under its id and replaces its value.  Only the
newest batch can be replayed, so older ones are folded into a total: the listener
holds the last ``keep`` batches whatever the stream's length.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

NAME = "counters"
DROPPED = "late_rows"


def observe_counters(df: DataFrame, **counters: Column) -> DataFrame:
    """``df`` with named aggregates that are observed in every batch."""
    return df.observe(NAME, *[c.alias(k) for k, c in counters.items()])


class StreamCounters(StreamingQueryListener):
    """Counters of the queries that bear one of the given names (all, if none is given)."""

    def __init__(self, *names: str, keep: int = 1000) -> None:
        self.names, self.keep = set(names), keep
        self._batches: dict[int, dict[str, int]] = {}
        self._folded: dict[str, int] = {}
        self._open: set[str] = set()
        self._lock = threading.Condition()

    # ---- events, in order, on the listener's own thread
    def onQueryStarted(self, event) -> None:
        if not self.names or event.name in self.names:
            with self._lock:
                self._open.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if not self.names or p.name in self.names:
            observed = p.observedMetrics.get(NAME)
            found = {k: int(v or 0) for k, v in observed.asDict().items()} if observed else {}
            found[DROPPED] = sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
            self.note(p.batchId, found)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._lock:
            self._open.discard(str(event.runId))
            self._lock.notify_all()

    # ---- values
    def note(self, batch_id: int, counters: dict[str, int]) -> None:
        with self._lock:
            # a batch without rows of its own (a watermark that moved on) reports nothing observed
            self._batches[batch_id] = counters
            while len(self._batches) > self.keep:
                for k, v in self._batches.pop(min(self._batches)).items():
                    self._folded[k] = self._folded.get(k, 0) + v

    def batches(self) -> dict[int, dict[str, int]]:
        with self._lock:
            return {b: dict(c) for b, c in self._batches.items()}

    def totals(self) -> dict[str, int]:
        with self._lock:
            out = dict(self._folded)
            for counters in self._batches.values():
                for k, v in counters.items():
                    out[k] = out.get(k, 0) + v
            return out

    def wait(self, run_id, timeout: float = 60.0) -> None:
        """Until the run's last event has come, which follows all its progress."""
        with self._lock:
            if not self._lock.wait_for(lambda: str(run_id) not in self._open, timeout):
                raise TimeoutError(f"no end of run {run_id} reported")

    def frame(self, spark: SparkSession) -> DataFrame:
        """The totals as (metric, value) rows: one row per counter."""
        return spark.createDataFrame(sorted(self.totals().items()), "metric string, value long")


def run_counted(spark: SparkSession, writer, counters: StreamCounters) -> None:
    """Start a stream writer, process what is available, and return when its counters are in."""
    spark.streams.addListener(counters)
    try:
        q = writer.trigger(availableNow=True).start()
        try:
            q.awaitTermination()
        finally:
            counters.wait(q.runId)
    finally:
        spark.streams.removeListener(counters)


def message_counters(messages: DataFrame, notable: Column) -> DataFrame:
    """The mapper's counters on a message stream: messages seen, notable ones, and per category."""
    from ..functions import classify as C
    per = {f"seen_{c}": F.count_if(F.col("category") == c) for c in C.ORDER_B}
    return observe_counters(messages, seen_posts=F.count(F.lit(1)), mapper_posts=F.count_if(notable), **per)
