"""Sinks: payload tables, injected delivery, response checks (SNK-1..SNK-5,
R-1, R-2, LOG-1).

The original posted each payload over HTTP from inside a task and restarted
the job on any failure.  Here:

* the default sink writes the payload DataFrame as Parquet into the folder of
  its batch id, which it replaces: a replayed batch adds no rows, and one that
  yields none clears the folder;
* an optional ``deliver(url, body, key) -> response body`` callable is
  applied to every payload row inside the tasks (``mapInPandas``, one Arrow
  batch at a time), the responses are classified in the JVM (R-1), and any
  response that is not OK fails the batch (R-2) after the receipts have been
  written, so the batch can be replayed.  Each payload carries a
  deterministic ``key`` the receiving side can use to drop repeats.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.responses import OK, response_status

Deliver = Callable[[str, str, str], str]

# Columns of every payload, whatever its kind (posts, users, channels, team).
PAYLOAD = ["kind", "team_id", "channel", "chunk", "url", "n_items", "body", "key"]
RECEIPT_SCHEMA = ("kind string, team_id string, channel string, chunk bigint, key string, url string, "
                  "n_items bigint, response string")
RECEIPTS = T.StructType(
    [T.StructField(n, T.LongType() if n in ("chunk", "n_items") else T.StringType())
     for n in ("kind", "team_id", "channel", "chunk", "key", "url", "n_items", "response", "status")])


# Bytes of an Arrow batch of payloads, beside its last row: a batch that holds a body of the
# default size holds few others, so a task's memory does not follow its number of payloads.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bound the batches of payloads that go to Python tasks; a smaller bound of the session's stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).rstrip("bB")
    if not (now.isdigit() and 0 < int(now) <= BATCH_BYTES):
        spark.conf.set(key, str(BATCH_BYTES))


class DeliveryError(RuntimeError):
    """Raised when a batch has responses other than OK (R-2)."""


def _deliver_partitions(deliver: Deliver):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            responses = []
            for url, body, key in zip(pdf["url"], pdf["body"], pdf["key"]):
                try:
                    responses.append(deliver(url, body, key))
                except Exception as exc:  # noqa: BLE001 - any failure is a reject
                    responses.append(f"delivery failed: {type(exc).__name__}: {exc}")
            yield pdf.drop(columns="body").assign(response=responses)
    return run


def deliver_payloads(payloads: DataFrame, deliver: Deliver) -> DataFrame:
    """SNK-1..SNK-4: call ``deliver`` once per payload row, in the tasks, a few
    rows at a time (a row holds a whole body).

    Returns receipts: kind, team_id, channel, chunk, key, url, n_items, response,
    status (``RECEIPTS``).
    """
    bounded_batches(payloads.sparkSession)
    cols = payloads.select("kind", "team_id", "channel", "chunk", "key", "url", "n_items", "body")
    receipts = cols.mapInPandas(_deliver_partitions(deliver), RECEIPT_SCHEMA)
    return receipts.withColumn("status", response_status(F.col("response")))


def receipt_rejects(receipts: DataFrame) -> DataFrame:
    """LOG-1: receipts that are not OK, in the rejects shape."""
    return (receipts.filter(F.col("status") != OK)
            .select(F.lit("delivery").alias("source"), F.col("key"),
                    F.concat(F.col("status"), F.lit(": "), F.col("response")).alias("reason")))


def check_receipts(receipts: DataFrame, sample: int = 10) -> int:
    """R-2: raise when any receipt is not OK; return the number delivered.

    Only counts and at most ``sample`` keys reach the driver.  Pass stored
    (or cached) receipts: this runs two actions, and receipts computed from
    ``deliver_payloads`` directly would deliver again on each.
    """
    summary = receipts.groupBy((F.col("status") == OK).alias("ok")).count().collect()
    counts = {row["ok"]: row["count"] for row in summary}
    if counts.get(False, 0):
        keys = [r["key"] for r in receipts.filter(F.col("status") != OK)
                .select("key").limit(sample).collect()]
        raise DeliveryError(f"{counts[False]} payload(s) not accepted, e.g. {keys}")
    return counts.get(True, 0)


def _folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={int(batch_id)}"


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Idempotent batch write: the rows of ``batch_id`` replace that batch's
    folder, also when there are none."""
    df.write.mode("overwrite").parquet(_folder(path, batch_id))


def read_batch(spark: SparkSession, path: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """The rows of one batch, from its folder alone."""
    return spark.read.schema(schema).parquet(_folder(path, batch_id))


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all batches with ``batch_id``; none if no batch was written."""
    own = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    try:
        return spark.read.schema(own).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], own)


def batch_sink(path: str, build: Callable[[DataFrame], DataFrame] | None = None,
               deliver: Deliver | None = None, receipts_path: str | None = None):
    """A ``foreachBatch`` function: build payloads from the micro-batch,
    write them under the batch id, optionally deliver them, store the
    receipts (default ``<path>-receipts``) and check them (R-2).  The receipts
    are a ledger: a replayed batch delivers only what it has no OK receipt for.
    A batch without payloads (F-7, F-9) writes and checks nothing but empty
    folders."""
    from .ledger import Ledger

    receipts_at = receipts_path or path.rstrip("/") + "-receipts"

    def sink(batch: DataFrame, batch_id: int) -> None:
        out = build(batch) if build else batch
        write_batch(out, path, batch_id)
        if deliver is not None:
            spark = out.sparkSession
            written = read_batch(spark, path, batch_id, out.schema)
            # Receipts are stored before they are checked: the check reads
            # them back, so no payload is delivered twice by the check itself.
            ledger = Ledger(spark, receipts_at)
            ledger.attempt(written, deliver, batch_id)
            ledger.check(batch_id)
    return sink


def print_sink(df: DataFrame, path: str | None = None, preview: int = 1000) -> None:
    """SNK-5: print rows.  With ``path`` every row is printed by its task, as a line of
    JSON in a text file there; without, the first ``preview`` rows are shown on the
    driver's console, for a look."""
    if path is not None:
        df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})).write.mode("overwrite").text(path)
        return
    for row in df.limit(preview).collect():
        print(row)


def accepting_service(url: str, body: str, key: str) -> str:
    """A stand-in for the graph service that accepts every payload and
    answers with the number of items received (for local runs and tests)."""
    import json
    return json.dumps({"received": len(json.loads(body))})


def selective_service(url: str, body: str, key: str) -> str:
    """A stand-in that refuses payloads by their key (for local runs and tests):
    keys that start with 0 to 3 are not accepted, with 4 or 5 time out."""
    if key < "4":
        return '{"message":[{"error":"refused"}]}'
    return "upstream timeout" if key < "6" else accepting_service(url, body, key)
