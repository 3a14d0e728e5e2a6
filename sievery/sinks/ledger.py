"""Delivery ledger (SNK-1..SNK-4, R-2): what was accepted is not delivered again.

Every attempt to deliver a batch of payloads leaves its receipts in a folder of its
own, ``batch_id=<b>/attempt=<a>``; none is ever replaced.  The state of a payload is
that of its latest attempt, and once accepted it stays accepted.  Before an attempt
the payloads are reduced to those whose key has no OK receipt, so a batch that is
replayed (a service that refused some, a sink that died between the delivery and the
check) delivers the rest only.

What no ledger can know is a delivery whose receipts were never stored, because the
task or the job died in between: such payloads are delivered again with the same
``key``, by which the service can tell.

The log grows by one receipt per payload and attempt; it is partitioned by batch, and
a batch reads its own folder only, unless it is asked to look at all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.responses import OK
from . import delivery as D

LOG = T.StructType([*D.RECEIPTS.fields, T.StructField("batch_id", T.LongType()),
                    T.StructField("attempt", T.IntegerType())])
STATE = ["kind", "team_id", "channel", "chunk", "url", "n_items", "response", "status"]


class Ledger:
    """The log of delivery attempts below one folder of shared storage."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def log(self, batch_id: int | None = None) -> DataFrame:
        """All receipts of a batch, or of all batches, with batch_id and attempt."""
        at = self.path if batch_id is None else f"{self.path}/batch_id={int(batch_id)}"
        try:
            return self.spark.read.schema(LOG).option("basePath", self.path).parquet(at)
        except AnalysisException as exc:
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG)

    def state(self, batch_id: int | None = None) -> DataFrame:
        """One row per key: the columns of its latest attempt (an accepted one before any
        other), the number of attempts and of accepted ones.  A partial maximum per task
        before the shuffle, however often a key was tried."""
        ok = F.col("status") == OK
        latest = F.max_by(F.struct(*STATE), F.struct(ok, "batch_id", "attempt"))
        return (self.log(batch_id).groupBy("key")
                .agg(latest.alias("_r"), F.count("*").alias("attempts"), F.count_if(ok).alias("accepted"))
                .select("key", "_r.*", "attempts", "accepted"))

    def pending(self, payloads: DataFrame, batch_id: int | None = None) -> DataFrame:
        """The payloads that no receipt shows as accepted, each key once.

        Keys are looked at first: bodies are shuffled only where a key repeats, or to a set of
        accepted keys that is too large to broadcast."""
        accepted = self.log(batch_id).filter(F.col("status") == OK).select("key").distinct()
        repeats = payloads.groupBy("key").count().filter("count > 1").limit(1).count()
        once = payloads.dropDuplicates(["key"]) if repeats else payloads
        return once.join(accepted, "key", "left_anti").select(*payloads.columns)

    def attempt(self, payloads: DataFrame, deliver: D.Deliver, batch_id: int = 0,
                everywhere: bool = False) -> int:
        """Deliver what is pending (of this batch's receipts, or of all with ``everywhere``)
        and store the receipts; the attempt's number.

        Give stored payloads: they are read again by every attempt and must be the same.
        A number is taken once its folder holds receipts; an attempt that died before
        that has left none, and its folder is written anew."""
        last = self.log(batch_id).agg(F.max("attempt")).first()[0]
        number = 1 if last is None else last + 1
        todo = self.pending(payloads, None if everywhere else batch_id)
        D.deliver_payloads(todo, deliver).write.mode("overwrite").parquet(
            f"{self.path}/batch_id={int(batch_id)}/attempt={number}")
        return number

    def check(self, batch_id: int | None = None) -> int:
        """R-2: raise if the latest state of any payload is not accepted; else how many are."""
        return D.check_receipts(self.state(batch_id))

    def deliver(self, payloads: DataFrame, service: Callable[[int], D.Deliver], batch_id: int = 0,
                most: int = 3, everywhere: bool = False) -> int:
        """Up to ``most`` attempts, until all payloads are accepted; ``service(attempt)`` gives the
        function that an attempt delivers with.  The number delivered; raises as ``check``."""
        for _ in range(most):
            last = self.log(batch_id).agg(F.max("attempt")).first()[0] or 0
            self.attempt(payloads, service(last + 1), batch_id, everywhere)
            if not self.state(batch_id).filter(F.col("status") != OK).limit(1).count():
                break
        return self.check(batch_id)


def recovering_service(attempt: int) -> D.Deliver:
    """A stand-in that refuses a third of the payloads at the first attempt, a ninth of all at
    the second, and then none (for local runs and tests)."""
    def deliver(url: str, body: str, key: str) -> str:
        if attempt < 3 and int(key[:8], 16) % 3 ** attempt == 0:
            return '{"message":[{"error":"busy"}]}'
        return D.accepting_service(url, body, key)
    return deliver
