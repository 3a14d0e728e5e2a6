"""ST-3: looking at the state of a stopped stream before it is started again.

The original raises when the restored state is not exactly what it wrote.  Here the
checkpoint is read with Spark's ``state-metadata`` and ``statestore`` sources: the
stateful operators, their partitions and their keys are compared with what the query
is known to have, and a difference raises before any batch runs.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUMMARY = "operator long, name string, store string, partitions int, keys long"


class StateError(RuntimeError):
    """Raised when a checkpoint does not hold the state that its query needs."""


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """operator, name, store, partitions, batch, properties (JSON) of every state store of the
    checkpoint."""
    try:
        return spark.read.format("state-metadata").load(checkpoint).select(
            F.col("operatorId").alias("operator"), F.col("operatorName").alias("name"),
            F.col("stateStoreName").alias("store"), F.col("numPartitions").alias("partitions"),
            F.col("maxBatchId").alias("batch"), F.col("operatorProperties").alias("properties"))
    except PySparkException as exc:
        raise StateError(f"the checkpoint {checkpoint} has no readable state: {exc}") from exc


def state_keys(spark: SparkSession, checkpoint: str, operator: int = 0, store: str = "default",
               variable: str | None = None) -> DataFrame:
    """partition, key, value rows of one state store, or of one ``variable`` of a keyed state, as of
    the last finished batch.  A keyed state needs the session's state provider to be its own
    (``progress.keyed_state``)."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    reader = reader.option("stateVarName", variable) if variable else reader.option("storeName", store)
    return reader.load(checkpoint).select(F.col("partition_id").alias("partition"), "key", "value")


def state_variables(properties: str | None) -> list[str]:
    """The value, list and map states of a keyed state, without its timers."""
    found = json.loads(properties or "{}").get("stateVariables") or []
    found = json.loads(found) if isinstance(found, str) else found
    return [v["stateName"] for v in found if not v["stateName"].startswith("$")]


def state_summary(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Keys of every state store (``SUMMARY``), counted by Spark store by store: one row per store, for
    a keyed state one per variable.  A join's stores are told of without a count."""
    out = []
    for row in state_operators(spark, checkpoint).collect():            # a row per store of the query
        head = [F.lit(row.operator).cast("long").alias("operator"), F.lit(row.name).alias("name"),
                F.lit(row.store).alias("store"), F.lit(row.partitions).cast("int").alias("partitions")]
        if row.name.startswith("transformWithState"):
            for name in state_variables(row.properties):
                found = state_keys(spark, checkpoint, row.operator, variable=name).agg(F.count("*").alias("keys"))
                out.append(found.select(head[0], head[1], F.lit(name).alias("store"), head[3], "keys"))
        elif row.store == "default":
            out.append(state_keys(spark, checkpoint, row.operator, row.store)
                       .agg(F.count("*").alias("keys")).select(*head, "keys"))
        else:
            out.append(spark.range(1).select(*head, F.lit(None).cast("long").alias("keys")))
    return reduce(DataFrame.unionByName, out) if out else spark.createDataFrame([], SUMMARY)


def check_state(spark: SparkSession, checkpoint: str, expected: dict[str, int], partitions: int) -> int:
    """Raise unless the checkpoint has exactly the ``expected`` number of stateful operators of each
    name, each with that many ``partitions``, and every store can be read; the keys found.

    Call it before a query is restarted from the checkpoint."""
    rows = state_operators(spark, checkpoint).select("operator", "name", "partitions").distinct().collect()
    found: dict[str, int] = {}
    for r in rows:
        found[r.name] = found.get(r.name, 0) + 1
        if r.partitions != partitions:
            raise StateError(f"{r.name} has {r.partitions} partitions of state, not {partitions}")
    if found != expected:
        raise StateError(f"the checkpoint holds {found}, the query needs {expected}")
    try:
        return sum(r.keys_ or 0 for r in state_summary(spark, checkpoint).withColumnRenamed("keys", "keys_").collect())
    except Exception as exc:  # noqa: BLE001 - whatever a damaged store makes of it
        raise StateError(f"the state of {checkpoint} cannot be read: {exc}") from exc
