"""The canonical messages table on storage.

Pages are read once and landed as Parquet partitioned by UTC day, so later
jobs read only the days they need (partition pruning) and only the columns
they use (column pruning), instead of re-parsing JSON pages.  Re-landing a
day replaces that day only (dynamic partition overwrite), so a replayed
landing run adds no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas

DAY = "date_from_unix_date(cast(floor(unix_micros(event_time) / 86400000000) AS int))"


def write_messages(messages: DataFrame, path: str) -> None:
    """Land messages under ``path/day=YYYY-MM-DD``.  Rows are clustered by
    day within each task first, so a task keeps one open file at a time."""
    (messages.withColumn("day", F.expr(DAY))
     .sortWithinPartitions("day", "channel")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("day").parquet(path))


def read_messages(spark: SparkSession, path: str, first_day: str | None = None,
                  last_day: str | None = None) -> DataFrame:
    """Landed messages, optionally restricted to a day range; the range is
    a partition filter, so other days are not listed or read."""
    landed = T.StructType(list(schemas.MESSAGES.fields) + [T.StructField("day", T.DateType())])
    df = spark.read.schema(landed).parquet(path)
    if first_day:
        df = df.filter(F.col("day") >= F.lit(first_day).cast("date"))
    if last_day:
        df = df.filter(F.col("day") <= F.lit(last_day).cast("date"))
    return df
