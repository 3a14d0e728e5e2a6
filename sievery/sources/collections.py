"""In-memory collections as DataFrames (SRC-7, SRC-8).

The original turned driver-side lists into streams, in one case as a single
record holding the whole list.  Here a collection becomes one row per
element; a parallel collection is additionally spread over ``k`` tasks by
its key, which is where work is placed (PART-1 as placement).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def from_rows(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    """SRC-7: a small driver-side collection, one row per element."""
    return spark.createDataFrame(list(rows), schema)


def from_parallel_rows(spark: SparkSession, rows: Iterable, schema: StructType | str,
                       k: int, key: str) -> DataFrame:
    """SRC-8: as ``from_rows``, placed on ``k`` tasks by ``key``."""
    return from_rows(spark, rows, schema).repartition(k, key)
