"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievery.session import scratch_path, table_path

__all__ = ["bounded_batches", "env_single_thread", "free_name", "input_bytes", "join_unique", "materialize", "read_table", "spark_of", "text_or_empty"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def text_or_empty(col: Column | str) -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that does not clash with any column of ``df``."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name = f"{base}_{uuid.uuid4().hex[:6]}"
    return name


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage and lets several later steps read the same rows; the files
    are in the folder that the cluster names in ``spark.checkpoint.dir``, so a
    lost executor costs nothing.
    """
    spark = spark_of(df)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_unique(rows: DataFrame, table: DataFrame, key: str, weight: str, total: int,
                how: str = "inner", share: int = 1000, key_bytes: int = 4096) -> DataFrame:
    """``rows`` joined on ``key`` with a table that has one row per key, hot keys apart.

    ``weight`` (dropped) is a key's number of rows among the ``total`` rows.  Keys
    with more than one in ``share`` of them, at most ``share`` keys of at most
    ``key_bytes`` bytes, are broadcast; their rows stay where they are.  All others
    meet in a shuffle, in which no key is hot.
    """
    hot = (F.col(weight) > total / share) & (F.octet_length(key) <= key_bytes)
    mark = free_name(rows.join(table.limit(0), key), "hot")
    values = [c for c in table.columns if c not in (key, weight)]
    few = table.filter(hot).select(key, *values, F.lit(True).alias(mark))
    marked = rows.join(F.broadcast(few), key, "left")
    rest = marked.filter(F.col(mark).isNull()).select(*rows.columns).join(
        table.filter(~hot).select(key, *values), key, how)
    columns = [*rows.columns, *values]
    return marked.filter(F.col(mark)).select(*columns).unionByName(rest.select(*columns))


def input_bytes(df: DataFrame, text: str) -> tuple[int, int]:
    """Rows and UTF-8 bytes of a text column, over all rows (one scan, two sums)."""
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 F.sum(F.octet_length(F.col(text)).cast("long")).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def bounded_batches(spark: SparkSession, most_bytes: int = 16 << 20, rows: int = 1000) -> None:
    """Bound the Arrow batches that go to Python tasks by bytes and rows, so that a run of
    very long texts does not make one huge batch; a smaller bound of the session's stays."""
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", most_bytes),
                      ("spark.sql.execution.arrow.maxRecordsPerBatch", rows)):
        now = str(spark.conf.get(key))
        size = int(now) if now.lstrip("-").isdigit() else 0
        if not 0 < size <= most:
            spark.conf.set(key, str(most))


def env_single_thread() -> None:
    """Native tokenizer libraries use one thread inside a task; Spark runs the tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
