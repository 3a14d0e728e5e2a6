"""Splitting a listing into k groups (PART-1) and a distributed row index.

``ntile(k) OVER (ORDER BY id)`` without a partition runs in one task.  The
same numbering is computed here without that bottleneck: the rows are
range-partitioned and sorted by the key, each task numbers its own rows,
and the per-partition row counts (one small row per partition, a proven
bound) give each partition its offset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root


def _ranged(df: DataFrame, cols: list[str], n_parts: int | None) -> DataFrame:
    """Range-partition and sort ``df``, tag each row with its partition and
    local position, and materialize the result once.

    The frame is used twice (per-partition counts, then the join back).
    Range bounds come from a sample whose rows arrive in shuffle order, so
    two evaluations could cut the ranges differently; a reliable
    checkpoint in the shared checkpoint folder fixes one partitioning for
    both uses, also when a lost executor forces recomputation.  Without
    ``n_parts`` the number of partitions follows the data (shuffle partitions,
    coalesced by size).
    """
    checkpoint_root(df.sparkSession)
    by = [F.col(c) for c in cols]
    ranged = ((df.repartitionByRange(n_parts, *by) if n_parts else df.repartitionByRange(*by))
              .sortWithinPartitions(*cols)
              .withColumn("_pid", F.spark_partition_id())
              # monotonically_increasing_id = (partition id << 33) + position
              # in the partition: the low 33 bits are the local position.
              .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    return ranged.checkpoint(eager=True)


def row_index(df: DataFrame, order_col: str | list[str], name: str = "rn",
              partitions: int | None = None) -> DataFrame:
    """Add the 0-based position of each row in ``order_col`` order.

    Give a unique key (or several columns that together are unique), so
    the sort inside each partition has no ties.  The partitioned rows are
    checkpointed once (see ``_ranged``), so the numbering is the same for
    every use and every recomputation.
    """
    cols = [order_col] if isinstance(order_col, str) else list(order_col)
    ranged = _ranged(df, cols, partitions)
    counts = ranged.groupBy("_pid").agg(F.count("*").alias("_n"))
    # One row per partition: a proven bound, so the offsets are broadcast.
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    offsets = offsets.fillna(0, subset=["_off"])
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_local")).cast("bigint"))
            .drop("_pid", "_local", "_off"))


def rank_within(df: DataFrame, key: str, order_cols: list[str], name: str = "rank",
                partitions: int | None = None, weight: str | None = None,
                before: str = "before") -> DataFrame:
    """Add the 0-based position of each row within its ``key``, in
    ``order_cols`` order (give columns that are unique within a key).  With
    ``weight`` also add ``before``: the sum of that column over the key's
    earlier rows.

    Distributed like ``row_index``: rows are range-partitioned on (key,
    order), so a key holding a third of all rows spans many partitions; the
    per-(partition, key) row counts (at most one row per partition for each
    key) give each key's offset in every partition.  No task ever holds a
    whole key.
    """
    cols = [key] + list(order_cols)
    ranged = _ranged(df, cols, partitions)
    if weight:                                # running sum inside one partition
        local = Window.partitionBy("_pid", key).orderBy("_local").rowsBetween(
            Window.unboundedPreceding, -1)
        ranged = ranged.withColumn("_own", F.coalesce(F.sum(weight).over(local), F.lit(0)))
    firsts = ranged.groupBy("_pid", key).agg(
        F.min("_local").alias("_first"), F.count("*").alias("_n"),
        (F.sum(weight) if weight else F.lit(0)).alias("_w"))
    earlier = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = firsts.select(F.col("_pid").alias("_opid"), F.col(key).alias("_okey"), "_first",
                            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_off"),
                            F.coalesce(F.sum("_w").over(earlier), F.lit(0)).alias("_woff"))
    # null-safe on the key: rows whose key is NULL form a group of their own
    on = (F.col("_pid") == F.col("_opid")) & F.col(key).eqNullSafe(F.col("_okey"))
    out = ranged.join(offsets, on).withColumn(
        name, (F.col("_off") + F.col("_local") - F.col("_first")).cast("bigint"))
    if weight:
        out = out.withColumn(before, (F.col("_woff") + F.col("_own")).cast("bigint")).drop("_own")
    return out.drop("_pid", "_local", "_first", "_off", "_woff", "_opid", "_okey")


def ntile_of(index: str, n: int, k: int) -> F.Column:
    """Group number (1..k) of the 0-based position in column ``index`` among
    ``n`` rows, the same as SQL ``ntile(k)``: the first ``n % k`` groups
    hold one row more."""
    q, r = divmod(n, k)
    big = r * (q + 1)
    return F.expr(f"CAST(CASE WHEN {index} < {big} THEN {index} div {q + 1} + 1 "
                  f"ELSE ({index} - {big}) div {max(q, 1)} + {r + 1} END AS INT)")


def split_ids(ids: DataFrame, k: int, id_col: str = "id") -> DataFrame:
    """PART-1: every distinct id in exactly one of k groups of sizes that
    differ by at most one, in id order.

    Raises like the original: an empty list, or more groups than ids.  The ids
    are made distinct once; count and numbering read the checkpointed result.
    """
    indexed = row_index(ids.select(id_col).distinct(), id_col, "_i")
    n = indexed.count()
    if n == 0:
        raise ValueError("expecting a non-empty list of ids")
    if k > n:
        raise ValueError(f"cannot make {k} groups from {n} ids")
    return indexed.select(id_col, ntile_of("_i", n, k).alias("part"))


def place_groups(df: DataFrame, groups: DataFrame, k: int, id_col: str = "id",
                 part: str = "part") -> DataFrame:
    """PART-1 as work placement: ``df`` with its group number (from ``split_ids``), and
    group g of k in task g - 1, so no two groups share a task and none is cut.

    Rows whose id is in no group are dropped, as they have no place.  Groups are as
    large as the split makes them; for work that may be cut anywhere use ``place_by_key``
    or none of the two."""
    placed = df.join(groups.select(F.col(id_col), F.col(part)), id_col)
    return placed.repartitionById(k, F.col(part) - 1)


def place_by_key(df: DataFrame, k: int, key: str = "channel") -> DataFrame:
    """k tasks, all rows of a key in one of them; keys may share a task."""
    return df.repartition(k, key)
