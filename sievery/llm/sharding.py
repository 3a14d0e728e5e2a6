"""Sharding of documents by a two-pass external shuffle (operator 11, DataFrame functions only).

First pass: a seeded hash of a row's id, size and checksum scatters the rows
uniformly over buckets that fit in a task's memory.  Second pass: the rows of a
bucket are put in a fixed order, shuffled by Fisher-Yates with draws from a seeded
hash, and written in that order.  The buckets one after the other are one random
order of all rows, the same for the same rows and seed whatever the cluster; it is
cut into ``shards`` runs of equal length (law ``rows``), so shards differ by one row
at most, and a row's slot is its place in its shard.

Rows that agree in id, size and checksum hash alike: where there are more than
``COPIES`` of them, they are dealt over as many buckets as they need.  Which of such
equal rows comes first is then open, all else is not.

Defined results: a null text counts as empty (size 1); rows without an id and
repeated rows are placed like any other; all columns are kept whatever their names;
an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievery.llm.common import free_name, join_unique, materialize, text_or_empty

SHARDS, SEED, LAW = 16, 20241, "rows"
BUCKET_ROWS, BUCKET_BYTES = 1024, 4 << 20
COPIES = 256                  # rows alike that may share a bucket
BROADCAST_ROWS = 1_000_000    # of 16 bytes; larger tables are shuffled
SPAN = 4096                   # buckets whose starts one task adds up


def draw(*parts: Column | int) -> Column:
    """60 random bits from a hash of the parts."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]).cast("binary")), 1, 15),
                  16, 10).cast("long")


def text_size(text: str) -> Column:
    return (F.octet_length(text_or_empty(text)) + 1).cast("long")


def checksum(text: str) -> Column:
    return F.crc32(text_or_empty(text).cast("binary"))


def _keyed(docs: DataFrame, doc_id: str, text: str, seed: int) -> DataFrame:
    """key (id, size, crc), hash h and the whole row as ``rec``."""
    key = F.struct(F.col(doc_id).cast("long").alias("id"), text_size(text).alias("size"),
                   checksum(text).alias("crc"))
    rows = docs.select(key.alias("key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rec"))
    named = F.coalesce(F.col("key.id").cast("string"), F.lit("null"))
    return rows.withColumn("h", draw(seed, named, F.col("key.size"), F.col("key.crc")))


def _scattered(rows: DataFrame, bucket_rows: int, bucket_bytes: int) -> DataFrame:
    """``rows`` with their bucket."""
    alike = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sum("key.size").alias("b"))
    n, size, repeated = alike.agg(F.sum("n"), F.sum("b"), F.count_if(F.col("n") > COPIES)).first()
    n, size = int(n or 0), int(size or 0)
    buckets = max(1, -(-n // bucket_rows), -(-size // bucket_bytes))
    if not repeated:
        return rows.select("key", "rec", F.pmod("h", F.lit(buckets)).alias("bucket"))
    many = alike.filter(F.col("n") > COPIES).select(
        F.col("h").cast("string").alias("hs"), "n", F.ceil(F.col("n") / COPIES).alias("parts"))
    named = rows.withColumn("hs", F.col("h").cast("string"))
    if repeated <= BROADCAST_ROWS:
        found = named.join(F.broadcast(many.drop("n")), "hs", "left")
    else:
        found = join_unique(named, many, "hs", "n", n, how="left")
    part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce("parts", F.lit(1)))
    return found.select("key", "rec", F.pmod(F.col("h") + part, F.lit(buckets)).alias("bucket"))


def fisher_yates(order: Column, seed: int, bucket: Column) -> Column:
    """The array ``order`` of numbers, shuffled inside out: the k-th comes at a drawn place up to
    k, and what was there goes to the end."""
    drawn = F.transform(order, lambda x, k: F.struct(
        x.alias("x"), F.pmod(draw(seed, bucket, k), k + 1).cast("int").alias("at")))

    def insert(done: Column, new: Column) -> Column:
        at, n = new["at"], F.size(done)
        return F.when(at == n, F.concat(done, F.array(new["x"]))).otherwise(F.concat(
            F.slice(done, 1, at), F.array(new["x"]), F.slice(done, at + 2, n - at - 1),
            F.array(F.element_at(done, at + 1))))
    return F.aggregate(drawn, F.array().cast("array<int>"), insert)


def shuffled(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = SEED,
             bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """bucket, at (place in the bucket, from 0) and the row as ``rec``, in buckets that are written once."""
    rows = _scattered(_keyed(docs, doc_id, text, seed), bucket_rows, bucket_bytes)
    held = (rows.repartition("bucket").groupBy("bucket")
            .agg(F.collect_list(F.struct("key", "rec")).alias("recs")))
    order = F.transform(F.array_sort(F.transform("recs", lambda r, i: F.struct(r["key"].alias("key"), i.alias("i")))),
                        lambda x: x["i"])
    mixed = F.transform(fisher_yates(order, seed, F.col("bucket")), lambda i, at: F.struct(
        at.alias("at"), F.col("recs")[i]["rec"].alias("rec")))
    return materialize(held.select("bucket", F.inline(mixed)), "shuffled-buckets")


def starts(buckets: DataFrame) -> DataFrame:
    """bucket, first: the rows in all buckets before it.  Sums within spans of buckets, then over
    the spans, so that the one-task sum has a row per span only."""
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "span", F.expr(f"bucket div {SPAN}"))
    within = Window.partitionBy("span").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = sizes.groupBy("span").agg(F.sum("n").alias("m")).select(
        "span", F.coalesce(F.sum("m").over(across), F.lit(0)).alias("before"))
    return sizes.withColumn("own", F.coalesce(F.sum("n").over(within), F.lit(0))).join(spans, "span").select(
        "bucket", (F.col("own") + F.col("before")).alias("first"))


def shard(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text",
          seed: int = SEED, bucket_rows: int = BUCKET_ROWS, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All rows and columns of ``docs`` with a struct column ``place`` (shard, slot) under a free
    name, which is the last column."""
    if shards < 1:
        raise ValueError(f"shards must be at least 1, not {shards}")
    buckets = shuffled(docs, doc_id, text, seed, bucket_rows, bucket_bytes)
    sizes = materialize(starts(buckets), "bucket-starts")
    known, n = sizes.count(), buckets.count()
    at = buckets.join(F.broadcast(sizes) if known <= BROADCAST_ROWS else sizes, "bucket")
    place = F.col("first") + F.col("at")
    numbered = at.select("rec", place.alias("p"), F.expr(f"((first + at) * {shards}) div {max(n, 1)}").alias("s"))
    slot = F.col("p") - F.expr(f"(s * {n} + {shards - 1}) div {shards}")
    return numbered.select(*[F.col("rec")[c].alias(c) for c in docs.columns], F.struct(
        F.col("s").cast("int").alias("shard"), slot.cast("long").alias("slot")).alias(free_name(docs, "place")))


def write(placed: DataFrame, path: str) -> None:
    """Rows of ``shard`` as Parquet files below ``path/shard=k``, in the order of their slots."""
    own = placed.columns[-1]
    rows = placed.withColumns({"shard": F.col(own)["shard"], "slot": F.col(own)["slot"]}).drop(own)
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard").parquet(path)
