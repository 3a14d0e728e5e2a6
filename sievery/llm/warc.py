"""WARC archives written and read back (operator 6).

``write`` makes a ``response`` record of every page (HTTP header and payload) and
``revisit`` records of equal payloads of at least ``LEAST_BYTES`` bytes, which
refer to the largest page id among them.  Files are plain text files of
Spark's writer whose line separator ends a record, so any Hadoop file system will do.

``read`` trusts no magic inside the files:

1. Splits are cut at the magic line; every cut is a candidate record.  Offsets
   are sums of the cuts' sizes, first per split, then over the file's splits.
2. A candidate with a valid header points to its successor's offset, which its
   Content-Length gives.  Within a split the pointers are followed to the first
   offset beyond it.
3. Pointer jumping over these split-to-split pointers, from the start of each
   file, doubles its reach every round; candidates that the chain does not visit
   are bytes of a payload and are rejected.
4. A record that spans several cuts gets its payload from all of them.

Defined results: null html is the empty payload; rows without an id never are the
copy that others refer to (if all copies lack one, all are responses); rows that
share id and payload are written as often as they occur; line ends in a url are
percent-encoded; other columns are never read; an empty table writes and reads nothing.
"""

from __future__ import annotations

from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievery.llm.common import materialize, spark_of, text_or_empty
from sievery.session import scratch_path

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
LEAST_BYTES = 1000
BROADCAST_PIECES = 200_000    # rows of a small side: at most about 50 MB


class ArchiveError(RuntimeError):
    """Raised when records that the chain reaches cannot be read."""


# ------------------------------------------------------------------ writing

def _header(*fields: tuple[str, Column | str]) -> Column:
    """Header lines; a field whose value is null is left out."""
    lines = []
    for name, value in fields:
        value = F.lit(value) if isinstance(value, str) else value.cast("string")
        lines.append(F.concat(F.lit(f"{name}: "), value))
    return F.concat_ws("\r\n", *lines)


def records(pages: DataFrame, page_id: str = "page_id", url: str = "url",
            html: str = "html") -> DataFrame:
    """(value): the text of one record per page, without the blank lines that end it."""
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
                        text_or_empty(html).alias("payload"))
    rows = rows.withColumn("n", F.octet_length("payload")).withColumn(
        "same", F.when(F.col("n") >= LEAST_BYTES, F.sha2("payload", 256)))
    kept = (rows.filter("same IS NOT NULL").groupBy("same")
            .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies"))
            .filter("copies > 1").select("same", "refers_to"))
    kept = materialize(kept, "warc-copies")
    if kept.count() <= BROADCAST_PIECES:              # checked; else the pages are shuffled
        kept = F.broadcast(kept)
    rows = rows.join(kept, "same", "left")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\n"), _header(
        ("Content-Type", "text/html; charset=utf-8"), ("Content-Length", F.col("n"))), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, "payload"))
    safe_url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = _header(
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        ("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
        ("WARC-Target-URI", safe_url),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1("payload"))),
        ("WARC-Refers-To", F.when(revisit, F.concat(
            F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", F.octet_length(block)))
    return rows.select(F.concat(F.lit(MAGIC), head, F.lit(END), block).alias("value"))


def write(pages: DataFrame, path: str | None = None, page_id: str = "page_id", url: str = "url",
          html: str = "html") -> str:
    """Write one record per page; returns the folder."""
    path = path or scratch_path(spark_of(pages), "warc")
    records(pages, page_id, url, html).write.option("lineSep", END).text(path)
    return path


# ------------------------------------------------------------------ candidates

def cuts(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, value): the files cut at every magic line, in order of ``at`` in a split."""
    meta = F.col("_metadata")
    return spark.read.option("lineSep", MAGIC).text(path).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")


def _field(head: Column, name: str) -> Column:
    value = F.regexp_extract(head, f"(?:^|\r\n){name}: *([^\r\n]*)", 1)
    return F.when(value != "", value)


def _number(text: Column) -> Column:
    return F.when(text.rlike("^[0-9]{1,18}$"), text.try_cast("long"))


def _page(text: Column) -> Column:
    return F.regexp_extract(F.coalesce(text, F.lit("")), "^<urn:page:(-?[0-9]+)>$", 1)


def parsed(cut: DataFrame, value: str = "value") -> DataFrame:
    """Adds the record's fields to a cut that starts with a valid header; others get nulls."""
    parts = F.split(F.col(value), END, 3)
    head, http, body = (F.get(parts, F.lit(i)) for i in range(3))
    length = _number(_field(head, "Content-Length"))
    kind = _field(head, "WARC-Type")
    head_bytes = (F.octet_length(head) + len(END)).cast("long")
    http_bytes = (F.octet_length(http) + len(END)).cast("long")
    valid = length.isNotNull() & kind.isNotNull() & (F.size(parts) > 1)
    payload = F.substring(F.encode(body, "utf-8"), F.lit(1), (length - http_bytes).cast("int"))
    return cut.select(
        *cut.columns, F.octet_length(value).cast("long").alias("size"),
        F.when(valid, head_bytes + length + len(END)).alias("wanted"), kind.alias("kind"),
        _page(_field(head, "WARC-Record-ID")).alias("id"),
        _page(_field(head, "WARC-Refers-To")).alias("refers"),
        F.regexp_replace(F.coalesce(_field(head, "WARC-Payload-Digest"), F.lit("")), "^sha1:", ""
                         ).alias("stated"),
        _number(_field(http, "Content-Length")).alias("http_length"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha1(payload).alias("digest"))


def located(cut: DataFrame) -> DataFrame:
    """Adds ``offset``, the place of the cut's magic line in its file (the text before the
    first magic line, normally nothing, gets a negative one), and ``to``, its successor's."""
    magic = len(MAGIC)
    blocks = cut.groupBy("file", "block").agg(F.sum(F.col("size") + magic).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = blocks.select("file", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("file", "block").orderBy("at").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = cut.withColumn("own", F.coalesce(F.sum(F.col("size") + magic).over(within), F.lit(0))
                            ).join(base, ["file", "block"])
    offset = F.col("base") + F.col("own") - magic
    return placed.withColumn("offset", offset).withColumn(
        "to", F.when(offset >= 0, offset + magic + F.col("wanted"))).drop("own", "base")


# ------------------------------------------------------------------ the chain

def _exits(rows: pd.DataFrame) -> pd.DataFrame:
    """The first offset beyond the split that each candidate's pointers lead to (-1: nowhere)."""
    rows = rows.sort_values("offset", ascending=False)
    ends: dict[int, int] = {}
    last = int(rows["offset"].iloc[0])
    for offset, to in zip(rows["offset"].tolist(), rows["to"].fillna(-1).astype("int64").tolist(),
                          strict=True):
        ends[offset] = to if to > last else ends.get(to, -1) if to > offset else -1
    return pd.DataFrame({"file": rows["file"].iloc[0], "offset": list(ends),
                         "to": list(ends.values())})


def entries(candidates: DataFrame) -> DataFrame:
    """(file, offset): the chain's first offset in every split it visits."""
    jump = materialize(candidates.select("file", "block", "offset", "to")
                       .groupBy("file", "block")
                       .applyInPandas(_exits, "file string, offset long, to long")
                       .filter("to >= 0"), "warc-jumps")
    reached = candidates.filter("offset = 0").select("file", "offset").distinct()
    count = 0
    while True:
        step = reached.join(jump, ["file", "offset"]).select("file", F.col("to").alias("offset"))
        reached = materialize(reached.union(step).distinct(), "warc-reached")
        now = reached.count()
        if now == count:
            return reached
        count = now
        nxt = jump.select("file", F.col("offset").alias("to"), F.col("to").alias("further"))
        jump = materialize(jump.join(nxt, ["file", "to"]).select(
            "file", "offset", F.col("further").alias("to")), "warc-jumps")


def _owners(rows: pd.DataFrame) -> pd.DataFrame:
    """The chain's record that each cut of a split belongs to (-1: one of an earlier split)."""
    rows = rows.sort_values("at")
    place, owner, out = -1, -1, []
    for offset, to, entry in zip(rows["offset"].tolist(),
                                 rows["to"].fillna(-1).astype("int64").tolist(),
                                 rows["entry"].tolist(), strict=True):
        if entry or (place >= 0 and offset == place):
            owner, place = offset, to
        out.append(owner)
    return rows.assign(owner=out)[["file", "block", "at", "offset", "owner"]]


@contextmanager
def fixed_splits(spark: SparkSession):
    """Within it, files are cut into the same splits whatever executors come or go."""
    key = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(before or spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)


def rejoined(spark: SparkSession, path: str, pieces: DataFrame, names: list[str]) -> DataFrame:
    """The records whose payload holds magic lines, put together from a second scan; ``pieces``:
    (file, offset, owner) of their cuts.  The place in the file tells cuts apart, as the splits
    may differ from the first scan's; a record that does not come out whole raises."""
    few = pieces.count()
    if not few:
        return spark.createDataFrame([], "file string, owner long, wanted long, kind string, id string, refers string, "
                                     "stated string, http_length long, payload_bytes long, digest string")
    if few <= BROADCAST_PIECES:                       # checked; else the text is shuffled to them
        pieces = F.broadcast(pieces)
    with fixed_splits(spark):
        sizes = cuts(spark, path).select("file", "block", "at", F.octet_length("value").cast("long").alias("size"),
                                         F.lit(None).cast("long").alias("wanted"))
        found = materialize(located(sizes).select("file", "block", "at", "offset").join(
            pieces, ["file", "offset"]), "warc-places")
        if few <= BROADCAST_PIECES:
            found = F.broadcast(found)
        parts = cuts(spark, path).join(found, ["file", "block", "at"])
        joined = parts.groupBy("file", "owner").agg(F.array_join(F.transform(F.sort_array(
            F.collect_list(F.struct("offset", "value"))), lambda p: p["value"]), MAGIC).alias("value"))
        out = materialize(parsed(joined).filter("size >= wanted").select("file", "owner", *names), "warc-rejoined")
    expected = pieces.select("file", "owner").distinct().count()
    if out.count() != expected:
        raise ArchiveError(f"{expected - out.count()} of {expected} records of {path} could not be put together")
    return out


def read(spark: SparkSession, path: str) -> DataFrame:
    """page_id, record_type, payload_bytes, payload_digest, refers_to, intact of every record.

    Size and digest of a response are those of the payload read (``intact``: they
    are what its header states); a revisit has no payload and takes the header's.
    """
    names = ["wanted", "kind", "id", "refers", "stated", "http_length", "payload_bytes", "digest"]
    cut = materialize(located(parsed(cuts(spark, path)).drop("value")), "warc-cuts")
    candidates = cut.filter("offset >= 0")
    entry = entries(candidates).withColumn("entry", F.lit(True))
    owned = materialize(
        candidates.select("file", "block", "at", "offset", "to").join(entry, ["file", "offset"], "left")
        .withColumn("entry", F.coalesce("entry", F.lit(False)))
        .groupBy("file", "block").applyInPandas(
            _owners, "file string, block long, at long, offset long, owner long"), "warc-owners")

    # cuts before a split's first record belong to the last record of an earlier split
    last = owned.groupBy("file", "block").agg(F.max("owner").alias("last"))
    carry = last.select("file", "block", F.max("last").over(
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ).alias("carry"))
    owner = F.when(F.col("owner") >= 0, F.col("owner")).otherwise(F.col("carry"))
    member = owned.join(carry, ["file", "block"]).select(
        "file", "block", "at", "offset", owner.alias("owner"))
    heads = member.filter("offset = owner").join(
        cut.select("file", "block", "at", "size", *names), ["file", "block", "at"])
    # a last record may be followed by what is no record
    whole = heads.filter("size >= wanted").select("file", "owner", *names)
    broken = heads.filter("size < wanted").select("file", "owner")
    pieces = materialize(member.join(broken, ["file", "owner"]).select("file", "offset", "owner"),
                         "warc-pieces")
    again = rejoined(spark, path, pieces, names)

    response = F.col("kind") == "response"
    return whole.union(again).select(
        F.col("id").try_cast("long").alias("page_id"),
        F.col("kind").alias("record_type"),
        F.when(response, F.col("payload_bytes")).otherwise(F.col("http_length")).alias("payload_bytes"),
        F.when(response, F.col("digest")).otherwise(F.col("stated")).alias("payload_digest"),
        F.col("refers").try_cast("long").alias("refers_to"),
        (~response | ((F.col("digest") == F.col("stated"))
                      & (F.col("payload_bytes") == F.col("http_length")))).alias("intact"))
