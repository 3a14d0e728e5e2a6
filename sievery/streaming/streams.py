"""Streaming twins of the batch jobs (SRC-10, WM-1, ST-2, SNK-1 in a stream).

The same column functions run on ``readStream`` sources.  State (window
counts, de-duplication keys) lives in the query checkpoint under the shared
checkpoint folder, so a restarted query resumes from its last committed
micro-batch.  Outputs are written per batch id and are replay-safe.

Comparison law (tested): a stream over a bounded input emits exactly the
batch windows whose end is at or before the final watermark
(``max(event_time) - delay``); windows still open when the input ends are
not emitted in append mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from .. import schemas
from ..functions import classify as Cl
from ..operators import dedup, sieve
from ..operators import payloads as P
from ..operators import routing as R
from ..session import scratch_path, table_path
from ..sinks.delivery import batch_sink, read_batches
from ..sources import pages as PG
from ..sources import tables as T

WATERMARK = "10 minutes"
MAX_FILES = 1000              # files of a micro-batch; size it to the cluster
PAYLOAD_COUNTS = TY.StructType([TY.StructField("n_items", TY.LongType())])


def read_event_stream(spark: SparkSession, sf_dir: str | None = None, max_files: int = MAX_FILES,
                      path: str | None = None) -> DataFrame:
    """SRC-10: the ``events`` table (or the files in ``path``) as a file stream
    (schema from the files), at most ``max_files`` files a batch, oldest first."""
    path = path or table_path(sf_dir, "events")
    schema = spark.read.parquet(path).schema
    # A file source watches a folder or a glob; the table may be a single file,
    # so it is named through a one-name glob.
    pattern = path[:-1] + "[" + path[-1] + "]"
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
            .parquet(pattern))


def message_stream(spark: SparkSession, sf_dir: str | None = None, max_files: int = MAX_FILES,
                   path: str | None = None) -> DataFrame:
    """Canonical messages as a stream (the adapter is row-wise)."""
    return T.messages_from_events(read_event_stream(spark, sf_dir, max_files, path))


def _file_order(spark: SparkSession, path: str) -> DataFrame:
    """Event files with the time span of their rows and the latest time in any
    file that the stream reads before them (one row per file)."""
    us = T.micros_since_epoch("ts")
    meta = F.col("_metadata")
    files = (spark.read.parquet(path)
             .select(meta["file_path"].alias("file"),
                     meta["file_modification_time"].alias("landed"), us.alias("us"))
             .groupBy("file", "landed").agg(F.min("us").alias("low"), F.max("us").alias("high")))
    earlier = Window.orderBy("landed", "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("seen", F.max("high").over(earlier))


def lateness(spark: SparkSession, path: str) -> int:
    """Microseconds by which the files in ``path`` overlap in time: the longest
    that a row lies behind the latest row of an earlier file."""
    return int(_file_order(spark, path).agg(
        F.max(F.greatest(F.lit(0), F.col("seen") - F.col("low")))).first()[0] or 0)


def late_rejects(spark: SparkSession, path: str, watermark: str) -> DataFrame:
    """LOG-1: the rows that a stream of one file a batch would drop as late at
    this watermark, as rejects."""
    behind = _file_order(spark, path).filter("seen IS NOT NULL").select(
        "file", (F.col("seen") - R.micros(watermark)).alias("mark"))
    rows = spark.read.parquet(path).select(
        "event_id", T.micros_since_epoch("ts").alias("us"), F.col("_metadata.file_path").alias("file"))
    return rows.join(behind, "file").filter("us < mark").select(
        F.lit("late").alias("source"), F.col("event_id").cast("string").alias("key"),
        F.concat(F.lit("older than the watermark by "), (F.col("mark") - F.col("us")).cast("string"),
                 F.lit(" microseconds")).alias("reason"))


def windowed_counts(messages: DataFrame, size: str = "1 hour", slide: str = "15 minutes",
                    watermark: str = WATERMARK) -> DataFrame:
    """WM-1 + WIN-1: messages per sliding window and category; late rows
    (older than the watermark) are dropped, a window is final once the
    watermark passes its end."""
    return (messages.withWatermark("event_time", watermark)
            .groupBy(F.window("event_time", size, slide).alias("window"), "category")
            .agg(F.count("*").alias("n")))


def routed_window_counts(messages: DataFrame, routes: DataFrame, size: str = "1 hour",
                         slide: str = "15 minutes", watermark: str = WATERMARK) -> DataFrame:
    """WM-1 + WIN-1 + RT-1: messages and channels per sliding window and route, exact.

    Two stateful aggregates in a row: per window and channel, then, behind a join
    with the static ``routes`` (channel, route; channels without one are dropped),
    per window and route.  The first one's state has a row per channel of an open
    window, so the number of channels is counted and not estimated, and the second
    one sees every channel of a window when the watermark closes it."""
    per = (messages.withWatermark("event_time", watermark)
           .groupBy(F.window("event_time", size, slide).alias("window"), "channel")
           .agg(F.count("*").alias("n")))
    return (per.join(routes.select("channel", "route"), "channel").groupBy("window", "route")
            .agg(F.sum("n").alias("n"), F.count("*").alias("n_items")))


def stream_route_windows(spark: SparkSession, routes: DataFrame, sf_dir: str | None = None,
                         size: str = "1 hour", slide: str = "15 minutes", watermark: str = WATERMARK,
                         path: str | None = None, max_files: int = MAX_FILES,
                         out: str | None = None) -> DataFrame:
    """JOB-5 as a stream: the closed windows per route, read back from its sink (pass
    ``out`` to resume).  The routes are written once, every batch reads them."""
    from ..sinks.delivery import write_batch
    out = out or scratch_path(spark, "stream-route-windows")
    routes.select("channel", "route").write.mode("overwrite").parquet(out + "/routes")
    w = routed_window_counts(message_stream(spark, sf_dir, max_files, path),
                             spark.read.parquet(out + "/routes"), size, slide, watermark)
    q = (w.writeStream.foreachBatch(lambda df, batch: write_batch(df, out + "/data", batch)).outputMode("append")
         .option("checkpointLocation", out + "/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return read_batches(spark, out + "/data", w.schema)


def merge_team_info(teams: DataFrame, emojis: DataFrame, limit: str = "2 minutes",
                    watermark: str = WATERMARK) -> DataFrame:
    """SRC-3 on responses as they come: each team response (id, ..., landed) with the
    emoji responses (team_id, n_emojis, n_aliases, landed) that came within ``limit``
    after it, or none.

    ``landed`` is the time at which a response came.  In a stream both sides have a
    watermark and the join a range of time, so a team waits for its emojis no longer
    than the limit and then comes out without any, and the state is bounded by what
    comes within limit and watermark.  The same function works in batch."""
    if teams.isStreaming:
        teams, emojis = teams.withWatermark("landed", watermark), emojis.withWatermark("landed", watermark)
    e = emojis.select("team_id", "n_emojis", "n_aliases", F.col("landed").alias("emoji_landed"))
    # F-8 behind the watermark, which a team without an id moves on like any other response: a
    # condition on the time is not pushed below it
    teams = teams.filter("CASE WHEN landed IS NULL THEN false ELSE id <> '' END")
    within = F.expr(f"team_id = id AND emoji_landed >= landed AND emoji_landed <= landed + INTERVAL {limit}")
    return teams.join(e, within, "left").select(
        F.col("id").alias("team_id"), "name", "domain", "landed", "emoji_landed", "n_emojis", "n_aliases")


def stream_team_info(spark: SparkSession, team_path: str, emoji_path: str, limit: str = "2 minutes",
                     watermark: str = WATERMARK, max_files: int = MAX_FILES,
                     out: str | None = None) -> DataFrame:
    """JOB-4 as a stream over landed team and emoji pages: per team response its emojis and
    aliases, summed over the emoji pages that came in time (0 where none did)."""
    from ..sinks.delivery import write_batch
    out = out or scratch_path(spark, "stream-team-info")

    def pages(schema, path):
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(path)
    merged = merge_team_info(PG.team_responses(pages(schemas.TEAM_PAGE, team_path)),
                             PG.emoji_responses(pages(schemas.EMOJI_PAGE, emoji_path)), limit, watermark)
    q = (merged.writeStream.foreachBatch(lambda df, batch: write_batch(df, out + "/data", batch))
         .outputMode("append").option("checkpointLocation", out + "/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return team_totals(read_batches(spark, out + "/data", merged.schema))


def team_totals(merged: DataFrame) -> DataFrame:
    """One row per team response from the rows of ``merge_team_info``."""
    return merged.groupBy("team_id", "name", "domain", "landed").agg(
        F.coalesce(F.sum("n_emojis"), F.lit(0)).cast("bigint").alias("n_emojis"),
        F.coalesce(F.sum("n_aliases"), F.lit(0)).cast("bigint").alias("n_aliases"))


def run_available(stream_df: DataFrame, out_path: str, checkpoint: str,
                  output_mode: str = "append") -> None:
    """Process everything available now into Parquet, then stop."""
    q = (stream_df.writeStream.format("parquet").outputMode(output_mode)
         .option("checkpointLocation", checkpoint).option("path", out_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def stream_windows(spark: SparkSession, sf_dir: str | None = None, size: str = "1 hour",
                   slide: str = "15 minutes", watermark: str = WATERMARK,
                   path: str | None = None, max_files: int = MAX_FILES) -> DataFrame:
    """Closed windows emitted by the stream, read back from its sink.

    ``watermark`` is how long a window waits for rows that come out of order; rows
    later than that are dropped (``late_rejects`` tells of them, ``lateness`` measures
    the overlap of files that are all there already).
    """
    out = scratch_path(spark, "stream-windows")
    w = windowed_counts(message_stream(spark, sf_dir, max_files, path), size, slide, watermark)
    run_available(w, out + "/data", out + "/checkpoint")
    return spark.read.schema(w.schema).parquet(out + "/data")


def stream_sieve(spark: SparkSession, sf_dir: str | None = None, path: str | None = None,
                 max_files: int = MAX_FILES) -> DataFrame:
    """Sieved messages, each once within the watermark of its arrival (ST-2),
    written per micro-batch by an idempotent ``foreachBatch`` sink; the sink's
    output, read back.  The clock is arrival, not event time, since the order in
    which files land says nothing about the age of their rows."""
    out = scratch_path(spark, "stream-sieve")
    notable = sieve.sieve(message_stream(spark, sf_dir, max_files, path)).withColumn(
        "_arrival", F.current_timestamp())
    rows = dedup.dedup_stream(notable, event_time="_arrival").select("channel", "category", "seq", "ts")
    q = (rows.writeStream.foreachBatch(batch_sink(out + "/data"))
         .option("checkpointLocation", out + "/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return read_batches(spark, out + "/data", rows.schema)


def stream_sieve_counts(spark: SparkSession, sf_dir: str | None = None, path: str | None = None,
                        max_files: int = MAX_FILES) -> DataFrame:
    """Counts of the stream's notable output per channel and category."""
    kept = stream_sieve(spark, sf_dir, path, max_files)
    return kept.groupBy("channel", "category").agg(F.count("*").alias("n_kept"))


def read_page_stream(spark: SparkSession, path: str, max_files: int = MAX_FILES) -> DataFrame:
    """SRC-10 on landed history pages: the folder is watched and new page
    files are read as they land."""
    return (spark.readStream.schema(schemas.HISTORY_PAGE)
            .option("maxFilesPerTrigger", max_files).json(path)
            .withColumns({"_page": F.col("_metadata.file_path"),
                          "_block": F.col("_metadata.file_block_start")}))


def stream_rejected_texts(spark: SparkSession, pages_path: str, out: str | None = None,
                          max_files: int = MAX_FILES) -> DataFrame:
    """LOG-1 of a page stream: what it sets aside, with the texts, written per batch id
    below ``out`` (pass it to resume) and read back."""
    out = out or scratch_path(spark, "stream-rejects")
    sink = batch_sink(out + "/rejects", build=PG.rejected_texts)
    q = (read_page_stream(spark, pages_path, max_files).writeStream.foreachBatch(sink)
         .option("checkpointLocation", out + "/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return read_batches(spark, out + "/rejects", schemas.REJECTED_TEXTS)


def stream_posts(spark: SparkSession, pages_path: str, url_template: str,
                 channel_teams: DataFrame | None = None, team_id: str | None = None,
                 blacklist=(), deliver=None, chunk_size: int = 10_000,
                 watermark: str = WATERMARK, out: str | None = None,
                 chunk_by: str = "rank", max_files: int = MAX_FILES) -> str:
    """JOB-3 as a stream: pages -> classified messages (X-1, X-2) -> sieve (F-6)
    -> each notable message once within the watermark of arrival (ST-2) -> per
    batch: payloads (AGG-2) written per batch id; with ``deliver``, each payload
    is delivered and the responses checked (SNK-1, R-1, R-2).

    The sieve comes first: a message that lands plain and later with reactions
    is kept when it becomes notable, and the state holds notable keys only.
    Payloads hold at most ``chunk_size`` messages of a micro-batch.  Payloads and
    receipts are written per batch id; a replayed batch replaces its own output,
    and a batch with nothing notable writes empty ones.
    Returns the output folder (``payloads/``, ``receipts/`` and the
    ``checkpoint/`` a restarted run resumes from; pass ``out`` to resume).
    """
    out = out or scratch_path(spark, "stream-posts")
    msgs = Cl.with_category(Cl.drop_blacklisted(PG.valid_canonical(
        PG.wire_messages(read_page_stream(spark, pages_path, max_files))), blacklist))
    # History pages land channel by channel, so event time is out of order
    # across files and an event-time watermark would drop whole channels as
    # late.  Repeats come from re-landed pages, close in arrival time: the
    # de-duplication clock is the arrival time of the micro-batch.
    arrived = sieve.sieve(msgs).withColumn("_arrival", F.current_timestamp())
    notable = dedup.dedup_stream(arrived, event_time="_arrival", watermark=watermark).drop("_arrival")

    # The channel -> team lookup is a dimension derived from other tables;
    # it is written once per run to the shared folder and read by every
    # micro-batch, instead of being recomputed from its sources each time.
    teams = None
    if channel_teams is not None:
        teams_path = out + "/channel_teams"
        channel_teams.select("id", "team_id").write.mode("overwrite").parquet(teams_path)
        teams = spark.read.parquet(teams_path)

    def build(batch: DataFrame) -> DataFrame:
        return P.post_payloads(batch, url_template, team_id=team_id,
                               channel_teams=teams, chunk_size=chunk_size, chunk_by=chunk_by)

    sink = batch_sink(out + "/payloads", build=build, deliver=deliver,
                      receipts_path=out + "/receipts")
    q = (notable.writeStream.foreachBatch(sink)
         .option("checkpointLocation", out + "/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def stream_metrics(spark: SparkSession, out: str) -> DataFrame:
    """AGG-4 of a ``stream_posts`` run, per micro-batch: notable posts and
    payloads, from the stored payloads (also those of a run that failed later)."""
    stored = read_batches(spark, out + "/payloads", PAYLOAD_COUNTS)
    return stored.groupBy("batch_id").agg(F.sum("n_items").alias("mapper_posts"),
                                          F.count("*").alias("payloads"))
