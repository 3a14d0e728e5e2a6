"""Sinks (SNK, R-2), streaming twins (SRC-10, WM-1, ST-2) and replay safety."""

import json

import pytest
from pyspark.sql import functions as F

from sievery.operators import sieve
from sievery.plans import catalog as Q
from sievery.session import scratch_path
from sievery.sinks import delivery
from sievery.sources import tables as T
from sievery.streaming import streams

SMALL = "/root/testdata/sf0.001"


def _payloads(spark):
    m = T.load_messages(spark, SMALL)
    return Q.payloads.post_payloads(sieve.sieve(m), Q.URL_TEMPLATE,
                                    channel_teams=T.load_channels(spark, SMALL), chunk_size=200)


def test_deliver_ok(spark):
    p = _payloads(spark)
    receipts = delivery.deliver_payloads(p, delivery.accepting_service)
    assert delivery.check_receipts(receipts) == p.count()
    got = receipts.select("n_items", "response").collect()
    assert all(json.loads(r["response"])["received"] == r["n_items"] for r in got)


def test_deliver_refused_raises(spark):
    from sievery.operators import counts

    def refusing(url, body, key):
        return '{"message":[{"error":"no"}]}' if key < "8" else '{"received":1}'
    path = scratch_path(spark, "refused")
    delivery.write_batch(delivery.deliver_payloads(_payloads(spark), refusing), path, 0)
    receipts = spark.read.parquet(path)
    with pytest.raises(delivery.DeliveryError):
        delivery.check_receipts(receipts)
    refused = delivery.receipt_rejects(receipts).count()
    assert refused > 0
    got = {r["metric"]: r["value"] for r in counts.delivered_metrics(receipts).collect()}
    ok_items = receipts.filter("status = 'OK'").agg(F.sum("n_items")).first()[0] or 0
    assert got == {"sink_posts": ok_items, "sink_channels": 0, "sink_users": 0, "sink_teams": 0,
                   "refused_payloads": refused}


def test_deliver_exception_is_a_reject(spark):
    def broken(url, body, key):
        raise ConnectionError("cannot connect")
    receipts = delivery.deliver_payloads(_payloads(spark), broken)
    assert {r["status"] for r in receipts.collect()} == {"UNKNOWN"}


def test_write_batch_replay_is_idempotent(spark):
    path = scratch_path(spark, "replay")
    df = _payloads(spark)
    delivery.write_batch(df, path, 0)
    delivery.write_batch(df, path, 1)
    delivery.write_batch(df, path, 1)          # the replayed batch replaces itself
    out = spark.read.parquet(path)
    assert out.count() == 2 * df.count()
    assert out.filter("batch_id = 1").count() == df.count()


def test_stream_windows_equal_closed_batch_windows(spark):
    streamed = Q.q_stream_windows(spark, SMALL)
    m = T.load_messages(spark, SMALL)
    wm = m.agg(F.max("event_time")).first()[0]
    batch = (m.groupBy(F.window("event_time", Q.WINDOW_SIZE, Q.WINDOW_SLIDE).alias("w"), "category")
             .agg(F.count("*").alias("n"))
             .filter(F.col("w.end") <= F.lit(wm) - F.expr("INTERVAL 10 MINUTES"))
             .select(F.unix_seconds("w.start").alias("window_start"),
                     F.unix_seconds("w.end").alias("window_end"), "category", "n"))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_stream_sieve_equals_batch_sieve(spark):
    streamed = {(r["channel"], r["category"]): r["n_kept"] for r in Q.q_stream_sieve(spark, SMALL).collect()}
    batch = {(r["channel"], r["category"]): r["n_kept"]
             for r in Q.q_sieve_counts(spark, SMALL).filter("n_kept > 0").collect()}
    assert streamed == batch


def test_stream_restart_resumes_from_checkpoint(spark):
    out = scratch_path(spark, "restart")
    w = streams.windowed_counts(streams.message_stream(spark, SMALL))
    streams.run_available(w, out + "/data", out + "/ck")
    first = spark.read.parquet(out + "/data").count()
    w2 = streams.windowed_counts(streams.message_stream(spark, SMALL))
    streams.run_available(w2, out + "/data", out + "/ck")   # same checkpoint: nothing new
    assert spark.read.parquet(out + "/data").count() == first


def test_batch_sink_delivers_and_replays(spark):
    out = scratch_path(spark, "sink")
    sink = delivery.batch_sink(out + "/payloads", deliver=delivery.accepting_service,
                               receipts_path=out + "/receipts")
    p = _payloads(spark)
    sink(p, 3)
    sink(p, 3)                                              # replayed batch
    receipts = spark.read.parquet(out + "/receipts")
    assert receipts.count() == p.count()
    assert {r["status"] for r in receipts.collect()} == {"OK"}


def test_observed_metrics_fill_in_one_pass(spark):
    from sievery.operators import counts
    m = T.load_messages(spark, SMALL)
    per_channel = sieve.sieve(m).groupBy("channel").agg(F.count("*").alias("n"))
    observed, obs = counts.observe_metrics(per_channel, "mapper",
                                           channels=F.count("*"), posts=F.sum("n"))
    observed.write.format("noop").mode("overwrite").save()
    got = obs.get
    assert got["posts"] == sieve.sieve(m).count()
    assert got["channels"] == sieve.sieve(m).select("channel").distinct().count()


def test_stream_posts_relanded_pages_deliver_once(spark):
    import os
    import shutil
    from sievery.sources import landing
    m = T.load_messages(spark, SMALL)
    pages_path = scratch_path(spark, "pages-in")
    landing.land_history_pages(m, pages_path)
    chans = T.load_channels(spark, SMALL)
    out = streams.stream_posts(spark, pages_path, Q.URL_TEMPLATE, channel_teams=chans,
                               deliver=delivery.accepting_service)
    delivered = spark.read.parquet(out + "/receipts").agg(F.sum("n_items")).first()[0]
    assert delivered == _wire_notable(m)
    metrics = streams.stream_metrics(spark, out)
    assert metrics.agg(F.sum("mapper_posts")).first()[0] == delivered
    # the same pages land again under new file names: the resumed stream
    # reads them, and every message in them is a repeat
    for root, _, files in os.walk(pages_path):
        for f in files:
            if f.startswith("part-"):
                shutil.copy(os.path.join(root, f), os.path.join(root, "again-" + f))
    streams.stream_posts(spark, pages_path, Q.URL_TEMPLATE, channel_teams=chans,
                         deliver=delivery.accepting_service, out=out)
    assert spark.read.parquet(out + "/receipts").agg(F.sum("n_items")).first()[0] == delivered


def test_late_event_is_dropped_by_the_watermark(spark):
    base = scratch_path(spark, "late")
    src, out = base + "/in", base + "/out"
    events = spark.read.parquet(SMALL + "/events.parquet")
    events.write.parquet(src + "/a")
    latest = events.agg(F.max("ts")).first()[0]
    first_id = events.agg(F.min("event_id")).first()[0]

    def run():
        stream = spark.readStream.schema(events.schema).parquet(src + "/*")
        w = streams.windowed_counts(T.messages_from_events(stream))
        streams.run_available(w, out + "/data", out + "/ck")

    run()
    # then: one event 2 hours behind the watermark, one 3 hours ahead
    two = events.filter(F.col("event_id") == first_id).unionByName(
        events.filter(F.col("event_id") == first_id + 1))
    extra = two.withColumn("ts", F.when(F.col("event_id") == first_id,
                                        F.lit(latest) - F.expr("INTERVAL 2 HOURS"))
                           .otherwise(F.lit(latest) + F.expr("INTERVAL 3 HOURS")))
    extra.write.parquet(src + "/b")
    run()
    streamed = sorted((r["window"]["start"], r["category"], r["n"])
                      for r in spark.read.parquet(out + "/data").collect())

    def batch(rows):
        m = T.messages_from_events(rows)
        wm = m.agg(F.max("event_time")).first()[0]
        w = (m.groupBy(F.window("event_time", "1 hour", "15 minutes").alias("w"), "category")
             .agg(F.count("*").alias("n"))
             .filter(F.col("w.end") <= F.lit(wm) - F.expr("INTERVAL 10 MINUTES")))
        return sorted((r["w"]["start"], r["category"], r["n"]) for r in w.collect())

    on_time = events.unionByName(extra.filter(F.col("event_id") != first_id))
    assert streamed == batch(on_time)                      # late event dropped
    assert streamed != batch(events.unionByName(extra))    # it would have counted


def test_trailing_text_after_json_is_refused(spark):
    from sievery.operators import sieve as S
    df = spark.createDataFrame([('{"mentions":["U1"]} trailing',)], "raw string")
    # Spark's parser stops after the first complete value; such a text would
    # spoil the array it is delivered in, and a strict parser refuses it
    assert df.select(S.keep_whitelisted().alias("k")).first()["k"] is False


def test_stream_posts_rank_chunks(spark):
    from sievery.sources import landing
    m = T.load_messages(spark, SMALL)
    pages_path = scratch_path(spark, "pages-rank")
    landing.land_history_pages(m, pages_path)
    out = streams.stream_posts(spark, pages_path, Q.URL_TEMPLATE, team_id="T",
                               chunk_size=7, chunk_by="rank")
    p = spark.read.parquet(out + "/payloads")
    assert p.agg(F.max("n_items")).first()[0] <= 7
    assert p.agg(F.sum("n_items")).first()[0] == _wire_notable(m)


def _wire_notable(m):
    """Messages that are notable as read from pages: mentions come from the text."""
    return m.filter(sieve.is_notable() | F.expr(
        "category = 'whitelisted' AND try_parse_json(raw) IS NOT NULL AND size(mentions) > 0")).count()


def _land(spark, path, name, messages):
    import os
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        f.write(json.dumps({"ok": True, "channel": "C1", "messages": messages}) + "\n")


PLAIN = {"type": "message", "subtype": "bot_message", "bot_id": "B1", "username": "b", "text": "x",
         "ts": "1500000000.000100"}


def test_stream_with_nothing_notable_delivers_nothing(spark):
    base = scratch_path(spark, "quiet")
    _land(spark, base + "/in", "a.json", [PLAIN])
    out = streams.stream_posts(spark, base + "/in", Q.URL_TEMPLATE, team_id="T",
                               deliver=delivery.accepting_service, out=base + "/out")
    assert delivery.read_batches(spark, out + "/receipts", delivery.RECEIPTS).count() == 0
    assert streams.stream_metrics(spark, out).count() == 0
    # it lands again with a reaction: now it is notable, and delivered once
    reacted = {**PLAIN, "reactions": [{"name": "ok", "users": ["U1"], "count": 1}]}
    _land(spark, base + "/in", "b.json", [reacted])
    _land(spark, base + "/in", "c.json", [reacted])
    streams.stream_posts(spark, base + "/in", Q.URL_TEMPLATE, team_id="T",
                         deliver=delivery.accepting_service, out=out, max_files=1)
    assert [r["n_items"] for r in delivery.read_batches(
        spark, out + "/receipts", delivery.RECEIPTS).collect()] == [1]


def test_a_replay_without_rows_clears_its_batch(spark):
    path = scratch_path(spark, "cleared")
    df = _payloads(spark)
    delivery.write_batch(df, path, 0)
    delivery.write_batch(df.limit(0), path, 0)
    assert delivery.read_batches(spark, path, df.schema).count() == 0
    assert delivery.read_batches(spark, path + "-none", df.schema).count() == 0


def test_listings_are_delivered_and_refusals_raise(spark):
    for build in (Q._users, Q._channel_batches, Q._teams):
        p = build(spark, SMALL)
        assert p.filter("url LIKE '%<%' OR url NOT LIKE concat('%/', team_id, '%')").count() == 0
        path = scratch_path(spark, "listing")
        delivery.write_batch(delivery.deliver_payloads(p, lambda u, b, k: '{"message":[]}'), path, 0)
        with pytest.raises(delivery.DeliveryError):
            delivery.check_receipts(delivery.read_batch(spark, path, 0, delivery.RECEIPTS))


def test_streams_over_many_files_equal_one_file(spark):
    path = Q._event_files(spark, SMALL)
    assert spark.read.parquet(path).select("_metadata.file_path").distinct().count() == 8
    late = streams.lateness(spark, path)
    assert 0 < late < 86_400_000_000
    assert streams.late_rejects(spark, path, f"{late} microseconds").count() == 0
    assert streams.late_rejects(spark, path, "1 second").count() > 0
    one = sorted(map(tuple, Q.q_stream_sieve(spark, SMALL).collect()))
    assert sorted(map(tuple, Q.q_stream_sieve_files(spark, SMALL).collect())) == one
    w = streams.stream_windows(spark, SMALL, Q.WINDOW_SIZE, Q.WINDOW_SLIDE, "1 day").collect()
    many = Q.q_stream_windows_files(spark, SMALL).collect()
    assert sorted((r["window"]["start"].timestamp(), r["category"], r["n"]) for r in w) == sorted(
        (float(r["window_start"]), r["category"], r["n"]) for r in many)


def test_print_sink_prints_every_row(spark, capsys):
    delivery.print_sink(spark.range(30))
    assert len(capsys.readouterr().out.splitlines()) == 30


def test_checkpoint_folder_must_be_named_on_a_cluster():
    from types import SimpleNamespace

    from sievery.session import checkpoint_root
    conf = SimpleNamespace(get=lambda k, d=None: d)
    sc = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master="yarn")
    with pytest.raises(ValueError):
        checkpoint_root(SimpleNamespace(sparkContext=sc))
