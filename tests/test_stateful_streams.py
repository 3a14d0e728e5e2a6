"""Keyed progress, route windows, counters, merged responses and state checks of streams."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from sievery.operators import routing, sieve
from sievery.plans import catalog as Q
from sievery.sinks import delivery
from sievery.sources import pages
from sievery.sources import tables as T
from sievery.streaming import counters, progress, state, streams

SMALL = "/root/testdata/sf0.001"
EVENTS = "channel string, us long"
HOUR = 3_600_000_000


def land(spark, path, rows):
    df = spark.createDataFrame(rows, EVENTS).withColumn("event_time", F.timestamp_micros("us"))
    df.coalesce(1).write.mode("append").parquet(path)


def stream_of(spark, path, max_files=1000):
    schema = "channel string, us long, event_time timestamp"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


# ---------------------------------------------------------------- progress

def told(spark, out):
    return {r.channel: (r.last_us, r.messages, r.restarts, r.silent)
            for r in progress.latest_progress(spark, out).collect()}


def test_progress_survives_restarts_and_tells_of_silence(spark, tmpdir_path):
    path, out = tmpdir_path + "/in", tmpdir_path + "/out"
    listing = spark.createDataFrame([("A",), ("A",), ("Z",)], "id string")

    def run(n):
        progress.run_progress(spark, stream_of(spark, path), out, n, listing=listing, silence="1 hour",
                              watermark="10 minutes")
    land(spark, path, [("A", HOUR), ("A", 2 * HOUR), ("B", HOUR + 5), (None, 9 * HOUR), ("C", 5 * HOUR)])
    run(0)
    assert told(spark, out) == {"A": (2 * HOUR, 2, 0, True), "B": (HOUR + 5, 1, 0, True),
                                "C": (5 * HOUR, 1, 0, False), "Z": (None, 0, 0, True)}
    run(1)                                                # nothing new: nothing changes
    assert told(spark, out)["A"] == (2 * HOUR, 2, 0, True)
    land(spark, path, [("A", 5 * HOUR + 7), ("Z", 6 * HOUR), ("D", 6 * HOUR + 1)])
    run(2)
    assert told(spark, out) == {"A": (5 * HOUR + 7, 3, 1, False), "B": (HOUR + 5, 1, 0, True),
                                "C": (5 * HOUR, 1, 0, False), "Z": (6 * HOUR, 1, 0, False),
                                "D": (6 * HOUR + 1, 1, 0, False)}
    land(spark, path, [("D", 9 * HOUR)])
    run(3)
    assert told(spark, out) == {"A": (5 * HOUR + 7, 3, 1, True), "B": (HOUR + 5, 1, 0, True),
                                "C": (5 * HOUR, 1, 0, True), "Z": (6 * HOUR, 1, 0, True),
                                "D": (9 * HOUR, 2, 1, False)}


def test_a_hot_channel_is_reduced_before_it_is_keyed():
    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"channel": ["A"] * 999 + ["B"], "us": list(range(1000))})
    got = [b.to_pylist() for b in progress._reduced(iter([batch, batch.slice(0, 0)]))]
    assert got == [[{"channel": "A", "us": 998, "n": 999}, {"channel": "B", "us": 999, "n": 1}]]


def test_the_state_provider_is_set_for_the_query_only(spark):
    before = spark.conf.get(progress.PROVIDER)
    with pytest.raises(ValueError), progress.keyed_state(spark):
        assert spark.conf.get(progress.PROVIDER) == progress.ROCKSDB
        raise ValueError
    assert spark.conf.get(progress.PROVIDER) == before


# ---------------------------------------------------------------- route windows

def test_route_windows_equal_batch_over_many_files_and_a_restart(spark, tmpdir_path):
    routes = Q._routes(spark, SMALL).select(F.col("id").alias("channel"), "route")
    path, out = Q._event_files(spark, SMALL, 4), tmpdir_path + "/out"
    first, second = tmpdir_path + "/in", sorted(os.listdir(path))
    os.makedirs(first)

    def run():
        return streams.stream_route_windows(spark, routes, size="1 hour", slide="15 minutes", watermark="1 day",
                                            path=first, max_files=1, out=out)
    files = [f for f in second if f.endswith(".parquet")]
    for part in (files[:2], files[2:]):
        for f in part:
            shutil.copy2(f"{path}/{f}", first)
        got = run()
    m = T.load_messages(spark, SMALL).select("channel", "event_time")
    mark = m.agg(F.max(F.unix_micros("event_time"))).first()[0] - 86_400_000_000
    batch = routing.routed_pane_windows(m, routes, "event_time", "1 hour", "15 minutes").filter(
        F.unix_micros(F.col("window.end")) <= mark)
    want = sorted((r.window.start, r.route, r.n, r.n_items) for r in batch.collect())
    assert sorted((r.window.start, r.route, r.n, r.n_items) for r in got.collect()) == want and want


# ---------------------------------------------------------------- counters

def test_counters_of_all_batches_and_late_rows(spark, tmpdir_path):
    path = tmpdir_path + "/in"
    land(spark, path, [("A", 10 * HOUR + k) for k in range(50)])

    def run(listener):
        df = counters.observe_counters(stream_of(spark, path, 1), n=F.count(F.lit(1)),
                                       a=F.count_if(F.col("channel") == "A"))
        w = df.withWatermark("event_time", "10 minutes").groupBy(F.window("event_time", "1 hour"), "channel").count()
        counters.run_counted(spark, w.writeStream.format("parquet").queryName("counted").option(
            "path", tmpdir_path + "/out").option("checkpointLocation", tmpdir_path + "/ck"), listener)
    first = counters.StreamCounters("counted")
    run(first)
    assert first.totals() == {"n": 50, "a": 50, "late_rows": 0}
    land(spark, path, [("A", HOUR), ("B", HOUR), ("B", 11 * HOUR)])             # two windows are long closed
    second = counters.StreamCounters("counted")
    run(second)
    assert second.totals() == {"n": 3, "a": 1, "late_rows": 2}
    assert min(second.batches()) > max(first.batches())
    other = counters.StreamCounters("another")
    land(spark, path, [("B", 12 * HOUR)])
    with pytest.raises(AssertionError):
        run(other)
        assert other.totals()                                                    # not its query


def test_a_replayed_batch_replaces_its_counters_and_old_ones_are_folded():
    c = counters.StreamCounters(keep=2)
    for batch, n in ((0, 5), (1, 7), (1, 8), (2, 1), (3, 2)):
        c.note(batch, {"n": n})
    assert c.totals() == {"n": 16} and c.batches() == {2: {"n": 1}, 3: {"n": 2}}
    c.note(3, {"n": 4})
    assert c.totals() == {"n": 18}
    c._open.add("r")
    with pytest.raises(TimeoutError):
        c.wait("r", 0.01)


# ---------------------------------------------------------------- merged responses

def response(path, name, docs):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write("".join(json.dumps(d) + "\n" for d in docs))


def test_teams_and_emojis_merge_as_in_batch(spark, tmpdir_path):
    second, team, emoji = 1_000_000, tmpdir_path + "/team", tmpdir_path + "/emoji"
    base = 1_700_000_000 * second

    def t(i, at):
        return {"ok": True, "team": {"id": i, "name": f"n{i}", "domain": "d"}, "landed": base + at * second}

    def e(i, at, *names):
        return {"ok": True, "team_id": i, "landed": base + at * second,
                "emoji": {n: ("alias:x" if n[0] == "a" else "http://u") for n in names}}
    response(team, "1", [t("T1", 0), t("T2", 10), t("T3", 20), t("T4", 30), {"ok": False, "error": "no"}])
    response(emoji, "1", [e("T1", 5, "x", "y", "ax"), e("T1", 120, "z"), e("T2", 131, "x"), e("T9", 5, "x")])
    response(team, "2", [t("", 90_000)])
    response(emoji, "2", [e("T4", 31, "ax"), e("T4", 29, "x"), e("T3", 80_000, "x"), e("T8", 90_000, "x")])
    want = [("T1", 4, 1), ("T2", 0, 0), ("T3", 0, 0), ("T4", 1, 1)]
    got = streams.stream_team_info(spark, team, emoji, max_files=1, watermark="2 hours").collect()
    assert sorted((r.team_id, r.n_emojis, r.n_aliases) for r in got) == want
    from sievery import schemas
    batch = streams.team_totals(streams.merge_team_info(
        pages.team_responses(spark.read.schema(schemas.TEAM_PAGE).json(team)),
        pages.emoji_responses(spark.read.schema(schemas.EMOJI_PAGE).json(emoji))))
    assert sorted((r.team_id, r.n_emojis, r.n_aliases) for r in batch.collect()) == want


# ---------------------------------------------------------------- state

def test_damaged_state_raises_before_a_restart(spark, tmpdir_path):
    out = tmpdir_path + "/out"
    Q._route_stream(spark, SMALL, out)
    ck, parts = out + "/checkpoint", state.state_operators(spark, out + "/checkpoint").first()["partitions"]
    want = {"stateStoreSave": 2}
    assert state.check_state(spark, ck, want, parts) > 0
    assert state.state_keys(spark, ck, 1).columns == ["partition", "key", "value"]
    with pytest.raises(state.StateError, match="needs"):
        state.check_state(spark, ck, {"stateStoreSave": 1}, parts)               # more than expected
    with pytest.raises(state.StateError, match="needs"):
        state.check_state(spark, ck, {"stateStoreSave": 2, "dedupe": 1}, parts)  # fewer
    with pytest.raises(state.StateError, match="partitions"):
        state.check_state(spark, ck, want, parts + 1)
    lost = tmpdir_path + "/lost"
    shutil.copytree(ck, lost)
    shutil.rmtree(lost + "/state/1/0")
    with pytest.raises(state.StateError, match="cannot be read"):
        state.check_state(spark, lost, want, parts)
    bare = tmpdir_path + "/bare"
    shutil.copytree(ck, bare)
    shutil.rmtree(bare + "/state")
    with pytest.raises(state.StateError):
        state.check_state(spark, bare, want, parts)
    with pytest.raises(state.StateError):
        state.check_state(spark, tmpdir_path + "/none", want, parts)


def test_keyed_state_is_told_of(spark, tmpdir_path):
    land(spark, tmpdir_path + "/in", [("A", HOUR), ("B", HOUR)])
    progress.run_progress(spark, stream_of(spark, tmpdir_path + "/in"), tmpdir_path + "/out")
    with progress.keyed_state(spark):
        got = state.state_summary(spark, tmpdir_path + "/out/checkpoint").collect()
    assert [(r.store, r["keys"]) for r in got] == [("progress", 2)] and "transformWithState" in got[0].name


def test_printed_rows_are_lines_of_their_tasks(spark, tmpdir_path, capsys):
    df = spark.range(50).selectExpr("id", "cast(null AS string) AS s").repartition(3)
    delivery.print_sink(df, tmpdir_path + "/printed")
    lines = [json.loads(r.value) for r in spark.read.text(tmpdir_path + "/printed").collect()]
    assert sorted(x["id"] for x in lines) == list(range(50)) and all(x["s"] is None for x in lines)
    delivery.print_sink(df, preview=7)
    assert len(capsys.readouterr().out.splitlines()) == 7


def test_sieve_counters_name_every_category(spark):
    m = T.load_messages(spark, SMALL).limit(0)
    seen = counters.message_counters(m, sieve.is_notable())
    assert seen.columns == m.columns and isinstance(seen.schema, TY.StructType)
