"""PART-1 splitting, AGG-2 payloads, RT-1/WIN-1 routing, X-4 emoji, ST-2."""

import json
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievery.functions import classify as C
from sievery.operators import dedup, emoji, payloads, routing, splitting


def _ids(spark, n):
    return spark.createDataFrame([(f"c{i:04d}",) for i in range(n)], "id string")


def _groups(df):
    rows = df.orderBy("id").collect()
    out = {}
    for r in rows:
        out.setdefault(r["part"], []).append(r["id"])
    return out


def test_split_errors(spark):
    with pytest.raises(ValueError):
        splitting.split_ids(_ids(spark, 10), 11)
    with pytest.raises(ValueError):
        splitting.split_ids(_ids(spark, 0), 1)


@pytest.mark.parametrize("n,k", [(10, 10), (10, 9), (5, 3), (37, 4), (1, 1)])
def test_split_laws(spark, n, k):
    g = _groups(splitting.split_ids(_ids(spark, n), k))
    assert sorted(g) == list(range(1, k + 1))                  # exactly k groups
    sizes = [len(g[i]) for i in sorted(g)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1    # each id once, balanced
    flat = [x for i in sorted(g) for x in g[i]]
    assert flat == sorted(flat)                                # contiguous in id order
    q, r = divmod(n, k)
    assert sizes == [q + 1] * r + [q] * (k - r)                # same as SQL ntile


@settings(max_examples=8, deadline=None)
@given(st.sets(st.integers(0, 10_000), min_size=1, max_size=60), st.integers(2, 8))
def test_row_index_is_sorted_position(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = sorted((r["v"], r["rn"]) for r in splitting.row_index(df, "v", "rn", parts).collect())
    assert got == [(v, i) for i, v in enumerate(sorted(values))]


def _notable(spark, n_per_cat=3, channels=("C1", "C2")):
    rows = []
    seq = 0
    for ch in channels:
        for cat in C.CATEGORIES:
            for _ in range(n_per_cat):
                seq += 1
                raw = json.dumps({"type": "message", "ts": f"{seq}.0", "mentions": ["U1"]})
                rows.append((ch, cat, seq, f"{seq}.000000", "message", "t", raw))
    df = spark.createDataFrame(rows, "channel string, category string, seq bigint, ts string, "
                                     "type string, text string, raw string")
    for col, typ in [("subtype", "string"), ("user", "string"), ("username", "string"),
                     ("bot_id", "string"), ("comment", "string"), ("attachments", "string"),
                     ("file", "struct<id:string>"), ("comments", "array<struct<id:string,timestamp:bigint,user:string>>"),
                     ("reactions", "array<struct<name:string,users:array<string>,count:bigint>>"),
                     ("replies", "array<struct<ts:string,user:string>>")]:
        df = df.withColumn(col, F.lit(None).cast(typ))
    return df.withColumn("mentions", F.array(F.lit("U1")))


def test_payload_order_count_and_bound(spark):
    df = _notable(spark)
    p = payloads.post_payloads(df, "http://x/<team_id>/<channel_id>", team_id="T1", chunk_size=4)
    rows = p.collect()
    assert all(r["n_items"] <= 4 for r in rows)                               # bounded payloads
    assert sum(r["n_items"] for r in rows) == df.count()                       # nothing lost
    for r in rows:
        body = json.loads(r["body"])
        assert len(body) == r["n_items"]                                       # count = array length
        assert r["url"] == f"http://x/T1/{r['channel']}"
    one = payloads.post_payloads(df, "u", team_id="T1", chunk_size=10_000)
    for r in one.collect():
        items = json.loads(r["body"])
        kinds = [("subtype" in i, "file" in i) for i in items]
        assert len(items) == 15 and len(kinds) == 15
        assert r["first_seq"] < r["last_seq"]


def test_payload_category_order(spark):
    df = _notable(spark, n_per_cat=1, channels=("C1",))
    b = payloads.post_payloads(df, "u", team_id="T").first()
    a = payloads.channel_posts(df).first()
    seq_of = {r["seq"]: r["category"] for r in df.collect()}
    b_items = json.loads(b["body"])
    a_items = json.loads(a["record"])["posts"]
    assert len(b_items) == len(a_items) == 5
    ts_b = [seq_of[int(float(i["ts"]))] for i in b_items]
    ts_a = [seq_of[int(float(i["ts"]))] for i in a_items]
    assert ts_b == C.ORDER_B and ts_a == C.ORDER_A


def test_route_null_predicate_goes_to_lt(spark):
    df = spark.createDataFrame([("a", 10), ("b", 1), ("c", None)], "id string, num_members bigint")
    got = {r["id"]: r["route"] for r in routing.route_channels(df, 5).collect()}
    assert got == {"a": "gte", "b": "lt", "c": "lt"}


def test_sub_second_sliding_windows_multiply_rows(spark):
    df = spark.createDataFrame([("C1", "gte", 1_000_000)], "channel string, route string, us bigint")
    df = df.withColumn("event_time", F.timestamp_micros("us"))
    w = routing.routed_windows(df, "event_time", "1 second", "100 milliseconds")
    assert w.count() == 10 and w.agg(F.sum("n")).first()[0] == 10


def test_emoji_alias_statuses(spark):
    df = spark.createDataFrame([
        ("T1", "a", "http://a", None), ("T1", "b", None, "a"), ("T1", "c", None, "b"),
        ("T1", "d", None, "zz"), ("T2", "e", None, "a")],
        "team_id string, name string, url string, alias_of string")
    got = {r["name"]: (r["status"], r["resolved_url"]) for r in emoji.resolve_aliases(df).collect()}
    assert got == {"a": ("direct", "http://a"), "b": ("alias", "http://a"),
                   "c": ("unresolved_chain", None), "d": ("missing_target", None),
                   "e": ("missing_target", None)}


def test_dedup_replay_adds_nothing(spark):
    df = spark.createDataFrame([("C1", "1.0", 1), ("C1", "2.0", 2), ("C2", "1.0", 3)],
                               "channel string, ts string, seq int")
    assert dedup.dedup_messages(df.unionByName(df)).count() == 3


def test_union_categories_keeps_duplicates(spark):
    a = spark.createDataFrame([("C1", C.BOT, 1)], "channel string, category string, seq int")
    b = spark.createDataFrame([("C1", C.WHITELISTED, 1, "x")], "channel string, category string, seq int, raw string")
    u = payloads.union_categories(a, b, a)
    assert u.count() == 3 and sorted(r["category_ord"] for r in u.collect()) == [1, 1, 5]
    assert math.isclose(1, 1)


def test_hot_channel_payloads_stay_bounded(spark):
    # one channel holds a third of all rows
    rows = [("HOT" if i % 3 == 0 else f"C{i % 50}", i) for i in range(6000)]
    df = spark.createDataFrame(rows, "channel string, seq bigint")
    df = (df.withColumn("category", F.lit(C.BOT)).withColumn("type", F.lit("message"))
            .withColumn("text", F.lit("t")).withColumn("ts", F.col("seq").cast("string"))
            .withColumn("raw", F.lit(None).cast("string")))
    for col, typ in [("subtype", "string"), ("user", "string"), ("username", "string"),
                     ("bot_id", "string"), ("comment", "string"), ("attachments", "string"),
                     ("file", "struct<id:string>"),
                     ("comments", "array<struct<id:string,timestamp:bigint,user:string>>"),
                     ("reactions", "array<struct<name:string,users:array<string>,count:bigint>>"),
                     ("replies", "array<struct<ts:string,user:string>>")]:
        df = df.withColumn(col, F.lit(None).cast(typ))
    df = df.withColumn("mentions", F.array(F.lit("U1")))
    p = payloads.post_payloads(df, "u", team_id="T", chunk_size=250).cache()
    assert p.agg(F.max("n_items")).first()[0] <= 250
    assert p.filter("channel = 'HOT'").agg(F.sum("n_items")).first()[0] == 2000
    assert p.agg(F.sum("n_items")).first()[0] == 6000


def test_row_index_with_ties_uses_all_keys(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 0)], "k string, v int")
    got = sorted((r["k"], r["v"], r["rn"]) for r in splitting.row_index(df, ["k", "v"], "rn", 2).collect())
    assert got == [("a", 1, 0), ("a", 2, 1), ("b", 0, 2)]


def test_landed_messages_prune_days(spark):
    from sievery.session import scratch_path
    from sievery.sinks import tables as landing
    from sievery.sources import tables as T
    m = T.load_messages(spark, "/root/testdata/sf0.001")
    path = scratch_path(spark, "landed")
    landing.write_messages(m, path)
    landing.write_messages(m, path)                       # re-landing replaces, adds nothing
    assert landing.read_messages(spark, path).count() == m.count()
    one = landing.read_messages(spark, path, "2024-01-02", "2024-01-02")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    want = m.filter(F.expr(landing.DAY) == F.lit("2024-01-02").cast("date")).count()
    assert one.count() == want > 0


def test_collect_sorted_is_deterministic(spark):
    df = spark.createDataFrame([("w1", "C3", 3), ("w1", "C1", 1), ("w2", "C2", 2), ("w1", "C2", 2)],
                               "w string, ch string, n int")
    got = {r["w"]: r["items"] for r in payloads.collect_sorted(df, ["w"], F.col("ch"), ["n"]).collect()}
    assert got == {"w1": ["C1", "C2", "C3"], "w2": ["C2"]}


def test_split_sides_and_placement(spark):
    df = routing.route_channels(spark.createDataFrame(
        [("a", 10), ("b", 1), ("c", 7)], "id string, num_members bigint"), 5)
    gte, lt = routing.split(df)
    assert sorted(r["id"] for r in gte.collect()) == ["a", "c"]
    assert [r["id"] for r in lt.collect()] == ["b"]
    placed = splitting.place_by_key(df.withColumnRenamed("id", "channel"), 3)
    assert placed.rdd.getNumPartitions() == 3


def test_route_report_job(spark):
    from sievery.plans import jobs
    from sievery.sources import tables as T
    chans = T.load_channels(spark, "/root/testdata/sf0.001")
    msgs = T.load_messages(spark, "/root/testdata/sf0.001")
    routed, windows = jobs.route_report(chans, msgs, min_members=5)
    assert routed.filter("route = 'gte'").count() == chans.filter("num_members >= 5").count()
    # 1 s windows sliding by 100 ms: every message is in 10 windows
    assert windows.agg(F.sum("n")).first()[0] == 10 * msgs.join(
        routed.selectExpr("id AS channel"), "channel").count()


def test_reading_landed_messages_leaves_the_schema_alone(spark):
    from sievery import schemas
    from sievery.session import scratch_path
    from sievery.sinks import tables as landing
    from sievery.sources import tables as T
    path = scratch_path(spark, "landing-twice")
    landing.write_messages(T.load_messages(spark, "/root/testdata/sf0.001"), path)
    before = len(schemas.MESSAGES.fields)
    landing.read_messages(spark, path)
    assert landing.read_messages(spark, path).columns == schemas.MESSAGE_COLUMNS + ["day"]
    assert len(schemas.MESSAGES.fields) == before


def test_cluster_conf_scales_with_input():
    from sievery.session import cluster_conf
    small = cluster_conf(10 * 1024 ** 3, 8000)
    big = cluster_conf(100 * 1024 ** 4, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 24000          # three waves
    assert int(big["spark.sql.shuffle.partitions"]) == 409600           # 256 MB each
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 10**12)),
                min_size=1, max_size=80, unique_by=lambda t: t), st.integers(2, 6))
def test_rank_within_matches_brute_force(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, v bigint")
    got = sorted((r["k"], r["v"], r["rank"]) for r in
                 splitting.rank_within(df, "k", ["v"], "rank", parts).collect())
    want = []
    for k in sorted({r[0] for r in rows}):
        vs = sorted(v for kk, v in rows if kk == k)
        want += [(k, v, i) for i, v in enumerate(vs)]
    assert got == sorted(want)


def test_rank_chunks_are_contiguous_slices(spark):
    df = _notable(spark, n_per_cat=7, channels=("C1", "C2"))
    by_rank = payloads.post_payloads(df, "u", team_id="T", chunk_size=4, chunk_by="rank")
    rows = sorted(by_rank.collect(), key=lambda r: (r["channel"], r["chunk"]))
    assert all(r["n_items"] <= 4 for r in rows)
    whole = payloads.post_payloads(df, "u", team_id="T", chunk_size=10**6)
    for ch in ("C1", "C2"):
        pieces = [i for r in rows if r["channel"] == ch for i in json.loads(r["body"])]
        full = json.loads(whole.filter(F.col("channel") == ch).first()["body"])
        assert pieces == full                        # slices of the one ordered list


def test_rank_within_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), ("a", 5)], "k string, v int")
    got = sorted(((r["k"] or ""), r["v"], r["rank"])
                 for r in splitting.rank_within(df, "k", ["v"], "rank", 2).collect())
    assert got == [("", 1, 0), ("", 2, 1), ("a", 5, 0)]


def test_the_latest_version_of_a_message_stays(spark):
    rows = [("C1", "1.0", 5, "old"), ("C1", "1.0", 9, "new"), ("C1", "1.0", 9, "near"), ("C2", "1.0", 1, "x")]
    df = spark.createDataFrame(rows, "channel string, ts string, seq bigint, text string")
    for frame in (df, df.orderBy("text"), df.repartition(3)):
        got = dedup.dedup_messages(frame)
        assert got.columns == df.columns
        assert sorted(map(tuple, got.collect())) == [("C1", "1.0", 9, "new"), ("C2", "1.0", 1, "x")]


def test_rank_within_sums_a_weight(spark):
    df = spark.createDataFrame([("a", i, i + 1) for i in range(20)] + [("b", 1, 7)], "k string, v int, w bigint")
    got = splitting.rank_within(df, "k", ["v"], "rank", 4, weight="w", before="b4").collect()
    assert {(r["k"], r["v"]): (r["rank"], r["b4"]) for r in got} == {
        **{("a", i): (i, i * (i + 1) // 2) for i in range(20)}, ("b", 1): (0, 0)}


def test_durations():
    assert routing.micros("100 milliseconds") == 100_000 and routing.micros("1 hour") == 3_600_000_000
