"""Repeated rows, rows without a number, unreadable times and texts, rejected texts, placement."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sievery import schemas
from sievery.functions import classify as C
from sievery.functions.jsonfields import whole_json_sql
from sievery.operators import dedup, payloads, sieve, splitting
from sievery.plans import jobs
from sievery.sources import pages
from sievery.streaming import streams


def canonical(spark, rows):
    """(channel, seq, ts, raw) as whitelisted messages."""
    df = spark.createDataFrame(rows, "channel string, seq long, ts string, raw string")
    cols = []
    for f in schemas.MESSAGES.fields:
        cols.append(F.col(f.name) if f.name in df.columns else F.lit(C.WHITELISTED).alias("category")
                    if f.name == "category" else F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def raw(n):
    return json.dumps({"mentions": ["U1"], "n": n})


def items(p):
    return sorted((r.channel, x["n"]) for r in p.collect() for x in json.loads(r.body))


def test_repeated_rows_stay_as_many_as_they_are(spark):
    rows = [("C1", k % 10, "1.000001", raw(k % 10)) for k in range(100)] + [("C2", None, "2.0", raw(k)) for k in range(30)]
    p = payloads.post_payloads(canonical(spark, rows), "u/<team_id>/<channel_id>", team_id="T", chunk_size=7)
    assert items(p) == sorted((c, json.loads(t)["n"]) for c, _, _, t in rows)
    sizes = {}
    for r in p.collect():
        sizes.setdefault(r.channel, []).append((r.chunk, r.n_items))
    assert [n for _, n in sorted(sizes["C1"])] == [7] * 14 + [2]
    assert [n for _, n in sorted(sizes["C2"])] == [7] * 4 + [2]
    seqs = [json.loads(r.body) for r in sorted(p.filter("channel = 'C1'").collect(), key=lambda r: r.chunk)]
    assert [x["n"] for body in seqs for x in body] == sorted(k % 10 for k in range(100))


def test_a_null_channel_is_a_channel(spark):
    rows = [(None, k, f"{k}.0", raw(k)) for k in range(5)]
    p = payloads.channel_posts(canonical(spark, rows), chunk_size=2)
    assert sorted((r.chunk, r.n_items) for r in p.collect()) == [(0, 2), (1, 2), (2, 1)]


def test_seed_posts_takes_each_message_once(spark):
    m = canonical(spark, [("C1", k, f"{k}.000001", raw(k)) for k in range(20)])
    twice = m.unionByName(m.withColumn("seq", F.col("seq") + 100))
    p = jobs.seed_posts(twice, "u", team_id="T", chunk_size=6)
    assert items(p) == [("C1", k) for k in range(20)] and p.count() == 4
    assert len(items(jobs.seed_posts(twice, "u", team_id="T", once=False))) == 40


def test_messages_without_a_time_have_no_identity(spark):
    m = canonical(spark, [("C1", 1, None, raw(1)), ("C1", 2, None, raw(2)), ("C1", 1, None, raw(1)),
                          (None, 5, "1.0", raw(5)), (None, 6, "1.0", raw(6)), ("C1", 8, "1.0", raw(8)),
                          ("C1", 9, "1.0", raw(9))])
    kept = dedup.dedup_messages(m)
    assert sorted(json.loads(r.raw)["n"] for r in kept.collect()) == [1, 2, 5, 6, 9]
    assert kept.columns == m.columns


@pytest.mark.parametrize("text, whole", [
    ('{"mentions":["U1"]}', True), (' {"mentions":["U1"]} ', True), ('{"mentions":["U1"]} junk', False),
    ('{"mentions":["U1"]}] junk', False), ('{"mentions":["U1"]},"x":2', False), ('{"mentions":["U1"]}}', False),
    ('{"mentions":["U1"]}{"mentions":["U1"]}', False), ("", False), (None, False), ('{"mentions":["U1"]', False)])
def test_only_a_whole_value_is_notable_and_delivered(spark, text, whole):
    m = canonical(spark, [("C1", 1, "1.0", text), ("C1", 2, "2.0", raw(2))])
    assert m.filter(F.expr(whole_json_sql())).count() == 1 + whole
    p = payloads.post_payloads(sieve.sieve(m), "u", team_id="T").collect()
    assert len(json.loads(p[0].body)) == 1 + whole
    assert sieve.unparsable_rejects(m).count() == 1 - whole


LINES = ['{"ok":true,"channel":"C1","page":0,"messages":[{"ts":"oops","text":"a"},{"ts":"1.5","text":"b"},'
         '{"ts":"99999999999999.999999","text":"c"},{"text":"d"},"plain",{"ts":"","text":"e"}]}',
         '{"ok":true,"channel":"C2","messages":[{"ts":"17', "not json at all", '{"ok":false,"error":"invalid_auth"}',
         '{"channel":"C3"}']


def landed(path):
    os.makedirs(path)
    with open(path + "/a.json", "w") as f:
        f.write("\n".join(LINES[:2]) + "\n")
    with open(path + "/b.json", "w") as f:
        f.write("\n".join(LINES[2:]) + "\n")
    return path


EXPECTED = sorted([
    ("messages", "C1", "message has an unreadable ts", 0, '{"ts":"oops","text":"a"}'),
    ("messages", "C1", "message has an unreadable ts", 2, '{"ts":"99999999999999.999999","text":"c"}'),
    ("messages", "C1", "message is not a JSON object with a ts", 3, '{"text":"d"}'),
    ("messages", "C1", "message is not a JSON object with a ts", 4, "plain"),
    ("messages", "C1", "message has an unreadable ts", 5, '{"ts":"","text":"e"}'),
    ("history", None, "malformed page", 0, LINES[1]), ("history", None, "malformed page", 0, LINES[2]),
    ("history", None, "invalid_auth", 0, None), ("history", "C3", "malformed page", 0, None)], key=str)


def told(rows):
    assert all(r.file.endswith(".json") for r in rows)
    return sorted(((r.source, r.key, r.reason, r.position, r.text) for r in rows), key=str)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_unreadable_times_are_rejects_with_their_text(spark, tmpdir_path, ansi):
    path, before = landed(tmpdir_path + "/pages"), spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        messages, rejects = pages.read_conversations(spark, path)
        assert [(r.channel, r.ts, r.text) for r in messages.collect()] == [("C1", "1.5", "b")]
        assert rejects.columns == schemas.REJECTS.names and rejects.count() == len(EXPECTED)
        assert told(pages.rejected_texts(pages.history_pages(spark, path)).collect()) == EXPECTED
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_rejected_texts_of_a_stream_also_after_a_restart(spark, tmpdir_path):
    path, out = landed(tmpdir_path + "/pages"), tmpdir_path + "/out"
    assert told(streams.stream_rejected_texts(spark, path, out, max_files=1).collect()) == EXPECTED
    with open(path + "/c.json", "w") as f:
        f.write("{late\n")
    again = told(streams.stream_rejected_texts(spark, path, out, max_files=1).collect())
    assert again == sorted(EXPECTED + [("history", None, "malformed page", 0, "{late")], key=str)


def test_listing_pages_keep_their_faulty_lines_apart(spark, tmpdir_path):
    with open(tmpdir_path + "/u.json", "w") as f:
        f.write('{"ok":true,"members":[{"id":"U1","name":"a"}]}\n{"ok":true,"members":[{"id"\n')
    users, rejects = pages.read_users(spark, tmpdir_path)
    assert [r.id for r in users.collect()] == ["U1"]
    assert [r.reason for r in rejects.collect()] == ["malformed page"]


def test_each_group_has_a_task_of_its_own(spark):
    ids = spark.range(103).selectExpr("concat('U', id) AS id", "id AS v")
    groups = splitting.split_ids(ids, 7)
    placed = splitting.place_groups(ids, groups, 7).withColumn("task", F.spark_partition_id()).collect()
    assert len(placed) == 103 and {r.part - 1 for r in placed} == set(range(7))
    assert all(r.task == r.part - 1 for r in placed)
