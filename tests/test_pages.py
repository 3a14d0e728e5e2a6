"""SRC-1..SRC-6 and SRC-9 on invented API pages written to a scratch folder."""

import json
import os

from pyspark.sql import functions as F

from sievery import schemas
from sievery.functions import classify as C
from sievery.operators import payloads, sieve
from sievery.sources import pages


def _write(folder, name, docs):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        for d in docs:
            fh.write(json.dumps(d) + "\n")


TOPIC = {"value": "t", "creator": "U1", "last_set": 0}


def _channel(i, n):
    return {"id": f"C{i}", "name": f"chan{i}", "is_channel": True, "created": 100 + i, "creator": "U1",
            "is_archived": False, "is_general": i == 0, "name_normalized": f"chan{i}",
            "is_shared": False, "is_org_shared": False, "is_member": True, "is_private": False,
            "is_mpim": False, "members": ["U1", "U2"], "topic": TOPIC, "purpose": TOPIC,
            "previous_names": [], "num_members": n, "unlinked": 0}


def test_channels_and_error_envelope(spark, tmpdir_path):
    _write(tmpdir_path, "p1.json", [
        {"ok": True, "channels": [_channel(0, 7), _channel(1, 2)], "response_metadata": {"next_cursor": ""}},
        {"ok": False, "error": "invalid_auth"}])
    chans, rej = pages.read_channels(spark, tmpdir_path)
    rows = sorted((r["id"], r["num_members"], len(r["members"])) for r in chans.collect())
    assert rows == [("C0", 7, 2), ("C1", 2, 2)]           # num_members is not size(members)
    assert [r["reason"] for r in rej.collect()] == ["invalid_auth"]


def test_users_lift_profile(spark, tmpdir_path):
    _write(tmpdir_path, "u.json", [{"ok": True, "offset": "U2", "members": [
        {"id": "U1", "team_id": "T1", "name": "ann", "deleted": False, "is_bot": False,
         "is_owner": True, "is_primary_owner": False, "is_admin": True,
         "profile": {"first_name": "Ann", "real_name": "Ann Example", "email": "ann@example.org",
                     "display_name": "ann", "image_72": "http://img/1"}}]}])
    users, rej = pages.read_users(spark, tmpdir_path)
    u = users.first()
    assert (u["first_name"], u["real_name"], u["email"], u["is_admin"]) == \
        ("Ann", "Ann Example", "ann@example.org", True)
    assert rej.count() == 0


def test_team_and_emoji(spark, tmpdir_path):
    team_dir = os.path.join(tmpdir_path, "team")
    emoji_dir = os.path.join(tmpdir_path, "emoji", "team_id=T9")
    _write(team_dir, "t.json", [{"ok": True, "team": {"id": "T9", "name": "Nine", "domain": "nine",
                                                      "email_domain": "nine.example",
                                                      "icon": {"image_132": "http://i/132"}}}])
    _write(emoji_dir, "e.json", [{"ok": True, "emoji": {"one": "http://e/1", "two": "alias:one",
                                                        "three": "http://e/3"}}])
    team, emojis, rej = pages.read_team_info(spark, team_dir, os.path.join(tmpdir_path, "emoji"))
    t = team.first()
    assert (t["id"], t["image_132"], t["n_emojis"]) == ("T9", "http://i/132", 3)
    got = {r["name"]: (r["team_id"], r["url"], r["alias_of"]) for r in emojis.collect()}
    assert got["two"] == ("T9", None, "one") and got["one"] == ("T9", "http://e/1", None)


def _history():
    return [
        {"type": "message", "user": "U1", "text": "look <@U2>", "ts": "1500000000.000100",
         "attachments": [{"fallback": "x", "id": 1}]},                                   # user attachment
        {"type": "message", "subtype": "bot_message", "bot_id": "B1", "username": "bot",
         "text": "plain bot", "ts": "1500000000.000200"},                               # bot, dropped
        {"type": "message", "bot_id": "B2", "user": "U3", "text": "bot att", "ts": "1500000000.000300",
         "attachments": [{"id": 2}], "reactions": [{"name": "ok", "users": ["U1"], "count": 1}]},  # bot kept
        {"type": "message", "subtype": "file_comment", "text": "nice", "ts": "1500000000.000400",
         "comment": {"id": "Fc1", "user": "U4", "comment": "nice", "timestamp": 1, "created": 1,
                     "reactions": [{"name": "+1", "users": ["U1"], "count": 1}]}},       # file comment kept
        {"type": "message", "subtype": "file_share", "user": "U5", "text": "file", "upload": True,
         "ts": "1500000000.000500", "file": {"id": "F1", "title": "doc", "mode": "hosted"}},  # dropped
        {"type": "message", "user": "U6", "text": "thread", "ts": "1500000000.000600",
         "replies": [{"user": "U7", "ts": "1500000001.000000"}]},                       # whitelisted kept
        {"type": "message", "subtype": "channel_join", "user": "U8", "text": "joined <@U9>",
         "ts": "1500000000.000700"},                                                   # blacklisted
    ]


def test_conversation_history_classify_and_sieve(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "channel=C5")
    _write(folder, "h.json", [{"ok": True, "messages": _history(), "has_more": False}])
    _write(os.path.join(tmpdir_path, "channel=C6"), "h.json", [{"ok": False, "error": "channel_not_found"}])
    msgs, rej = pages.read_conversations(spark, tmpdir_path, blacklist=["channel_join"])
    cats = {r["ts"]: r["category"] for r in msgs.collect()}
    assert cats == {"1500000000.000100": C.USER_ATTACHMENT, "1500000000.000200": C.BOT,
                    "1500000000.000300": C.BOT, "1500000000.000400": C.FILE_COMMENT,
                    "1500000000.000500": C.FILE_SHARE, "1500000000.000600": C.WHITELISTED}
    kept = sorted(r["ts"][-3:] for r in sieve.sieve(msgs).collect())
    assert kept == ["100", "300", "400", "600"]
    row = msgs.filter("ts = '1500000000.000100'").first()
    assert row["channel"] == "C5" and row["mentions"] == ["U2"] and row["seq"] == 1500000000000100
    assert json.loads(row["attachments"]) == [{"fallback": "x", "id": 1}]
    assert [r["reason"] for r in rej.collect()] == ["channel_not_found"]


def test_flat_history_keeps_everything(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "channel=C7")
    _write(folder, "h.json", [{"ok": True, "messages": _history()}])
    flat, _ = pages.read_history(spark, tmpdir_path)
    assert flat.count() == 7 and "category" not in flat.columns


def test_collections_sources(spark):
    from sievery.sources import collections
    df = collections.from_parallel_rows(spark, [("C1",), ("C2",), ("C3",)], "id string", 2, "id")
    assert df.rdd.getNumPartitions() == 2 and df.count() == 3


def test_land_and_read_pages_roundtrip(spark):
    from sievery.session import scratch_path
    from sievery.sources import tables as T
    m = T.load_messages(spark, "/root/testdata/sf0.001")
    path = scratch_path(spark, "pages-test")
    from sievery.sources import landing
    landing.land_history_pages(m, path, page_size=100)
    back, rej = pages.read_conversations(spark, path)
    broken = m.filter("category = 'whitelisted' AND try_parse_json(raw) IS NULL").count()
    assert back.count() + broken == m.count()
    assert rej.count() == broken                        # not-JSON messages are rejected
    a = sorted((r["channel"], r["category"]) for r in sieve.sieve(back).collect())
    # the pages carry no mentions; the reader adds those of the text, also where
    # the raw text nests its lists
    wire = m.filter(sieve.is_notable() | (F.expr(
        "category = 'whitelisted' AND try_parse_json(raw) IS NOT NULL AND size(mentions) > 0")))
    b = sorted((r["channel"], r["category"]) for r in wire.collect())
    assert a == b
    landed = pages.wire_messages(spark.read.schema(schemas.HISTORY_PAGE).json(path))
    assert landed.filter("m.mentions IS NOT NULL").count() == 0


def test_plain_posts_with_a_mention_are_kept(spark, tmpdir_path):
    posts = [{"type": "message", "user": "U1", "text": f"hi <@U2> {i}", "ts": f"{1500000000 + i}.000000"}
             for i in range(1000)]
    _write(tmpdir_path, "h.json", [{"ok": True, "channel": "C1", "messages": posts}])
    msgs, _ = pages.read_conversations(spark, tmpdir_path)
    kept = sieve.sieve(msgs)
    assert kept.count() == 1000
    raw = json.loads(kept.first()["raw"])
    assert raw["mentions"] == ["U2"] and raw["user"] == "U1"
    # unnumbered pages: payloads by count, whatever the time between the messages
    p = payloads.post_payloads(kept, "u", team_id="T", chunk_size=300)
    assert sorted(r["n_items"] for r in p.collect()) == [100, 300, 300, 300]
    by_bytes = payloads.post_payloads(kept, "u", team_id="T", max_bytes=10_000)
    assert by_bytes.agg(F.max(F.length("body"))).first()[0] < 10_500 and by_bytes.count() > 5
    assert by_bytes.agg(F.sum("n_items")).first()[0] == 1000
    assert by_bytes.select("chunk").distinct().count() == by_bytes.count()


def test_wire_mentions_win_over_the_text(spark, tmpdir_path):
    posts = [{"type": "message", "user": "U1", "text": "hi <@U2>", "ts": "1.000000", "mentions": []},
             {"type": "message", "user": "U1", "text": "hi <@U2>", "ts": "2.000000", "mentions": ["U3"]}]
    _write(tmpdir_path, "h.json", [{"ok": True, "channel": "C1", "messages": posts}])
    msgs, _ = pages.read_conversations(spark, tmpdir_path)
    assert {r["ts"]: json.loads(r["raw"])["mentions"] for r in msgs.collect()} == {
        "1.000000": [], "2.000000": ["U3"]}


def test_numbered_pages_give_dense_positions(spark, tmpdir_path):
    folder = os.path.join(tmpdir_path, "channel=C9")
    msgs = _history()
    _write(folder, "h.json", [{"ok": True, "page": 0, "messages": msgs[:4]},
                              {"ok": True, "page": 1, "messages": msgs[4:]}])
    back, _ = pages.read_history(spark, tmpdir_path)
    seqs = sorted(r["seq"] for r in back.collect())
    assert seqs == [0, 1, 2, 3, 1 << 32, (1 << 32) + 1, (1 << 32) + 2]


def test_malformed_page_is_a_reject(spark, tmpdir_path):
    os.makedirs(tmpdir_path, exist_ok=True)
    with open(os.path.join(tmpdir_path, "p.json"), "w") as fh:
        fh.write(json.dumps({"ok": True, "channels": [_channel(3, 4)]}) + "\n")
        fh.write('{"ok": true, "channels": [ {"id": "C4"\n')          # cut short
    chans, rej = pages.read_channels(spark, tmpdir_path)
    assert [r["id"] for r in chans.collect()] == ["C3"]
    assert [r["reason"] for r in rej.collect()] == ["malformed page"]


def test_team_id_and_empty_listing_flow(spark, tmpdir_path):
    from sievery.plans import jobs
    _write(tmpdir_path, "t.json", [{"ok": False, "error": "invalid_auth"}])
    ids, rej = pages.read_team_id(spark, tmpdir_path)
    assert ids.count() == 0 and rej.count() == 1
    # F-9: an empty listing flows through every job and yields nothing
    empty_users, _ = pages.read_users(spark, tmpdir_path)
    assert jobs.seed_users(empty_users, 10).count() == 0
    empty_msgs, _ = pages.read_conversations(spark, tmpdir_path)
    assert jobs.seed_posts(empty_msgs, "u/<team_id>/<channel_id>", team_id="T").count() == 0


def test_a_wire_message_is_parsed_once(spark, tmpdir_path, capsys):
    """However many conditions on its fields the sieve and the blacklist push down."""
    path = tmpdir_path + "/pages"
    texts = ['{"type":"message","ts":"1.000000","text":"a <@U1>","user":"U2"}', '{"ts":"x"}', "no", '{"type":"message"}',
             '{"type":"message","subtype":"channel_join","ts":"2.000000","mentions":["U3"]}']
    rows = [("C1", texts), ("C2", []), ("C3", [None, texts[0]])]
    page = spark.createDataFrame(rows, "channel string, messages array<string>").selectExpr(
        "true AS ok", "channel", "0L AS page", "messages")
    wire = pages.wire_messages(page)
    assert [(r.channel, r._pos, r.m and r.m.ts) for r in wire.orderBy("channel", "_pos").collect()] == [
        ("C1", 0, "1.000000"), ("C1", 1, "x"), ("C1", 2, None), ("C1", 3, None), ("C1", 4, "2.000000"),
        ("C3", 0, None), ("C3", 1, "1.000000")]
    kept = sieve.sieve(C.with_category(C.drop_blacklisted(pages.valid_canonical(wire), ["channel_join"])))
    assert sorted(r.channel for r in kept.collect()) == ["C1", "C3"]
    capsys.readouterr()
    kept.explain()
    assert capsys.readouterr().out.count("from_json") == 1
