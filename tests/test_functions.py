"""X-1 classify, X-2 blacklist, X-3 mentions, E-1..E-4/E-7 encoders,
STR-1 templates, R-1 responses."""

import json

from pyspark.sql import functions as F

from sievery.functions import classify as C
from sievery.functions import encode as E
from sievery.functions.jsonfields import extract_mentions
from sievery.functions.responses import response_status

MSG_SCHEMA = ("category string, type string, subtype string, text string, ts string, user string, "
              "username string, bot_id string, comment string, attachments string, "
              "file struct<id:string,title:string>, "
              "comments array<struct<id:string,timestamp:bigint,user:string>>, "
              "reactions array<struct<name:string,users:array<string>,count:bigint>>, "
              "replies array<struct<ts:string,user:string>>, mentions array<string>, raw string")


def _row(**kw):
    base = dict(category=None, type="message", subtype=None, text="hi", ts="1.000001", user=None,
                username=None, bot_id=None, comment=None, attachments=None, file=None, comments=[],
                reactions=[], replies=[], mentions=[], raw=None)
    base.update(kw)
    return base


def _encode(spark, kind, **kw):
    df = spark.createDataFrame([_row(**kw)], MSG_SCHEMA)
    return E.with_encoded(df, kind).first()["json"]


def test_classify_wire_kinds(spark):
    rows = [
        ("file_share", None, None, "file_share"),
        ("file_comment", None, None, "file_comment"),
        ("bot_message", "B1", None, "bot"),
        (None, "B1", '[{"a":1}]', "bot"),          # bot with attachments, no subtype
        ("bot_message", None, None, "bot"),
        (None, None, '[{"a":1}]', "user_attachment"),
        (None, None, "[]", "whitelisted"),
        (None, None, None, "whitelisted"),
        ("channel_join", None, None, "whitelisted"),
    ]
    df = spark.createDataFrame([r[:3] for r in rows], "subtype string, bot_id string, attachments string")
    got = [r["category"] for r in C.with_category(df).collect()]
    assert got == [r[3] for r in rows]


def test_blacklist_keeps_null_subtype(spark):
    df = spark.createDataFrame([("a",), (None,), ("channel_join",)], "subtype string")
    assert C.drop_blacklisted(df, ["channel_join"]).count() == 2
    assert C.drop_blacklisted(df, []).count() == 3


def test_mentions(spark):
    df = spark.createDataFrame([("hi <@U12> and <@W3|bob> not <@u1> <@U9|x>",), (None,), ("none",)], "t string")
    got = [r["m"] for r in df.select(extract_mentions(F.col("t")).alias("m")).collect()]
    assert got == [["U12", "W3", "U9"], None, []]


def test_encode_file_share_rules(spark):
    j = json.loads(_encode(spark, "file_share", subtype="file_share", user="U1",
                           file={"id": "F1", "title": "t"}, comment=""))
    assert list(j) == ["type", "subtype", "text", "file", "comments", "ts", "user", "bot_id"]
    assert j["bot_id"] is None and j["comments"] == [] and j["file"] == {"id": "F1", "title": "t"}
    j = json.loads(_encode(spark, "file_share", comment="c", mentions=["U2"]))
    assert list(j)[-4:] == ["comment", "user", "bot_id", "mentions"]


def test_encode_bot_rules(spark):
    j = json.loads(_encode(spark, "bot", subtype="bot_message", bot_id="B1",
                           attachments='[{"x":1}]', reactions=[{"name": "r", "users": ["U1"], "count": 1}]))
    assert list(j) == ["type", "subtype", "text", "ts", "bot_id", "attachments", "reactions"]
    assert j["attachments"] == [{"x": 1}]
    j = json.loads(_encode(spark, "bot", attachments="[]"))
    assert j["attachments"] == [] and "bot_id" not in j and "username" not in j


def test_encode_user_attachment_rules(spark):
    j = json.loads(_encode(spark, "user_attachment", user="U1", attachments="[]",
                           replies=[{"ts": "2.0", "user": "U3"}]))
    assert list(j) == ["type", "text", "ts", "user", "replies"]


def test_encode_file_comment_writes_everything(spark):
    j = json.loads(_encode(spark, "file_comment", subtype="file_comment"))
    assert list(j) == ["type", "subtype", "text", "user", "comment", "mentions", "reactions", "ts"]
    assert j["comment"] is None and j["mentions"] == [] and j["reactions"] == []


def test_encode_escapes_text(spark):
    j = json.loads(_encode(spark, "bot", text='say "hi"\n\\ done'))
    assert j["text"] == 'say "hi"\n\\ done'


def test_template_is_literal(spark):
    df = spark.createDataFrame([("T$1", "C\\2")], "t string, c string")
    got = df.select(E.fill_template("u/<team_id>/<channel_id>", team_id=F.col("t"),
                                    channel_id=F.col("c")).alias("u")).first()["u"]
    assert got == "u/T$1/C\\2"


def test_response_status(spark):
    bodies = {
        '{"received":1}': "OK", '{"received":0}': "OK",
        '{"message":[]}': "NOK", '{"message":[{"e":"x"}]}': "NOK",
        '{"errors":"x"}': "UNKNOWN", '{"received":null}': "UNKNOWN",
        '{"message":[1]}': "UNKNOWN", '{"received":"1"}': "UNKNOWN",
        '{"received":1.5}': "UNKNOWN", "not json": "UNKNOWN", '{"message":[{},2]}': "UNKNOWN",
    }
    df = spark.createDataFrame([(b,) for b in bodies], "b string")
    got = {r["b"]: r["s"] for r in df.select("b", response_status(F.col("b")).alias("s")).collect()}
    assert got == bodies


def test_nested_objects_keep_field_order(spark):
    # a VARIANT-based encoder would re-sort keys inside nested objects; the
    # fragment encoder keeps the struct order (title before id here)
    df = spark.createDataFrame([_row(category="file_share", subtype="file_share")], MSG_SCHEMA)
    df = df.withColumn("file", F.struct(F.lit("A").alias("title"), F.lit("Z").alias("id")))
    text = E.with_encoded(df, "file_share").first()["json"]
    assert '"file":{"title":"A","id":"Z"}' in text
    assert list(json.loads(text)["file"]) == ["title", "id"]
