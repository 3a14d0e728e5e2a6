"""Readers of landed chat API pages (SRC-1..SRC-6, SRC-9).

The original tool called the chat API page by page from the driver.  Here a
landing step (outside this package) stores each response body as one JSON
document; these readers turn a whole folder of pages into DataFrames in one
distributed scan.  Every reader returns ``(data, rejects)``: an error page
(``{"ok": false, "error": ...}``) yields no rows and one reject, never a
crash.  Pages may be written as JSON lines (default) or one document per
file (``multiline=True``).  The landing step puts a page's channel or team into
the page (``channel``, ``team_id``), so pages need no folder of their own.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import classify as C
from ..functions.jsonfields import extract_mentions


def _read(spark: SparkSession, path: str | list[str], schema, multiline: bool) -> DataFrame:
    return (spark.read.schema(schema).option("multiLine", multiline)
            .option("mode", "PERMISSIVE").json(path)
            .withColumns({"_page": F.input_file_name(),
                          "_block": F.col("_metadata.file_block_start")}))


def _rejects(pages: DataFrame, source: str) -> DataFrame:
    """SRC-9: one reject per page that is not ``ok``."""
    return (pages.filter(~F.coalesce(F.col("ok"), F.lit(False)))
            .select(F.lit(source).alias("source"), F.col("_page").alias("key"),
                    F.coalesce(F.col("error"), F.lit("malformed page")).alias("reason")))


def page_texts(pages: DataFrame, source: str) -> DataFrame:
    """SRC-9: as ``_rejects`` with the file, the start of the line's block in it and,
    for a line that is no page, its text (batch or stream)."""
    return (pages.filter(~F.coalesce(F.col("ok"), F.lit(False)))
            .select(F.lit(source).alias("source"), F.col("channel").alias("key"),
                    F.coalesce(F.col("error"), F.lit("malformed page")).alias("reason"),
                    F.col("_page").alias("file"), F.col("_block").alias("position"),
                    F.col(schemas.CORRUPT).alias("text")))


def _ok(pages: DataFrame) -> DataFrame:
    return pages.filter(F.col("ok"))


def read_channels(spark: SparkSession, path, multiline: bool = False):
    """SRC-1: every channel of every listing page."""
    pages = _read(spark, path, schemas.CHANNEL_PAGE, multiline)
    channels = _ok(pages).select(F.inline("channels"))
    return channels, _rejects(pages, "channels")


def read_users(spark: SparkSession, path, multiline: bool = False):
    """SRC-2: every member of every user page, profile fields lifted."""
    pages = _read(spark, path, schemas.USER_PAGE, multiline)
    wire = _ok(pages).select(F.inline("members"))
    p = F.col("profile")
    users = wire.select(
        "id", "team_id", "name", "deleted",
        p["first_name"].alias("first_name"),
        F.coalesce(p["real_name"], F.col("real_name")).alias("real_name"),
        p["last_name"].alias("last_name"), p["display_name"].alias("display_name"),
        p["email"].alias("email"), "is_bot", p["status_text"].alias("status_text"),
        p["status_emoji"].alias("status_emoji"), p["title"].alias("title"),
        p["skype"].alias("skype"), p["phone"].alias("phone"), "is_owner",
        "is_primary_owner", p["image_72"].alias("image_72"), "is_admin",
        p["bot_id"].alias("bot_id"), F.lit(None).cast("string").alias("user"),
    )
    return users, _rejects(pages, "users")


def read_team(spark: SparkSession, path, multiline: bool = False):
    """SRC-4: the team record (and its id) of every team page."""
    pages = _read(spark, path, schemas.TEAM_PAGE, multiline)
    t = F.col("team")
    team = _ok(pages).select(
        t["id"].alias("id"), t["name"].alias("name"), t["domain"].alias("domain"),
        t["email_domain"].alias("email_domain"),
        t["icon"]["image_132"].alias("image_132"))
    return team, _rejects(pages, "team")


def read_team_id(spark: SparkSession, path, multiline: bool = False):
    """SRC-4: only the team id of every team page (empty when the page is
    an error; the reason is in the rejects)."""
    team, rejects = read_team(spark, path, multiline)
    return nonempty_ids(team.select("id")), rejects


def nonempty_ids(df: DataFrame) -> DataFrame:
    return df.filter(F.col("id").isNotNull() & (F.col("id") != ""))


def read_emojis(spark: SparkSession, path, multiline: bool = False):
    """Emoji pages as rows (team_id, name, url, alias_of).

    The API's page carries no team id; the landing step adds it (``team_id``).
    A value ``alias:<name>`` is an alias, anything else
    a URL.
    """
    pages = _read(spark, path, schemas.EMOJI_PAGE, multiline)
    rows = _ok(pages).select(F.col("team_id").cast("string").alias("team_id"),
                             F.explode("emoji").alias("name", "value"))
    prefix = schemas.EMOJI_ALIAS_PREFIX
    is_alias = F.col("value").startswith(prefix)
    emojis = rows.select(
        "team_id", "name",
        F.when(~is_alias, F.col("value")).alias("url"),
        F.when(is_alias, F.substr(F.col("value"), F.lit(len(prefix) + 1))).alias("alias_of"))
    return emojis, _rejects(pages, "emoji")


def team_responses(pages: DataFrame) -> DataFrame:
    """SRC-4 with the time: id, name, domain, landed of the team pages, in batch or stream."""
    t = F.col("team")
    return _ok(pages).select(
        t["id"].alias("id"), t["name"].alias("name"), t["domain"].alias("domain"),
        F.timestamp_micros("landed").alias("landed"))


def emoji_responses(pages: DataFrame) -> DataFrame:
    """Per emoji page its team, number of emojis and of aliases among them, and time."""
    values = F.map_values("emoji")
    return _ok(pages).select(
        F.col("team_id").cast("string").alias("team_id"), F.size("emoji").cast("bigint").alias("n_emojis"),
        F.size(F.filter(values, lambda v: v.startswith(schemas.EMOJI_ALIAS_PREFIX))).cast("bigint").alias("n_aliases"),
        F.timestamp_micros("landed").alias("landed"))


def read_team_info(spark: SparkSession, team_path, emoji_path, multiline: bool = False):
    """SRC-3: team records merged with their emojis (one row per team with
    an emoji count; the emoji rows stay a separate, joinable table)."""
    team, team_rej = read_team(spark, team_path, multiline)
    emojis, emoji_rej = read_emojis(spark, emoji_path, multiline)
    per_team = emojis.groupBy("team_id").agg(F.count("*").alias("n_emojis"))
    merged = (team.join(per_team, team["id"] == per_team["team_id"], "left")
              .drop("team_id")
              .withColumn("n_emojis", F.coalesce("n_emojis", F.lit(0))))
    return merged, emojis, team_rej.unionByName(emoji_rej)


def ts_micros(ts):
    """``"<seconds>.<6 digits>"`` to epoch microseconds, exact (via decimal); null
    where the text is no such number."""
    return (ts.try_cast("decimal(20,6)") * F.lit(1000000)).try_cast("bigint")


def wire_messages(pages: DataFrame) -> DataFrame:
    """History pages (batch or stream) to one row per wire message:
    ``channel``, ``raw`` text and the parsed ``m``.

    ``m`` comes out of a generator, which no filter on it is pushed through, so every
    text is parsed once, however many conditions look at its fields."""
    file = F.col("_page") if "_page" in pages.columns else F.lit(None).cast("string")
    raw = _ok(pages).select(F.col("channel").cast("string").alias("channel"), "page", file.alias("_page"),
                            F.posexplode("messages").alias("_pos", "raw"))
    return raw.select("*", F.explode(F.array(F.from_json("raw", schemas.WIRE_MESSAGE))).alias("m"))


def _wire_messages(spark: SparkSession, path, multiline: bool):
    pages = _read(spark, path, schemas.HISTORY_PAGE, multiline)
    return pages, wire_messages(pages)


def valid_canonical(wire: DataFrame) -> DataFrame:
    """Canonical messages from the wire rows that parse and carry a readable ts."""
    return to_canonical(wire.filter(F.col("m").isNotNull() & ts_micros(F.col("m")["ts"]).isNotNull()))


def wire_rejects(wire: DataFrame) -> DataFrame:
    """LOG-1: the wire rows that ``valid_canonical`` leaves out, with their text."""
    ts = F.col("m")["ts"]
    lacking = F.col("m").isNull() | ts.isNull()
    return (wire.filter(lacking | ts_micros(ts).isNull())
            .select(F.lit("messages").alias("source"), F.col("channel").alias("key"),
                    F.when(lacking, F.lit("message is not a JSON object with a ts"))
                     .otherwise(F.lit("message has an unreadable ts")).alias("reason"),
                    F.col("_page").alias("file"), F.col("_pos").cast("bigint").alias("position"),
                    F.col("raw").alias("text")))


def rejected_texts(pages: DataFrame) -> DataFrame:
    """LOG-1 with texts: the pages and the messages of history pages that are set
    aside (``REJECTED_TEXTS``); one pass over the pages each."""
    return page_texts(pages, "history").unionByName(wire_rejects(wire_messages(pages)))


def history_pages(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    """Landed history pages as they are, with their file and block."""
    return _read(spark, path, schemas.HISTORY_PAGE, multiline)


def with_mentions(raw, wire_mentions, found):
    """The message text with the mentions found in its text (X-3) as a last
    top-level ``mentions`` array, where the wire sent none: the sieve judges
    plain posts on this text, and it is what is delivered."""
    body = F.rtrim(raw)
    added = F.concat(F.expr("substr(rtrim(raw), 1, length(rtrim(raw)) - 1)"), F.lit(',"mentions":'),
                     F.to_json(found), F.lit("}"))
    return F.when(wire_mentions.isNull() & (F.size(found) > 0) & body.endswith("}"), added).otherwise(raw)


def to_canonical(wire: DataFrame) -> DataFrame:
    """Wire messages (``channel``, ``page``, ``_pos``, ``raw``, parsed ``m``)
    to the canonical ``messages`` shape, unclassified."""
    m = F.col("m")
    us = ts_micros(m["ts"])
    wire_mentions = m["mentions"]
    # seq: dense position in the channel when the landing numbered its pages,
    # else the ts in microseconds (the message id of the chat API).
    seq = F.coalesce(F.col("page") * F.lit(schemas.PAGE_SPAN) + F.col("_pos"), us)
    return wire.select(
        "channel",
        seq.alias("seq"),
        m["ts"].alias("ts"),
        F.timestamp_micros(us).alias("event_time"),
        m["type"].alias("type"), m["subtype"].alias("subtype"),
        m["text"].alias("text"),
        F.coalesce(m["user"], m["comment"]["user"]).alias("user"),
        m["username"].alias("username"), m["bot_id"].alias("bot_id"),
        m["comment"]["comment"].alias("comment"),
        m["attachments"].alias("attachments"),
        m["file"].alias("file"),
        F.coalesce(m["comments"], F.array().cast("array<struct<id:string,timestamp:bigint,user:string>>")).alias("comments"),
        F.coalesce(m["reactions"], m["comment"]["reactions"],
                   F.array().cast("array<struct<name:string,users:array<string>,count:bigint>>")).alias("reactions"),
        F.coalesce(m["replies"], F.array().cast("array<struct<ts:string,user:string>>")).alias("replies"),
        F.when(F.size(wire_mentions) > 0, wire_mentions)
         .otherwise(F.coalesce(extract_mentions(m["text"]), F.array().cast("array<string>"))).alias("mentions"),
        with_mentions(F.col("raw"), wire_mentions, extract_mentions(m["text"])).alias("raw"),
    )


def read_history(spark: SparkSession, path, multiline: bool = False):
    """SRC-6: every message of every history page, flat and unclassified."""
    pages, wire = _wire_messages(spark, path, multiline)
    bad = wire_rejects(wire).select("source", "key", "reason")
    return valid_canonical(wire), _rejects(pages, "history").unionByName(bad)


def read_conversations(spark: SparkSession, path, blacklist: Iterable[str] = (),
                       multiline: bool = False):
    """SRC-5: messages of all channels, blacklisted subtypes removed and
    every message classified into one of the five categories."""
    msgs, rejects = read_history(spark, path, multiline)
    msgs = C.with_category(C.drop_blacklisted(msgs, blacklist))
    return msgs.select(*schemas.MESSAGE_COLUMNS), rejects
