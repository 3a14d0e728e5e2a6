"""Writers of the landing format read by ``sources.pages``.

An ingestion job lands API responses as pages; these functions produce the
same pages from DataFrames (used to exercise the readers on data derived
from the supplied tables, and to re-land canonical data).  Every page holds
at most ``page_size`` records, numbered by a distributed row index or by
the message sequence, so no page grows with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas

from ..functions import classify as C
from ..operators.splitting import row_index


def _pages(records: DataFrame, order: list[str], page_size: int, keys: list[str] | None = None):
    """Group ``(…, _json)`` records into pages of at most ``page_size``."""
    keys = keys or []
    idx = row_index(records, keys + order, "_rn")
    return (idx.withColumn("_page", F.expr(f"_rn div {int(page_size)}"))
            .groupBy(*keys, "_page")
            .agg(F.array_sort(F.collect_list(F.struct("_rn", "_json"))).alias("_items")))


def _write(pages: DataFrame, body, path: str) -> None:
    pages.select(body.alias("value")).write.mode("overwrite").text(path)


def _json_string(col: str):
    """JSON text of one string column (with quotes and escapes)."""
    listed = F.to_json(F.array(col))
    return listed.substr(F.lit(2), F.length(listed) - 2)


def _items(prefix, suffix: str):
    return F.concat(prefix if not isinstance(prefix, str) else F.lit(prefix), F.array_join(F.transform("_items", lambda x: x["_json"]), ","),
                    F.lit(suffix))


def land_channel_pages(channels: DataFrame, path: str, page_size: int = 200) -> None:
    """Channel listing pages (SRC-1 format)."""
    fields = ["id", "name", "is_channel", "created", "creator", "is_archived", "is_general",
              "name_normalized", "is_shared", "is_org_shared", "is_member", "is_private",
              "is_mpim", "members", "topic", "purpose", "previous_names", "num_members"]
    rec = channels.select("id", F.to_json(F.struct(*fields)).alias("_json"))
    _write(_pages(rec, ["id"], page_size),
           _items('{"ok":true,"channels":[', '],"response_metadata":{"next_cursor":""}}'), path)


def land_user_pages(users: DataFrame, path: str, page_size: int = 200) -> None:
    """User listing pages (SRC-2 format: profile fields nested)."""
    profile = F.struct(*[F.col(c) for c in (
        "first_name", "real_name", "last_name", "display_name", "email", "status_text",
        "status_emoji", "title", "skype", "phone", "image_72", "bot_id")])
    wire = F.to_json(F.struct("id", "team_id", "name", "deleted", "is_bot", "is_owner",
                              "is_primary_owner", "is_admin", profile.alias("profile")))
    rec = users.select("id", wire.alias("_json"))
    _write(_pages(rec, ["id"], page_size), _items('{"ok":true,"members":[', "]}"), path)


def land_team_pages(teams: DataFrame, path: str, landed=None) -> None:
    """Team info pages (SRC-4 format), one per team; ``landed`` (a column of ``teams``, microseconds)
    is written where it is given."""
    team = F.struct("id", "name", "domain", "email_domain",
                    F.struct(F.col("image_132").alias("image_132")).alias("icon"))
    at = [] if landed is None else [landed.alias("landed")]
    teams.select(F.to_json(F.struct(F.lit(True).alias("ok"), team.alias("team"), *at)).alias("value")) \
        .write.mode("overwrite").text(path)


def land_emoji_pages(emojis: DataFrame, path: str, page_size: int = 500, landed=None) -> None:
    """Emoji pages (name -> URL or ``alias:<name>``); the team id is in the page, and ``landed``
    (an expression of ``team_id`` and ``_page``, microseconds) where it is given."""
    value = F.coalesce(F.col("url"), F.concat(F.lit(schemas.EMOJI_ALIAS_PREFIX), F.col("alias_of")))
    rec = emojis.select("team_id", "name",
                        F.to_json(F.struct(value.alias("v"))).alias("_v"))
    # "name":"value" pairs of a JSON object, assembled from to_json pieces.
    pair = F.concat(_json_string("name"), F.lit(":"), F.expr("substr(_v, 6, length(_v) - 6)"))
    rec = rec.select("team_id", "name", pair.alias("_json"))
    at = [] if landed is None else [F.lit(',"landed":'), landed.cast("string")]
    _write(_pages(rec, ["name"], page_size, keys=["team_id"]),
           _items(F.concat(F.lit('{"ok":true,"team_id":'), _json_string("team_id"), *at, F.lit(',"emoji":{')),
                  "}}"), path)


def land_history_pages(messages: DataFrame, path: str, page_size: int = 1000,
                       numbered: bool = True) -> None:
    """Write messages as conversation-history pages (``history_page_lines``), the
    landing format read by ``read_conversations``.  A channel has no folder of its
    own, so the number of files follows the data."""
    history_page_lines(messages, page_size, numbered).select("value").write.mode("overwrite").text(path)


def history_page_lines(messages: DataFrame, page_size: int = 1000, numbered: bool = True) -> DataFrame:
    """Messages as pages: channel and value, one JSON page per line with its
    channel and at most ``page_size`` messages.  ``numbered=False`` leaves the page
    number out, as the API does.

    A message is written as its wire object: whitelisted messages as their
    raw text without top-level mentions (text that is not JSON is kept as a
    JSON string, which the reader then rejects), others from their typed
    fields; the API sends no mentions, the reader finds them in the text.
    """
    comment = F.when(F.col("category") == C.FILE_COMMENT, F.struct(
        F.concat(F.lit("Fc"), F.col("seq").cast("string")).alias("id"), F.col("user").alias("user"),
        F.col("comment").alias("comment"), F.col("seq").alias("timestamp"),
        F.lit(None).cast("bigint").alias("created"), F.col("reactions").alias("reactions")))
    typed = F.to_json(F.struct(
        "type", "subtype", "text", "user", "username", "bot_id", "ts",
        F.try_parse_json("attachments").alias("attachments"), "file", comment.alias("comment"),
        F.when(F.size("comments") > 0, F.col("comments")).alias("comments"),
        F.when(F.size("reactions") > 0, F.col("reactions")).alias("reactions"),
        F.when(F.size("replies") > 0, F.col("replies")).alias("replies")))
    # top-level fields of the raw object but its mentions
    plain = F.expr("to_json(map_filter(try_variant_get(try_parse_json(raw), '$', 'map<string,variant>'), "
                   "(k, v) -> k <> 'mentions'))")
    element = (F.when(F.col("category") != C.WHITELISTED, typed)
                .otherwise(F.coalesce(plain, _json_string("raw"))))
    items = messages.select("channel", F.expr(f"seq div {int(page_size)}").alias("page"),
                            "seq", element.alias("element"))
    number = (F.concat(F.lit(',"page":'), F.col("page").cast("string")) if numbered else F.lit(""))
    return (items.groupBy("channel", "page")
             .agg(F.array_sort(F.collect_list(F.struct("seq", "element"))).alias("_m"))
             .select("channel", F.concat(
                 F.lit('{"ok":true,"has_more":false,"channel":'), _json_string("channel"), number,
                 F.lit(',"messages":['),
                 F.array_join(F.transform("_m", lambda x: x["element"]), ","),
                 F.lit("]}")).alias("value")))
