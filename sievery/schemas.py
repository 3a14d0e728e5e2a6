"""Schemas of the landed API pages and of the canonical tables.

Pages are read with an explicit schema (never inferred): inference scans the
data twice and drifts between files.  Field names follow the chat API's wire
format; the canonical tables are what every operator downstream consumes.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the chat wire format: an emoji page maps a name to a URL
# or to "alias:<name>"; a message ts is "<epoch seconds>.<6 digits>"; URL
# templates name their parameters as "<team_id>" and "<channel_id>".
EMOJI_ALIAS_PREFIX = "alias:"
TEMPLATE_PLACEHOLDER = "<{name}>"

S = T.StringType()
B = T.BooleanType()
L = T.LongType()
I = T.IntegerType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


TOPIC = _struct(("value", S), ("creator", S), ("last_set", L))

CHANNEL = _struct(
    ("id", S), ("name", S), ("is_channel", B), ("created", L), ("creator", S),
    ("is_archived", B), ("is_general", B), ("name_normalized", S),
    ("is_shared", B), ("is_org_shared", B), ("is_member", B), ("is_private", B),
    ("is_mpim", B), ("members", T.ArrayType(S)), ("topic", TOPIC),
    ("purpose", TOPIC), ("previous_names", T.ArrayType(S)), ("num_members", L),
)

# A line that does not parse as a page comes with all other columns null and its
# text here (the name that Spark's JSON reader fills by default).
CORRUPT = "_corrupt_record"

RESPONSE_METADATA = _struct(("next_cursor", S))

CHANNEL_PAGE = _struct(
    ("ok", B), ("error", S), ("channels", T.ArrayType(CHANNEL)),
    ("response_metadata", RESPONSE_METADATA), (CORRUPT, S),
)

# Profile fields sit under ``profile`` on the wire and are lifted to the top
# level of the ``users`` table.
PROFILE = _struct(
    ("first_name", S), ("real_name", S), ("last_name", S), ("display_name", S),
    ("email", S), ("status_text", S), ("status_emoji", S), ("title", S),
    ("skype", S), ("phone", S), ("image_72", S), ("bot_id", S),
)

USER_WIRE = _struct(
    ("id", S), ("team_id", S), ("name", S), ("deleted", B), ("real_name", S),
    ("is_bot", B), ("is_owner", B), ("is_primary_owner", B), ("is_admin", B),
    ("profile", PROFILE),
)

USER_PAGE = _struct(
    ("ok", B), ("error", S), ("offset", S), ("members", T.ArrayType(USER_WIRE)),
    ("response_metadata", RESPONSE_METADATA), (CORRUPT, S),
)

# Column order of the flat ``users`` table.
USER_COLUMNS = [
    "id", "team_id", "name", "deleted", "first_name", "real_name", "last_name",
    "display_name", "email", "is_bot", "status_text", "status_emoji", "title",
    "skype", "phone", "is_owner", "is_primary_owner", "image_72", "is_admin",
    "bot_id", "user",
]

ICON = _struct(("image_34", S), ("image_44", S), ("image_68", S), ("image_88", S),
               ("image_102", S), ("image_132", S), ("image_default", B))

TEAM_PAGE = _struct(
    ("ok", B), ("error", S),
    ("team", _struct(("id", S), ("name", S), ("domain", S), ("email_domain", S),
                     ("icon", ICON), ("enterprise_id", S), ("enterprise_name", S))),
    ("landed", L), (CORRUPT, S),
)

# ``team_id`` and ``landed`` (when the response came, microseconds since the epoch)
# are added by the landing step, as ``channel`` below.
EMOJI_PAGE = _struct(("ok", B), ("error", S), ("team_id", S), ("emoji", T.MapType(S, S)),
                     ("landed", L), (CORRUPT, S))

REACTION = _struct(("name", S), ("users", T.ArrayType(S)), ("count", L))
REPLY = _struct(("ts", S), ("user", S))
FILE_COMMENT_ITEM = _struct(("id", S), ("timestamp", L), ("user", S))

USER_FILE = _struct(
    ("filetype", S), ("id", S), ("title", S), ("url_private", S),
    ("external_type", S), ("timestamp", L), ("pretty_type", S), ("name", S),
    ("mimetype", S), ("permalink", S), ("created", L), ("mode", S),
    ("thumb_64", S), ("thumb_80", S), ("thumb_360", S),
)

# The comment object carried by a ``file_comment`` message on the wire.
WIRE_COMMENT = _struct(("id", S), ("user", S), ("comment", S), ("timestamp", L),
                       ("created", L), ("reactions", T.ArrayType(REACTION)))

# A message as it arrives in a history page.  ``attachments`` is kept as raw
# JSON text (its element shapes vary) and the full message text is kept in
# ``raw`` by the page reader.
WIRE_MESSAGE = _struct(
    ("type", S), ("subtype", S), ("text", S), ("user", S), ("username", S),
    ("bot_id", S), ("ts", S), ("attachments", S), ("file", USER_FILE),
    ("comment", WIRE_COMMENT), ("comments", T.ArrayType(FILE_COMMENT_ITEM)),
    ("reactions", T.ArrayType(REACTION)), ("replies", T.ArrayType(REPLY)),
    ("mentions", T.ArrayType(S)),
)

# ``channel`` and ``page`` are added by the landing step (the page's channel and
# its position in the channel's history); the API itself does not send them.
HISTORY_PAGE = _struct(
    ("ok", B), ("error", S), ("channel", S), ("page", L), ("has_more", B), ("pin_count", L),
    ("messages", T.ArrayType(S)), ("response_metadata", RESPONSE_METADATA), (CORRUPT, S),
)

# ``page * PAGE_SPAN + position`` is unique within a channel: a position in a
# page's array is below 2**31.
PAGE_SPAN = 1 << 32

# Canonical tall table of messages: one row per message, every category.
MESSAGE_COLUMNS = [
    "channel", "category", "category_ord", "seq", "ts", "event_time", "type",
    "subtype", "text", "user", "username", "bot_id", "comment", "attachments",
    "file", "comments", "reactions", "replies", "mentions", "raw",
]

MESSAGES = T.StructType([
    T.StructField("channel", S), T.StructField("category", S),
    T.StructField("category_ord", I), T.StructField("seq", L),
    T.StructField("ts", S), T.StructField("event_time", T.TimestampType()),
    T.StructField("type", S), T.StructField("subtype", S),
    T.StructField("text", S), T.StructField("user", S),
    T.StructField("username", S), T.StructField("bot_id", S),
    T.StructField("comment", S), T.StructField("attachments", S),
    T.StructField("file", USER_FILE),
    T.StructField("comments", T.ArrayType(FILE_COMMENT_ITEM)),
    T.StructField("reactions", T.ArrayType(REACTION)),
    T.StructField("replies", T.ArrayType(REPLY)),
    T.StructField("mentions", T.ArrayType(S)), T.StructField("raw", S),
])

REJECTS = _struct(("source", S), ("key", S), ("reason", S))

# Rejects with the place and the text of what was set aside: ``position`` is the
# start of the file block that a page's line is in, or a message's place in its page.
REJECTED_TEXTS = _struct(("source", S), ("key", S), ("reason", S), ("file", S), ("position", L), ("text", S))
