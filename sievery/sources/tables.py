"""Adapter views over the supplied benchmark tables.

The supplied tables hold no chat data, so each chat entity is derived from
one of them by a fixed, deterministic rule.  Every view keeps all rows of
its source table; the rules only give them a chat shape.  The same rules are
written again, independently, in DuckDB SQL in ``plans/oracle.py``.

* ``messages``  <- ``events``: one message per event, channel from the user,
  kind from the event type, lists from the ``k`` property.
* ``channels``  <- ``nation`` + ``customer``: one channel per nation; its
  members are the nation's customers (tall ``channel_members`` table).
* ``users``     <- ``customer`` (+ ``nation`` for the team).
* ``teams``     <- ``region``;  ``emojis`` <- ``part``.
* ``documents`` with mention tokens around every text.
* ``messages`` <- ``conversations``: one channel per conversation, one post
  per turn, replies from the next turn.
* ``responses`` <- ``events``: service reply bodies of every shape.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import classify as C
from ..session import table_path

# Fixed values of the adapters (shared with the SQL twins).
N_CHANNELS = 27              # two more than the listing has


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def micros_since_epoch_sql(ts_ntz: str) -> str:
    """Microseconds of a TIMESTAMP_NTZ column since 1970-01-01 00:00, from
    its calendar parts, so that the session time zone plays no part."""
    return (f"(cast(unix_date(to_date({ts_ntz})) AS bigint) * 86400000000"
            f" + cast(hour({ts_ntz}) * 3600 + minute({ts_ntz}) * 60 AS bigint) * 1000000"
            f" + cast(extract(SECOND FROM {ts_ntz}) * 1000000 AS bigint))")


def micros_since_epoch(ts_ntz: str) -> Column:
    """Column form of ``micros_since_epoch_sql`` for the named column."""
    return F.expr(micros_since_epoch_sql(ts_ntz))


def messages_from_events(events: DataFrame) -> DataFrame:
    """Canonical ``messages`` (classified) from the ``events`` table.

    error -> bot post (``bot_message``, bot id, attachments when k is odd);
    click -> user post with attachments; view -> file share;
    signup -> file comment; purchase -> plain post kept as raw JSON
    (whitelisted), ``channel_join`` subtype when k is even.
    k % 4 = 0 puts a mention token in the text (and the user in
    ``mentions``, as X-3 would extract it), k % 3 = 0 adds a reaction,
    k % 5 = 0 a reply, k % 7 = 0 a file comment item.  Raw JSON of plain
    posts nests its lists under ``key`` when k % 11 = 0 and is cut short
    (not JSON) when k % 13 = 0.

    The rules are SQL expressions: each step is one call to the JVM however
    many expressions it holds.
    """
    # json_tuple parses ``props`` once per row for all requested keys.
    e = events.select("event_id", "user_id", "event_type", "ts",
                      F.json_tuple("props", "k").alias("k_text"))
    e = e.selectExpr("event_id", "user_id", "event_type", "cast(k_text AS int) AS k",
                     f"{micros_since_epoch_sql('ts')} AS us")
    e = e.selectExpr(
        "*", "us div 1000000 AS secs",
        "concat(cast(us div 1000000 AS string), '.', lpad(cast(pmod(us, 1000000) AS string), 6, '0')) AS ts",
        "concat('U', cast(user_id AS string)) AS user_code",
        "event_type = 'error' AS is_bot")
    shaped = e.selectExpr(
        f"concat('C', cast(user_id % {N_CHANNELS} AS string)) AS channel",
        "event_id AS seq", "ts", "timestamp_micros(us) AS event_time", "'message' AS type",
        """CASE WHEN is_bot THEN 'bot_message' WHEN event_type = 'view' THEN 'file_share'
                WHEN event_type = 'signup' THEN 'file_comment'
                WHEN event_type = 'purchase' AND k % 2 = 0 THEN 'channel_join' END AS subtype""",
        """concat(event_type, ' #', cast(event_id AS string),
                  CASE WHEN k % 4 = 0 THEN concat(' cc <@', user_code, '>') ELSE '' END) AS text""",
        "CASE WHEN NOT is_bot THEN user_code END AS user",
        "CASE WHEN is_bot THEN concat('bot-', cast(user_id AS string)) END AS username",
        "CASE WHEN is_bot THEN concat('B', cast(user_id AS string)) END AS bot_id",
        "CASE WHEN event_type = 'signup' THEN concat('note ', cast(event_id AS string)) END AS comment",
        """CASE WHEN event_type = 'click'
                  THEN concat('[{"id":"A', cast(event_id AS string), '","k":', cast(k AS string), '}]')
                WHEN is_bot AND k % 2 = 1 THEN concat('[{"id":"A', cast(event_id AS string), '"}]')
           END AS attachments""",
        """CASE WHEN event_type IN ('view', 'signup') THEN named_struct(
             'filetype', 'text', 'id', concat('F', cast(event_id AS string)),
             'title', concat('file ', cast(event_id AS string)),
             'url_private', concat('https://files.example/F', cast(event_id AS string)),
             'external_type', cast(NULL AS string), 'timestamp', secs, 'pretty_type', 'Plain Text',
             'name', concat('F', cast(event_id AS string), '.txt'), 'mimetype', 'text/plain',
             'permalink', concat('https://files.example/p/F', cast(event_id AS string)),
             'created', secs, 'mode', 'hosted', 'thumb_64', cast(NULL AS string),
             'thumb_80', cast(NULL AS string), 'thumb_360', cast(NULL AS string)) END AS file""",
        """CASE WHEN event_type = 'view' AND k % 7 = 0
                THEN array(named_struct('id', concat('Fc', cast(event_id AS string)),
                                        'timestamp', secs, 'user', user_code))
                ELSE cast(array() AS array<struct<id:string,timestamp:bigint,user:string>>)
           END AS comments""",
        """CASE WHEN k % 3 = 0
                THEN array(named_struct('name', 'tada', 'users', array(concat('U', cast(user_id + 1 AS string))),
                                        'count', cast(1 AS bigint)))
                ELSE cast(array() AS array<struct<name:string,users:array<string>,count:bigint>>)
           END AS reactions""",
        """CASE WHEN k % 5 = 0
                THEN array(named_struct('ts', ts, 'user', concat('U', cast(user_id + 2 AS string))))
                ELSE cast(array() AS array<struct<ts:string,user:string>>) END AS replies""",
        "CASE WHEN k % 4 = 0 THEN array(user_code) ELSE cast(array() AS array<string>) END AS mentions",
        "k", "event_type")
    # Raw wire text of plain posts, one to_json per row: NULL fields are left
    # out (no subtype on a plain post, replies only when there are some, the
    # lists either at the top or under "key"); empty reaction and mention
    # lists are written as [].  A cut-short text drops the final brace.
    raw = """CASE WHEN event_type = 'purchase' THEN concat(regexp_replace(to_json(named_struct(
             'type', type, 'subtype', subtype, 'user', user, 'text', text, 'ts', ts,
             'reactions', CASE WHEN k % 11 <> 0 THEN reactions END,
             'mentions', CASE WHEN k % 11 <> 0 THEN mentions END,
             'replies', CASE WHEN k % 11 <> 0 AND size(replies) > 0 THEN replies END,
             'key', CASE WHEN k % 11 = 0 THEN named_struct(
                 'reactions', reactions, 'mentions', mentions,
                 'replies', CASE WHEN size(replies) > 0 THEN replies END) END)), '\\}$', ''),
             CASE WHEN k % 13 = 0 THEN '' ELSE '}' END) END"""
    out = shaped.selectExpr("*", f"{raw} AS raw", f"{C.classify_sql()} AS category")
    return out.selectExpr(*[f"{C.category_rank_sql()} AS category_ord" if c == "category_ord" else c
                            for c in schemas.MESSAGE_COLUMNS])


# Fixed value: conversation turns get wire timestamps from this epoch second,
# conv_id * 1000 + turn seconds later.
CONVERSATION_EPOCH = 1700000000


def messages_from_conversations(conversations: DataFrame) -> DataFrame:
    """Canonical ``messages`` (classified) from ``conversations``.

    One channel per conversation (``V<conv_id>``), one message per turn.
    Assistant turns are bot posts; user and system turns are plain posts
    kept as raw JSON (system turns with the ``channel_join`` subtype).  A
    turn's ``replies`` holds the next turn of its conversation, found with
    an equi-join on (conversation, turn) so that a long conversation is not
    gathered into one task.  Every seventh conversation keeps no replies, and in
    every third one the second turn mentions its user.  Mentions are X-3 over the
    whole text.
    """
    conversations = conversations.withColumn("text", F.expr(
        "CASE WHEN conv_id % 3 = 0 AND turn = 1 THEN concat(coalesce(text, ''), ' <@U', "
        "cast(conv_id AS string), '>') ELSE text END"))
    def ts_of(turn: str) -> str:
        return f"concat(cast({CONVERSATION_EPOCH} + conv_id * 1000 + {turn} AS string), '.000000')"

    nxt = conversations.selectExpr("conv_id AS _conv", "turn - 1 AS _prev", "turn AS _turn",
                                   "role AS _role")
    j = conversations.join(nxt, (F.col("conv_id") == F.col("_conv"))
                           & (F.col("turn") == F.col("_prev")), "left")
    pattern = r"'<@([UW][A-Z0-9]+)(?:\\|[^>]*)?>'"
    shaped = j.selectExpr(
        "concat('V', cast(conv_id AS string)) AS channel", "turn AS seq", f"{ts_of('turn')} AS ts",
        f"timestamp_seconds({CONVERSATION_EPOCH} + conv_id * 1000 + turn) AS event_time",
        "'message' AS type",
        "CASE role WHEN 'assistant' THEN 'bot_message' WHEN 'system' THEN 'channel_join' END AS subtype",
        "text",
        "CASE WHEN role <> 'assistant' THEN concat('U', cast(conv_id AS string)) END AS user",
        "CASE WHEN role = 'assistant' THEN 'assistant' END AS username",
        "CASE WHEN role = 'assistant' THEN concat('B', cast(conv_id AS string)) END AS bot_id",
        "cast(NULL AS string) AS comment", "cast(NULL AS string) AS attachments",
        "cast(NULL AS struct<filetype:string,id:string,title:string,url_private:string,"
        "external_type:string,timestamp:bigint,pretty_type:string,name:string,mimetype:string,"
        "permalink:string,created:bigint,mode:string,thumb_64:string,thumb_80:string,"
        "thumb_360:string>) AS file",
        "cast(array() AS array<struct<id:string,timestamp:bigint,user:string>>) AS comments",
        "cast(array() AS array<struct<name:string,users:array<string>,count:bigint>>) AS reactions",
        f"""CASE WHEN _turn IS NOT NULL AND conv_id % 7 <> 0 THEN array(named_struct('ts', {ts_of('_turn')},
                 'user', CASE WHEN _role = 'assistant' THEN concat('B', cast(conv_id AS string))
                              ELSE concat('U', cast(conv_id AS string)) END))
            ELSE cast(array() AS array<struct<ts:string,user:string>>) END AS replies""",
        f"regexp_extract_all(text, {pattern}, 1) AS mentions")
    out = shaped.selectExpr(
        "*",
        """CASE WHEN bot_id IS NULL THEN to_json(named_struct('type', type, 'subtype', subtype,
             'user', user, 'text', text, 'ts', ts, 'mentions', mentions,
             'replies', CASE WHEN size(replies) > 0 THEN replies END)) END AS raw""",
        f"{C.classify_sql()} AS category")
    return out.selectExpr(*[f"{C.category_rank_sql()} AS category_ord" if c == "category_ord" else c
                            for c in schemas.MESSAGE_COLUMNS])


def channel_members_from_tables(customer: DataFrame) -> DataFrame:
    """Membership as a tall table (channel, user): one row per customer."""
    return customer.selectExpr("concat('C', cast(c_nationkey AS string)) AS channel",
                               "concat('U', cast(c_custkey AS string)) AS user")


def channels_from_tables(nation: DataFrame, customer: DataFrame, region: DataFrame) -> DataFrame:
    """Canonical ``channels`` from ``nation`` + ``customer``, and one channel
    without members or messages per region (``Q<regionkey>``).

    ``num_members`` is counted with a partial (map-side) aggregation, so a
    nation holding a third of all customers costs one counter per task.  The
    member ids are not gathered into the channel row: a derived channel can
    have as many members as there are customers, so membership stays the
    tall ``channel_members`` table and ``members`` is empty here.  The count
    is an attribute and is never derived from a member list.
    """
    counts = customer.groupBy("c_nationkey").agg(F.count("*").alias("num_members"))
    joined = nation.join(counts, F.col("n_nationkey") == F.col("c_nationkey"), "left").selectExpr(
        "concat('C', cast(n_nationkey AS string)) AS id", "lower(n_name) AS n_name",
        "n_nationkey = 0 AS is_general", "n_regionkey", "num_members")
    quiet = region.selectExpr(
        "concat('Q', cast(r_regionkey AS string)) AS id", "concat('quiet ', lower(r_name)) AS n_name",
        "false AS is_general", "r_regionkey AS n_regionkey", "cast(0 AS bigint) AS num_members")
    joined = joined.unionByName(quiet)
    topic = ("named_struct('value', concat('all about ', n_name), 'creator', 'U0', "
             "'last_set', cast(0 AS bigint))")
    return joined.selectExpr(
        "id", "n_name AS name",
        "true AS is_channel", "cast(0 AS bigint) AS created", "'U0' AS creator",
        "false AS is_archived", "is_general",
        "n_name AS name_normalized", "false AS is_shared", "false AS is_org_shared",
        "true AS is_member", "false AS is_private", "false AS is_mpim",
        "cast(array() AS array<string>) AS members", f"{topic} AS topic", f"{topic} AS purpose",
        "cast(array() AS array<string>) AS previous_names",
        "cast(coalesce(num_members, 0) AS bigint) AS num_members",
        "concat('T', cast(n_regionkey AS string)) AS team_id")


def users_from_tables(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Canonical ``users`` from ``customer``; the team is the region of the
    customer's nation.  ``nation`` is a dimension (25 rows), so this join is
    broadcast by Spark's size check."""
    c = customer.join(nation.select("n_nationkey", "n_regionkey"),
                      F.col("c_nationkey") == F.col("n_nationkey"), "left")
    name = "lower(regexp_replace(c_name, '#', ''))"
    none = "cast(NULL AS string)"
    return c.selectExpr(
        "concat('U', cast(c_custkey AS string)) AS id",
        "concat('T', cast(n_regionkey AS string)) AS team_id",
        f"{name} AS name", "false AS deleted", f"{none} AS first_name", "c_name AS real_name",
        f"{none} AS last_name", f"{name} AS display_name",
        f"concat({name}, '@users.example') AS email", "false AS is_bot",
        "c_mktsegment AS status_text", f"{none} AS status_emoji", f"{none} AS title",
        f"{none} AS skype", f"{none} AS phone", "false AS is_owner", "false AS is_primary_owner",
        f"{none} AS image_72", "c_acctbal > 9000 AS is_admin", f"{none} AS bot_id",
        f"{none} AS user")


def teams_from_region(region: DataFrame) -> DataFrame:
    """One team per region, and one that came without an id (F-8 drops it)."""
    dom = "regexp_replace(lower(r_name), ' ', '-')"
    unnamed = region.filter("r_regionkey = 0").selectExpr("cast(NULL AS int) AS r_regionkey",
                                                          "'unnamed' AS r_name")
    return region.select("r_regionkey", "r_name").unionByName(unnamed).selectExpr(
        "coalesce(concat('T', cast(r_regionkey AS string)), '') AS id", "r_name AS name", f"{dom} AS domain",
        f"concat({dom}, '.example') AS email_domain",
        f"concat('https://img.example/', {dom}, '_132.png') AS image_132")


def emojis_from_part(part: DataFrame) -> DataFrame:
    """Emoji rows (team_id, name, url, alias_of) from ``part``.

    Team = ``p_partkey % 5``; parts with ``p_size > 40`` are aliases of the
    part five keys lower (same team), which may itself be an alias (a chain)
    or not exist (a dangling alias)."""
    return part.selectExpr(
        "concat('T', cast(p_partkey % 5 AS string)) AS team_id",
        "concat('e', cast(p_partkey AS string)) AS name",
        "CASE WHEN NOT (p_size > 40) THEN concat('https://emoji.example/', "
        "cast(p_partkey AS string), '.png') END AS url",
        "CASE WHEN p_size > 40 THEN concat('e', cast(p_partkey - 5 AS string)) END AS alias_of")


def documents_with_mentions(documents: DataFrame) -> DataFrame:
    """Documents whose whole text is wrapped by two mention tokens, one
    plain and one with a display name."""
    return documents.selectExpr(
        "doc_id",
        "concat('<@U', cast(doc_id AS string), '> ', text, ' <@W', cast(doc_id * 7 AS string), "
        "'|someone>') AS text")


def responses_from_events(events: DataFrame) -> DataFrame:
    """One service reply body per event, covering every reply shape."""
    return events.selectExpr("event_id", """CASE event_id % 7
        WHEN 0 THEN concat('{"received":', cast(user_id AS string), '}')
        WHEN 1 THEN '{"message":[]}'
        WHEN 2 THEN '{"message":[{"error":"rejected"}]}'
        WHEN 3 THEN '{"errors":"bad payload"}'
        WHEN 4 THEN '{"received":null}'
        WHEN 5 THEN '{"message":[1]}'
        ELSE 'upstream timeout' END AS body""")


def load_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from_events(read_table(spark, sf_dir, "events"))


def load_conversation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages_from_conversations(read_table(spark, sf_dir, "conversations"))


def load_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return channels_from_tables(read_table(spark, sf_dir, "nation"),
                                read_table(spark, sf_dir, "customer"),
                                read_table(spark, sf_dir, "region"))


def load_channel_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return channel_members_from_tables(read_table(spark, sf_dir, "customer"))


def load_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users_from_tables(read_table(spark, sf_dir, "customer"),
                             read_table(spark, sf_dir, "nation"))


def load_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return teams_from_region(read_table(spark, sf_dir, "region"))


def load_emojis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return emojis_from_part(read_table(spark, sf_dir, "part"))
