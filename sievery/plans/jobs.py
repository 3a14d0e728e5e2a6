"""The jobs of the original tool (JOB-1..JOB-5) as DataFrame functions.

Each job takes its inputs as DataFrames (from the page readers in
``sources.pages`` or the adapters in ``sources.tables``) and returns the
payload DataFrame that a sink delivers (``sinks.delivery``).  Nothing is
collected to the driver: a listing is cut into batches of a fixed size
(the original posted the whole listing as one record).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas

from ..functions import classify as C
from ..functions import encode as E
from ..operators import dedup, emoji, payloads, routing, sieve
from ..operators.splitting import rank_within


def listing_batches(df: DataFrame, size: int, kind: str, url_template: str = "",
                    team_col: str | None = "team_id", team_id: str | None = None,
                    id_col: str = "id") -> DataFrame:
    """E-7 + STR-1 + SNK-2/3 payloads: records in id order, ``size`` per batch.

    Batches are cut per team (column ``team_col``, or the one ``team_id``), since
    the URL names it.  Columns: kind, team_id, channel (null), chunk, url,
    n_items, first_id, last_id, body (JSON array of records), key (sha-256 of url
    and body).  An empty listing gives no batch (F-8).  The rank within a team is
    distributed, and a batch holds at most ``size`` records.
    """
    team = F.col(team_col) if team_col and team_id is None else F.lit(team_id).cast("string")
    rec = df.select(team.alias("_team"), F.col(id_col).alias("_id"),
                    E.encode_record(*df.columns).alias("_json"))
    grouped = (rank_within(rec, "_team", ["_id", "_json"], "_rn")
               .withColumn("chunk", F.expr(f"_rn div {int(size)}"))
               .groupBy("_team", "chunk")
               .agg(F.array_sort(F.collect_list(F.struct("_rn", "_id", "_json"))).alias("_items"),
                    F.count("*").alias("n_items")))
    url = E.fill_template(url_template, team_id=F.coalesce("_team", F.lit("")))
    body = E.json_array(F.transform("_items", lambda x: x["_json"]))
    return grouped.select(
        F.lit(kind).alias("kind"), F.col("_team").alias("team_id"),
        F.lit(None).cast("string").alias("channel"), "chunk", url.alias("url"), "n_items",
        F.col("_items")[0]["_id"].alias("first_id"),
        F.element_at("_items", -1)["_id"].alias("last_id"), body.alias("body"),
        F.sha2(F.concat_ws("\n", url, body), 256).alias("key"))


def seed_users(users: DataFrame, batch_size: int = 500, url_template: str = "",
               team_id: str | None = None) -> DataFrame:
    """JOB-1: user listing payloads, per team."""
    return listing_batches(users, batch_size, "users", url_template, team_id=team_id)


def seed_channels(channels: DataFrame, batch_size: int = 500, url_template: str = "",
                  team_id: str | None = None) -> DataFrame:
    """JOB-2: channel listing payloads, per team (``team_id`` where the listing
    has no such column, as the API's pages)."""
    return listing_batches(channels, batch_size, "channels", url_template, team_id=team_id)


def listed_only(messages: DataFrame, channels: DataFrame, id_col: str = "id") -> DataFrame:
    """ST-1 without state: the messages of the listed channels only (a
    left-semi join; the listing side is reduced to distinct ids)."""
    ids = channels.select(F.col(id_col).alias("channel")).distinct()
    return messages.join(ids, "channel", "left_semi")


def seed_posts(messages: DataFrame, url_template: str, blacklist: Iterable[str] = (),
               team_id: str | None = None, channel_teams: DataFrame | None = None,
               chunk_size: int = payloads.DEFAULT_CHUNK, chunk_by: str = "rank",
               once: bool = True) -> DataFrame:
    """JOB-3: messages of the listed channels (ST-1, when ``channel_teams``
    is the listing), blacklist (X-2), sieve (F-6), each message once (ST-2; not
    with ``once=False``, where the caller knows it), encode and group (AGG-2)."""
    if channel_teams is not None:
        messages = listed_only(messages, channel_teams)
    kept = sieve.sieve(C.drop_blacklisted(messages, blacklist))
    if once:
        kept = dedup.dedup_messages(kept)
    return payloads.post_payloads(kept, url_template, team_id=team_id,
                                  channel_teams=channel_teams, chunk_size=chunk_size,
                                  chunk_by=chunk_by)


def team_info(teams: DataFrame, emojis: DataFrame) -> DataFrame:
    """JOB-4: every team with an id (F-8) and its emoji counts (SRC-3, X-4).

    Emojis are counted per team with a partial aggregation, then joined to
    the team records, which are few.
    """
    resolved = emoji.resolve_aliases(emojis)
    per_team = resolved.groupBy("team_id").agg(
        F.count("*").alias("n_emojis"),
        F.count_if(F.col("status") == emoji.ALIAS).alias("n_aliases"),
        F.count_if(F.col("status").isin(emoji.CHAIN, emoji.MISSING)).alias("n_unresolved"))
    t = sieve.nonempty_listing(teams)
    j = t.join(per_team, t["id"] == per_team["team_id"], "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return j.select(F.col("id").alias("team_id"), "name", "domain",
                    z("n_emojis"), z("n_aliases"), z("n_unresolved"))


def team_payload(teams: DataFrame, emojis: DataFrame | None = None,
                 batch_size: int = 1000, url_template: str = "") -> DataFrame:
    """SNK-4 / E-7 + STR-1: the team record with its emojis, as JSON bodies.

    The original posted one object per team holding every emoji.  A team's
    emoji list grows with the data, so it is cut into payloads of at most
    ``batch_size`` emojis (name order, via the distributed rank within a team); each
    payload repeats the team fields.  A team without emojis gets one
    payload with an empty list.  Columns: kind, team_id, channel (null), chunk,
    url, n_items (emojis), body, key.  Emoji items are ``{"name", "url"}``, the url being the wire value
    (a URL or ``alias:<name>``).
    """
    t = sieve.nonempty_listing(teams)
    head = E.encode_record(*t.columns)
    t = t.select(F.col("id").alias("team_id"), head.alias("_h"))
    t = t.select("team_id", F.expr("substr(_h, 1, length(_h) - 1)").alias("_head"))
    if emojis is None:
        items = t.select("team_id", F.lit(0).cast("bigint").alias("chunk"),
                         F.lit(0).cast("bigint").alias("n_items"), F.lit("").alias("_items"))
    else:
        value = F.coalesce(F.col("url"), F.concat(F.lit(schemas.EMOJI_ALIAS_PREFIX), F.col("alias_of")))
        e = emojis.select("team_id", "name",
                          F.to_json(F.struct("name", value.alias("url"))).alias("_json"))
        idx = rank_within(e, "team_id", ["name", "_json"], "_rn")
        grouped = (idx.withColumn("chunk", F.expr(f"_rn div {int(batch_size)}"))
                   .groupBy("team_id", "chunk")
                   .agg(F.array_sort(F.collect_list(F.struct("_rn", "_json"))).alias("_l"),
                        F.count("*").alias("n_items"))
                   .select("team_id", "chunk", "n_items",
                           F.array_join(F.transform("_l", lambda x: x["_json"]), ",").alias("_items")))
        # teams with no emoji still get one payload
        items = t.select("team_id").join(grouped, "team_id", "left").select(
            "team_id", F.coalesce("chunk", F.lit(0).cast("bigint")).alias("chunk"),
            F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
            F.coalesce("_items", F.lit("")).alias("_items"))
    body = F.concat(F.col("_head"), F.lit(',"emojis":['), F.col("_items"), F.lit("]}"))
    url = E.fill_template(url_template, team_id=F.col("team_id"))
    return (t.join(items, "team_id")
            .select(F.lit("team").alias("kind"), "team_id", F.lit(None).cast("string").alias("channel"),
                    "chunk", url.alias("url"), "n_items", body.alias("body"),
                    F.sha2(F.concat_ws("\n", url, body), 256).alias("key")))


def route_report(channels: DataFrame, messages: DataFrame, min_members: int = 5,
                 size: str = "1 second", slide: str = "100 milliseconds"):
    """JOB-5: channels routed by size (RT-1) and, per route, the messages
    of each sliding window (WIN-1).  Returns (routed channels, windows)."""
    routed = routing.route_channels(channels, min_members)
    routes = routed.select(F.col("id").alias("channel"), "route")
    windows = routing.routed_pane_windows(messages, routes, "event_time", size, slide)
    return routed, windows
