"""Registered queries: every operator of the inventory run over the supplied
tables through the adapter views.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
are scalars or strings (so results can be hashed and compared with the SQL
twins in ``plans/oracle.py``).  All queries read whole tables; parameters
below are fixed values of the queries, not samples.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions import encode as E
from ..functions import jsonfields as J
from ..functions.responses import response_status
from ..operators import counts, dedup, emoji, payloads, routing, sieve, splitting
from ..sources import tables as T
from . import jobs

# Fixed query parameters.
URL_TEMPLATE = "https://graph.example/teams/<team_id>/channels/<channel_id>/posts"
USERS_URL = "https://graph.example/teams/<team_id>/users"
CHANNELS_URL = "https://graph.example/teams/<team_id>/channels"
TEAM_URL = "https://graph.example/teams/<team_id>"
ROUTE_MIN_MEMBERS = 60
WINDOW_SIZE = "1 hour"
WINDOW_SLIDE = "15 minutes"
BLACKLIST = ["channel_join"]
SPLIT_K = 4
USER_BATCH = 500
CHANNEL_BATCH = 10
TEAM_BATCH = 1000
CHUNK = payloads.DEFAULT_CHUNK
SLICE = 50


def _stored(spark, payload_frame, deliver, name):
    """Deliver payloads, store the receipts in the shared folder and read them back."""
    from ..session import scratch_path
    from ..sinks import delivery
    path = scratch_path(spark, name)
    delivery.write_batch(delivery.deliver_payloads(payload_frame, deliver), path, 0)
    return delivery.read_batch(spark, path, 0, delivery.RECEIPTS)


def _posts(spark, sf_dir, size=None):
    return payloads.post_payloads(sieve.sieve(_messages(spark, sf_dir)), URL_TEMPLATE,
                                  channel_teams=T.load_channels(spark, sf_dir),
                                  chunk_size=size or CHUNK)


def _messages(spark, sf_dir) -> DataFrame:
    return T.load_messages(spark, sf_dir)


def q_sieve_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F-1..F-6 + AGG-3 (flagship): per channel and category, messages seen
    and notable messages kept."""
    return counts.sieve_counts(_messages(spark, sf_dir))


def q_skipped_channels(spark, sf_dir):
    """F-7: listed channels with nothing to deliver."""
    chans = T.load_channels(spark, sf_dir)
    skipped = sieve.skipped_channels(chans, sieve.sieve(_messages(spark, sf_dir)))
    return skipped.select(F.col("id").alias("channel"), "name")


def q_channel_activity(spark, sf_dir):
    """F-7 / AGG-3: every listed channel with its notable count."""
    chans = T.load_channels(spark, sf_dir)
    per = sieve.sieve(_messages(spark, sf_dir)).groupBy("channel").agg(F.count("*").alias("n_notable"))
    j = chans.join(per, chans["id"] == per["channel"], "left")
    n = F.coalesce(F.col("n_notable"), F.lit(0)).cast("bigint")
    return j.select(F.col("id").alias("channel"), n.alias("n_notable"), (n == 0).alias("skipped"))


def q_conversation_posts(spark, sf_dir):
    """F-1..F-7 + X-3 over whole conversation texts: per conversation, the
    posts seen, the notable ones and whether it is skipped."""
    m = T.load_conversation_messages(spark, sf_dir)
    per = sieve.with_notable(m).groupBy("channel").agg(
        F.count("*").alias("n_messages"), F.count_if(F.col("notable")).alias("n_notable"),
        F.sum(F.size("mentions")).cast("bigint").alias("n_mentions"))
    return per.withColumn("skipped", F.col("n_notable") == 0)


def q_json_presence(spark, sf_dir):
    """J-1..J-3 + F-4 over the raw text of every whitelisted message."""
    m = _messages(spark, sf_dir).filter(F.col("category") == C.WHITELISTED)
    v = J.parse(F.col("raw"))
    r, me, rp = J.reactions_field(v), J.mentions_field(v), J.replies_field(v)
    return m.select(
        "seq", v.isNotNull().alias("parse_ok"),
        r.isNotNull().alias("has_reactions"), F.when(r.isNotNull(), F.size(r)).alias("n_reactions"),
        me.isNotNull().alias("has_mentions"), F.when(me.isNotNull(), F.size(me)).alias("n_mentions"),
        rp.isNotNull().alias("has_replies"), F.when(rp.isNotNull(), F.size(rp)).alias("n_replies"),
        sieve.keep_whitelisted().alias("keep"))


def _encode_query(category):
    def q(spark, sf_dir):
        m = _messages(spark, sf_dir).filter(F.col("category") == category)
        return E.with_encoded(m, category).select("seq", "json")
    q.__doc__ = f"E-1..E-4: the delivered JSON of every {category} message."
    return q


q_encode_file_share = _encode_query(C.FILE_SHARE)
q_encode_bot = _encode_query(C.BOT)
q_encode_user_attachment = _encode_query(C.USER_ATTACHMENT)
q_encode_file_comment = _encode_query(C.FILE_COMMENT)


def q_encode_users(spark, sf_dir):
    """E-7 for user records."""
    u = T.load_users(spark, sf_dir)
    return u.select("id", E.encode_record(*u.columns).alias("json"))


def q_encode_channels(spark, sf_dir):
    """E-7 for channel records."""
    c = T.load_channels(spark, sf_dir)
    return c.select("id", E.encode_record(*c.columns).alias("json"))


def q_post_payloads(spark, sf_dir):
    """AGG-2 + UN-1 + STR-1 + E-1..E-4: delivery payloads of all channels."""
    notable = sieve.sieve(_messages(spark, sf_dir))
    p = payloads.post_payloads(notable, URL_TEMPLATE,
                               channel_teams=T.load_channels(spark, sf_dir), chunk_size=CHUNK)
    return p.select("team_id", "channel", "chunk", "url", "n_items", "first_seq", "last_seq",
                    "body", "key")


def q_post_payload_slices(spark, sf_dir):
    """AGG-2 with exact slices: each channel's delivery-ordered list cut
    into payloads of SLICE messages (distributed rank within channel)."""
    notable = sieve.sieve(_messages(spark, sf_dir))
    p = payloads.post_payloads(notable, URL_TEMPLATE, channel_teams=T.load_channels(spark, sf_dir),
                               chunk_size=SLICE)
    return p.select("channel", "chunk", "n_items", "first_seq", "last_seq", "key")


def q_channel_posts(spark, sf_dir):
    """E-5 + E-6: channel-posts records, items in order A."""
    notable = sieve.sieve(_messages(spark, sf_dir))
    return payloads.channel_posts(notable, chunk_size=CHUNK)


def _routes(spark, sf_dir):
    return routing.route_channels(T.load_channels(spark, sf_dir), ROUTE_MIN_MEMBERS)


def q_route_channels(spark, sf_dir):
    """RT-1: channels labelled by size."""
    return _routes(spark, sf_dir).select(F.col("id").alias("channel"), "num_members", "route")


def q_route_windows(spark, sf_dir):
    """WIN-1: messages and distinct channels per sliding window and channel
    route."""
    routes = _routes(spark, sf_dir).select(F.col("id").alias("channel"), "route")
    m = _messages(spark, sf_dir).select("channel", "event_time")
    w = routing.routed_pane_windows(m, routes, "event_time", WINDOW_SIZE, WINDOW_SLIDE)
    return w.select(F.unix_seconds(F.col("window.start")).alias("window_start"),
                    F.unix_seconds(F.col("window.end")).alias("window_end"),
                    "route", "n", F.col("n_items").alias("n_channels"))


def q_route_window_channels(spark, sf_dir):
    """AGG-1 + WIN-1: the channels of each sliding window and route, one row
    per member."""
    routes = _routes(spark, sf_dir).select(F.col("id").alias("channel"), "route")
    m = _messages(spark, sf_dir).select("channel", "event_time")
    w = routing.pane_window_members(m, routes, "event_time", WINDOW_SIZE, WINDOW_SLIDE)
    return w.select(F.unix_seconds(F.col("window.start")).alias("window_start"),
                    "route", "channel")


def q_route_report(spark, sf_dir):
    """JOB-5 with the original's example parameters: channels routed by
    ``num_members >= 5``, messages in 1 s windows sliding by 100 ms."""
    _, windows = jobs.route_report(T.load_channels(spark, sf_dir),
                                   _messages(spark, sf_dir).select("channel", "event_time"),
                                   min_members=5, size="1 second", slide="100 milliseconds")
    return windows.select(F.unix_millis(F.col("window.start")).alias("window_start_ms"),
                          "route", "n", F.col("n_items").alias("n_channels"))


def q_display_channels(spark, sf_dir):
    """JOB-5 + SNK-5: the members of every channel, printed per route."""
    from ..session import scratch_path
    from ..sinks.delivery import print_sink
    path = scratch_path(spark, "printed-channels")
    print_sink(_routes(spark, sf_dir).select("route", "num_members"), path)
    return spark.read.text(path).groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))


def q_classify(spark, sf_dir):
    """X-1: category of every message."""
    return _messages(spark, sf_dir).select("seq", "channel", "category", "category_ord")


def q_mentions(spark, sf_dir):
    """X-3 over the whole text of every document."""
    d = T.documents_with_mentions(T.read_table(spark, sf_dir, "documents"))
    ids = J.extract_mentions(F.col("text"))
    return d.select("doc_id", F.size(ids).alias("n_mentions"),
                    F.array_join(ids, ",").alias("mentions"))


def q_emoji_alias(spark, sf_dir):
    """X-4: emoji aliases resolved one level within a team."""
    return emoji.resolve_aliases(T.load_emojis(spark, sf_dir))


def q_blacklist(spark, sf_dir):
    """X-2: messages left per channel and category after the blacklist."""
    m = C.drop_blacklisted(_messages(spark, sf_dir), BLACKLIST)
    return m.groupBy("channel", "category").agg(F.count("*").alias("n"))


def q_split_ids(spark, sf_dir):
    """PART-1: user ids in SPLIT_K groups of near-equal size, in id order."""
    return splitting.split_ids(T.load_users(spark, sf_dir), SPLIT_K)


def q_response_status(spark, sf_dir):
    """R-1: every reply body classified OK / NOK / UNKNOWN."""
    r = T.responses_from_events(T.read_table(spark, sf_dir, "events"))
    return r.select("event_id", response_status(F.col("body")).alias("status"))


def q_dedup_posts(spark, sf_dir):
    """ST-2: a full replay of the messages adds nothing."""
    m = _messages(spark, sf_dir)
    replayed = m.unionByName(m)
    return (dedup.dedup_messages(replayed).groupBy("channel")
            .agg(F.count("*").alias("n_messages")))


def _users(spark, sf_dir):
    return jobs.seed_users(T.load_users(spark, sf_dir), USER_BATCH, USERS_URL)


def _channel_batches(spark, sf_dir):
    return jobs.seed_channels(T.load_channels(spark, sf_dir), CHANNEL_BATCH, CHANNELS_URL)


def _teams(spark, sf_dir):
    return jobs.team_payload(T.load_teams(spark, sf_dir), T.load_emojis(spark, sf_dir), TEAM_BATCH,
                             TEAM_URL)


def q_seed_users(spark, sf_dir):
    """JOB-1: user listing payloads of each team, at most USER_BATCH records."""
    return _users(spark, sf_dir).select("team_id", "chunk", "url", "n_items", "first_id", "last_id",
                                        "key")


def q_seed_channels(spark, sf_dir):
    """JOB-2: channel listing payloads of each team, at most CHANNEL_BATCH records."""
    return _channel_batches(spark, sf_dir).select("team_id", "chunk", "url", "n_items", "first_id",
                                                  "last_id", "key")


def _delivered(build, name):
    def q(spark, sf_dir):
        from ..sinks.delivery import selective_service
        return _stored(spark, build(spark, sf_dir), selective_service, name).select(
            "team_id", "chunk", "url", "n_items", "key", "status")
    return q


q_deliver_users = _delivered(_users, "user-receipts")
q_deliver_users.__doc__ = "SNK-2 + R-1: receipts of the user payloads from a service that refuses some."
q_deliver_channels = _delivered(_channel_batches, "channel-receipts")
q_deliver_channels.__doc__ = "SNK-3 + R-1: receipts of the channel payloads."
q_deliver_team = _delivered(_teams, "team-receipts")
q_deliver_team.__doc__ = "SNK-4 + R-1: receipts of the team payloads."


def q_seed_posts(spark, sf_dir):
    """JOB-3: listed channels, blacklist, classify, sieve and payloads of at most
    SLICE messages; one row per channel."""
    p = jobs.seed_posts(_messages(spark, sf_dir), URL_TEMPLATE, BLACKLIST,
                        channel_teams=T.load_channels(spark, sf_dir), chunk_size=SLICE)
    return p.groupBy("channel").agg(F.count("*").alias("n_payloads"),
                                    F.sum("n_items").cast("bigint").alias("n_items"))


def q_team_info(spark, sf_dir):
    """JOB-4 + SRC-3: teams with their emoji counts."""
    return jobs.team_info(T.load_teams(spark, sf_dir), T.load_emojis(spark, sf_dir))


def q_run_metrics(spark, sf_dir):
    """AGG-4: the six counters of a run whose four sinks meet a service that
    refuses some payloads, and the payloads refused."""
    from ..sinks.delivery import selective_service
    build = [_posts(spark, sf_dir, SLICE), _users(spark, sf_dir), _channel_batches(spark, sf_dir),
             _teams(spark, sf_dir)]
    receipts = [_stored(spark, p, selective_service, "run-receipts") for p in build]
    every = receipts[0].unionByName(receipts[1]).unionByName(receipts[2]).unionByName(receipts[3])
    return counts.run_metrics(T.load_channels(spark, sf_dir), sieve.sieve(_messages(spark, sf_dir)),
                              every)


def q_listing_totals(spark, sf_dir):
    """AGG-5 + F-8: listing sizes (users, channels, teams with an id)."""
    u = T.load_users(spark, sf_dir).agg(F.count("*").alias("value")).select(
        F.lit("users").alias("listing"), "value")
    c = T.load_channels(spark, sf_dir).agg(F.count("*").alias("value")).select(
        F.lit("channels").alias("listing"), "value")
    t = sieve.nonempty_listing(T.load_teams(spark, sf_dir)).agg(
        F.count("*").alias("value")).select(F.lit("teams").alias("listing"), "value")
    return u.unionByName(c).unionByName(t)


def q_channel_totals(spark, sf_dir):
    """AGG-3 per channel with one column per category."""
    return counts.channel_totals(sieve.sieve(_messages(spark, sf_dir)))


def q_stream_windows(spark, sf_dir):
    """SRC-10 + WM-1 + WIN-1 as a stream: closed windows per category."""
    from ..streaming import streams
    w = streams.stream_windows(spark, sf_dir, WINDOW_SIZE, WINDOW_SLIDE)
    return w.select(F.unix_seconds(F.col("window.start")).alias("window_start"),
                    F.unix_seconds(F.col("window.end")).alias("window_end"), "category", "n")


def q_stream_sieve(spark, sf_dir):
    """SRC-10 + ST-2 + F-6 + SNK-1 as a stream with a replay-safe sink."""
    from ..streaming import streams
    return streams.stream_sieve_counts(spark, sf_dir)


def q_stream_posts(spark, sf_dir):
    """SRC-10 + JOB-3 as a stream over landed history pages, delivering
    payloads per micro-batch; items delivered per channel."""
    from ..session import scratch_path
    from ..sources import landing
    from ..streaming import streams
    pages_path = scratch_path(spark, "stream-pages")
    landing.land_history_pages(_messages(spark, sf_dir), pages_path)
    from ..sinks.delivery import accepting_service
    out = streams.stream_posts(spark, pages_path, URL_TEMPLATE,
                               channel_teams=T.load_channels(spark, sf_dir), blacklist=BLACKLIST,
                               deliver=accepting_service)
    from ..sinks.ledger import Ledger
    receipts = Ledger(spark, out + "/receipts").state()
    return (receipts.filter(F.col("status") == "OK").groupBy("channel")
            .agg(F.sum("n_items").cast("bigint").alias("n_items")))


def q_deliver_posts(spark, sf_dir):
    """SNK-1 + R-1 + R-2: payloads handed to a delivery function inside the
    tasks, receipts stored, responses classified, and the run failed on any
    non-OK response (checked on the stored receipts, so nothing is
    delivered twice)."""
    from ..sinks import delivery
    receipts = _stored(spark, _posts(spark, sf_dir), delivery.accepting_service, "deliveries")
    delivery.check_receipts(receipts)
    return receipts.select("channel", "chunk", "key", "n_items", "status")


def q_redelivery(spark, sf_dir):
    """SNK-1 + R-2: payloads delivered to a service that refuses a third at first; only
    what was refused is delivered again, so every key is accepted once."""
    from ..session import scratch_path, stored
    from ..sinks import ledger
    payloads_ = stored(_posts(spark, sf_dir, SLICE), "redelivered-posts")
    book = ledger.Ledger(spark, scratch_path(spark, "ledger"))
    book.deliver(payloads_, ledger.recovering_service)
    return book.state().select("channel", "chunk", "key", "n_items", "attempts", "accepted", "status")


def q_deliver_posts_writer(spark, sf_dir):
    """SNK-1 + R-1 + R-2 through ``df.write.format``: payloads delivered by the data
    source's writer, its published receipts read back."""
    from ..session import scratch_path
    from ..sinks import datasource
    datasource.register(spark)
    path = scratch_path(spark, "written-posts")
    (_posts(spark, sf_dir).write.format(datasource.FORMAT).mode("append").option("path", path)
     .option("service", "sievery.sinks.delivery:accepting_service").save())
    return datasource.read_receipts(spark, path).select("channel", "chunk", "key", "n_items", "status")


def q_delivered_metrics(spark, sf_dir):
    """AGG-4 after delivery (D7): sink counters from OK receipts only."""
    from ..sinks import delivery
    return counts.delivered_metrics(
        _stored(spark, _posts(spark, sf_dir, SLICE), delivery.selective_service, "receipts"))


def q_history_pages(spark, sf_dir):
    """SRC-5/SRC-6 + X-3 on landed pages: the messages are written as API
    history pages (one folder per channel) and read back with the page
    reader, then sieved and counted (equals the direct sieve)."""
    from ..session import scratch_path
    from ..sources import landing, pages
    path = scratch_path(spark, "history-pages")
    landing.land_history_pages(_messages(spark, sf_dir), path)
    msgs, _ = pages.read_conversations(spark, path)
    return (sieve.sieve(msgs).groupBy("channel", "category")
            .agg(F.count("*").alias("n_kept")))


def q_channel_pages(spark, sf_dir):
    """SRC-8 + PART-1: pages in two landings, read by a source that is split by channel ids;
    notable messages per channel and category, and the input splits that a channel is in."""
    from ..session import scratch_path
    from ..sources import channelpages, landing, pages
    path = scratch_path(spark, "channel-pages")
    m = _messages(spark, sf_dir)
    for n, half in enumerate((F.col("seq") % 2 == 0, F.col("seq") % 2 == 1)):
        channelpages.land_channel_folders(landing.history_page_lines(m.filter(half)), path, n)
    read = channelpages.read_channel_pages(spark, path, SPLIT_K)
    found = C.with_category(pages.valid_canonical(pages.wire_messages(read))).withColumn(
        "split", F.spark_partition_id())
    return (sieve.sieve(found).groupBy("channel", "category")
            .agg(F.count("*").alias("n_kept"), F.count_distinct("split").alias("n_splits")))


def q_listing_pages(spark, sf_dir):
    """SRC-1..SRC-4 + E-7: users, channels, team and emoji listings landed
    as API pages, read back with the page readers and encoded again."""
    from ..session import scratch_path
    from ..sources import landing, pages
    root = scratch_path(spark, "listing-pages")
    landing.land_user_pages(T.load_users(spark, sf_dir), root + "/users")
    landing.land_channel_pages(T.load_channels(spark, sf_dir), root + "/channels")
    landing.land_team_pages(T.load_teams(spark, sf_dir), root + "/team")
    landing.land_emoji_pages(T.load_emojis(spark, sf_dir), root + "/emoji")
    users, _ = pages.read_users(spark, root + "/users")
    chans, _ = pages.read_channels(spark, root + "/channels")
    team, emojis, _ = pages.read_team_info(spark, root + "/team", root + "/emoji")
    team = team.drop("n_emojis")
    out = [users.select(F.lit("users").alias("listing"), "id", E.encode_record(*users.columns).alias("json")),
           chans.select(F.lit("channels").alias("listing"), "id", E.encode_record(*chans.columns).alias("json")),
           team.select(F.lit("team").alias("listing"), "id", E.encode_record(*team.columns).alias("json")),
           emojis.select(F.lit("emoji").alias("listing"), F.concat_ws("/", "team_id", "name").alias("id"),
                         E.encode_record("url", "alias_of").alias("json"))]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


def q_rejects(spark, sf_dir):
    """LOG-1: rows set aside with a reason (unreadable raw messages,
    blacklisted subtypes, unresolved emoji aliases, refused deliveries)."""
    from ..sinks import delivery
    m = _messages(spark, sf_dir)
    receipts = _stored(spark, _posts(spark, sf_dir, SLICE), delivery.selective_service, "receipts")
    return (sieve.unparsable_rejects(m)
            .unionByName(C.blacklisted_rejects(m, BLACKLIST))
            .unionByName(emoji.alias_rejects(emoji.resolve_aliases(T.load_emojis(spark, sf_dir))))
            .unionByName(delivery.receipt_rejects(receipts)))


def q_team_payload(spark, sf_dir):
    """SNK-4 / E-7: team records with their emojis, TEAM_BATCH emojis per
    payload."""
    return _teams(spark, sf_dir).select("team_id", "chunk", "url", "n_items", "key")


def q_union_categories(spark, sf_dir):
    """UN-1: the five per-category frames stacked in the fixed order."""
    m = _messages(spark, sf_dir).select("category", "seq")
    stacked = payloads.union_categories(*[m.filter(F.col("category") == c) for c in C.ORDER_B])
    return stacked.groupBy("category", "category_ord").agg(
        F.count("*").alias("n"), F.sum("seq").cast("bigint").alias("seqs"))


def q_dedup_versions(spark, sf_dir):
    """ST-2 + F-6: every message lands twice, without and with its reactions
    (odd ones in that order, even ones the other way round); sieved first, then
    the latest notable version stays."""
    m = _messages(spark, sf_dir)
    later = F.lit(1 << 40)
    plain = m.withColumn("reactions", F.expr("filter(reactions, x -> false)")).withColumn(
        "seq", F.when(F.col("seq") % 2 == 0, F.col("seq") + later).otherwise(F.col("seq")))
    full = m.withColumn("seq", F.when(F.col("seq") % 2 == 0, F.col("seq")).otherwise(
        F.col("seq") + later))
    kept = dedup.dedup_messages(sieve.sieve(plain.unionByName(full)))
    return kept.groupBy("channel", "category").agg(
        F.count("*").alias("n_kept"), F.count_if(F.size("reactions") > 0).alias("n_reacted"))


def q_unnumbered_pages(spark, sf_dir):
    """SRC-5 + X-3 + AGG-2 on pages without numbers, as the API sends them: a
    channel of n notable messages has ceil(n / SLICE) payloads."""
    from ..session import scratch_path
    from ..sources import landing, pages
    path = scratch_path(spark, "plain-pages")
    landing.land_history_pages(_messages(spark, sf_dir), path, numbered=False)
    m, _ = pages.read_conversations(spark, path)
    p = payloads.post_payloads(sieve.sieve(m), URL_TEMPLATE, team_id="T0", chunk_size=SLICE)
    return p.select("channel", "chunk", "n_items", "first_seq", "last_seq")


def q_page_rejects(spark, sf_dir):
    """SRC-9 + LOG-1: error pages (one per region) among the history pages, and
    messages that are not JSON objects, as rejects."""
    from ..session import scratch_path
    from ..sources import landing, pages
    path = scratch_path(spark, "faulty-pages")
    landing.land_history_pages(_messages(spark, sf_dir), path + "/history")
    (T.read_table(spark, sf_dir, "region")
     .select(F.to_json(F.struct(F.lit(False).alias("ok"), F.concat(
         F.lit("no_access_"), F.lower("r_name")).alias("error"))).alias("value"))
     .write.text(path + "/errors"))
    _, rejects = pages.read_conversations(spark, [path + "/history", path + "/errors"])
    return rejects.groupBy("source", "reason").agg(F.count("*").alias("n"))


def q_landed_twice(spark, sf_dir):
    """ST-2 + JOB-3: the same history landed in two folders gives the payloads of one."""
    from ..session import scratch_path
    from ..sources import landing, pages
    path = scratch_path(spark, "landed-twice")
    for folder in ("/first", "/again"):
        landing.land_history_pages(_messages(spark, sf_dir), path + folder)
    m, _ = pages.read_conversations(spark, [path + "/first", path + "/again"])
    p = jobs.seed_posts(m, URL_TEMPLATE, BLACKLIST, channel_teams=T.load_channels(spark, sf_dir),
                        chunk_size=SLICE)
    return p.groupBy("channel").agg(F.count("*").alias("n_payloads"),
                                    F.sum("n_items").cast("bigint").alias("n_items"))


def _faulty_lines(spark, sf_dir):
    """Lines that a landing may leave: cut-short pages (one per supplier), error pages (one
    per region), and pages with messages without a readable time (one per nation)."""
    cut = T.read_table(spark, sf_dir, "supplier").selectExpr(
        """concat('{"ok":true,"channel":"S', cast(s_suppkey AS string), '","messages":[{"ts":"17')  AS value""")
    error = T.read_table(spark, sf_dir, "region").selectExpr(
        """concat('{"ok":false,"error":"no_access_', lower(r_name), '"}') AS value""")
    untimed = T.read_table(spark, sf_dir, "nation").selectExpr(
        """concat('{"ok":true,"channel":"N', cast(n_nationkey AS string), '","messages":[{"ts":"soon","text":"',
                  n_name, '"},{"text":"no time"},{"ts":"1700000000.00000', cast(n_nationkey % 10 AS string),
                  '","text":"fine"}]}') AS value""")
    return cut.unionByName(error).unionByName(untimed)


def q_corrupt_pages(spark, sf_dir):
    """SRC-9 + LOG-1 in a stream: the texts of faulty pages and messages among the
    history pages, with what is wrong with them."""
    from ..session import scratch_path
    from ..sources import landing
    from ..streaming import streams
    path = scratch_path(spark, "corrupt-pages")
    landing.land_history_pages(_messages(spark, sf_dir), path)
    _faulty_lines(spark, sf_dir).write.mode("append").text(path)
    return streams.stream_rejected_texts(spark, path).groupBy("source", "key", "reason", "text").agg(
        F.count("*").alias("n"))


def q_place_groups(spark, sf_dir):
    """PART-1 as placement: SPLIT_K groups of user ids, each in a task of its own."""
    users = T.load_users(spark, sf_dir).select("id", "name")
    placed = splitting.place_groups(users, splitting.split_ids(users, SPLIT_K), SPLIT_K)
    return placed.withColumn("task", F.spark_partition_id()).groupBy("part").agg(
        F.count("*").alias("n_users"), F.count_distinct("task").alias("n_tasks"),
        F.min("task").alias("task"))


def _event_files(spark, sf_dir, slices=8):
    """The events in files of ``slices`` slices that follow each other in time and overlap by
    less than a day, written in one pass, and stamped in that order, which is the order
    in which a stream reads them."""
    from ..session import scratch_path
    path = scratch_path(spark, "event-files")
    events = T.read_table(spark, sf_dir, "events")
    us = F.expr(f"{T.micros_since_epoch_sql('ts')} + pmod(event_id, 8) * 10000000000")
    low, high = events.agg(F.min(us), F.max(us)).first()
    part = F.least(F.floor((us - F.lit(low)) / F.lit(max(1, (high - low) / slices))), F.lit(slices - 1))
    events.repartitionById(slices, part.cast("int")).write.parquet(path)         # task k writes slice k
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for k in range(slices):
        for file in system.globStatus(hadoop.Path(f"{path}/part-{k:05}-*")):
            system.setTimes(file.getPath(), 1700000000000 + 60000 * k, -1)
    return path


def q_stream_sieve_files(spark, sf_dir):
    """SRC-10 + ST-2 + F-6 as a stream, one file a batch, over overlapping files."""
    from ..streaming import streams
    return streams.stream_sieve_counts(spark, path=_event_files(spark, sf_dir), max_files=1)


def q_stream_windows_files(spark, sf_dir):
    """SRC-10 + WM-1 + WIN-1 as a stream, one file a batch, over overlapping
    files; the watermark waits a day."""
    from ..streaming import streams
    w = streams.stream_windows(spark, size=WINDOW_SIZE, slide=WINDOW_SLIDE, watermark="1 day",
                               path=_event_files(spark, sf_dir), max_files=1)
    return w.select(F.unix_seconds(F.col("window.start")).alias("window_start"),
                    F.unix_seconds(F.col("window.end")).alias("window_end"), "category", "n")


def _route_stream(spark, sf_dir, out=None):
    from ..streaming import streams
    routes = _routes(spark, sf_dir).select(F.col("id").alias("channel"), "route")
    return streams.stream_route_windows(spark, routes, sf_dir, WINDOW_SIZE, WINDOW_SLIDE, out=out)


def q_stream_route_windows(spark, sf_dir):
    """JOB-5 + WIN-1 + WM-1 + RT-1 as a stream: messages and channels of each closed window
    and route, exact."""
    return _route_stream(spark, sf_dir).select(
        F.unix_seconds(F.col("window.start")).alias("window_start"),
        F.unix_seconds(F.col("window.end")).alias("window_end"), "route", "n",
        F.col("n_items").alias("n_channels"))


def q_stream_state_summary(spark, sf_dir):
    """ST-3: the state that the route windows' stream left in its checkpoint, looked at
    before a restart: stateful operators and the keys of windows still open."""
    from ..session import scratch_path
    from ..streaming import state
    out = scratch_path(spark, "route-windows-state")
    _route_stream(spark, sf_dir, out)
    partitions = state.state_operators(spark, out + "/checkpoint").first()["partitions"]
    state.check_state(spark, out + "/checkpoint", {"stateStoreSave": 2}, partitions)
    return state.state_summary(spark, out + "/checkpoint").groupBy("name").agg(
        F.count_distinct("operator").alias("n_operators"), F.sum("keys").alias("n_keys"))


def q_stream_channel_progress(spark, sf_dir):
    """ST-1 with state: last time, messages, restarts seen and silence of every listed or
    seen channel, from a stream that is stopped after the earlier half of the time and
    started again for the later one."""
    from ..session import scratch_path
    from ..streaming import progress, streams
    path, out = scratch_path(spark, "progress-events"), progress.progress_path(spark)
    events = T.read_table(spark, sf_dir, "events")
    us = T.micros_since_epoch("ts")
    low, high = events.agg(F.min(us), F.max(us)).first()
    middle = low + (high - low) // 2
    for run, half in enumerate((us < middle, us >= middle)):
        events.filter(half).write.mode("append").parquet(path)
        progress.run_progress(spark, streams.message_stream(spark, path=path), out, run,
                              listing=T.load_channels(spark, sf_dir), silence="1 hour")
    return progress.latest_progress(spark, out)


def q_stream_counters(spark, sf_dir):
    """AGG-4 of a stream of eight files, one a batch: the counters that its batches observed,
    and the rows that came later than the watermark."""
    from ..session import scratch_path
    from ..streaming import counters as SC
    from ..streaming import streams
    out, listener = scratch_path(spark, "counted"), SC.StreamCounters()
    m = SC.message_counters(streams.message_stream(spark, path=_event_files(spark, sf_dir), max_files=1),
                            sieve.is_notable())
    w = streams.windowed_counts(m, WINDOW_SIZE, WINDOW_SLIDE, "1 day")
    SC.run_counted(spark, w.writeStream.format("parquet").option("path", out + "/data")
                   .option("checkpointLocation", out + "/checkpoint"), listener)
    return listener.frame(spark)


# when the responses of q_stream_team_info came: a team's ten minutes apart, its emojis so many
# seconds later; T2's come after the limit, T3's never
RESPONSES_FROM = 1700000000
EMOJIS_AFTER = {"T0": 10, "T1": 30, "T2": 180, "T4": 120}


def q_stream_team_info(spark, sf_dir):
    """SRC-3 + JOB-4 as a stream: team and emoji responses merged as they come, within two
    minutes; a team whose emojis come late or never has none."""
    from ..session import scratch_path
    from ..sources import landing
    from ..streaming import streams
    path = scratch_path(spark, "team-responses")
    close = (RESPONSES_FROM + 86400) * 1000000
    team_at = f"({RESPONSES_FROM} + 600 * cast(substr(id, 2) AS bigint)) * 1000000"
    landing.land_team_pages(T.load_teams(spark, sf_dir), path + "/team",
                            F.expr(f"CASE WHEN id = '' THEN {close} ELSE {team_at} END"))
    after = " ".join(f"WHEN '{t}' THEN {s}" for t, s in EMOJIS_AFTER.items())
    emojis = T.load_emojis(spark, sf_dir).filter(F.col("team_id").isin(*EMOJIS_AFTER))
    last = T.load_emojis(spark, sf_dir).filter("team_id = 'T3'").withColumn("team_id", F.lit("closing"))
    landing.land_emoji_pages(
        emojis.unionByName(last), path + "/emoji",
        landed=F.expr(f"CASE WHEN team_id = 'closing' THEN {close} ELSE {team_at.replace('id,', 'team_id,')}"
                      f" + CASE team_id {after} END * 1000000 END"))
    return streams.stream_team_info(spark, path + "/team", path + "/emoji").select(
        "team_id", "name", "domain", F.unix_seconds("landed").alias("landed"), "n_emojis", "n_aliases")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sieve_counts": q_sieve_counts,
    "skipped_channels": q_skipped_channels,
    "channel_activity": q_channel_activity,
    "channel_totals": q_channel_totals,
    "conversation_posts": q_conversation_posts,
    "json_presence": q_json_presence,
    "encode_file_share": q_encode_file_share,
    "encode_bot": q_encode_bot,
    "encode_user_attachment": q_encode_user_attachment,
    "encode_file_comment": q_encode_file_comment,
    "encode_users": q_encode_users,
    "encode_channels": q_encode_channels,
    "post_payloads": q_post_payloads,
    "post_payload_slices": q_post_payload_slices,
    "channel_posts": q_channel_posts,
    "route_channels": q_route_channels,
    "route_windows": q_route_windows,
    "route_window_channels": q_route_window_channels,
    "route_report": q_route_report,
    "display_channels": q_display_channels,
    "classify": q_classify,
    "mentions": q_mentions,
    "emoji_alias": q_emoji_alias,
    "blacklist": q_blacklist,
    "split_ids": q_split_ids,
    "response_status": q_response_status,
    "dedup_posts": q_dedup_posts,
    "seed_users": q_seed_users,
    "seed_channels": q_seed_channels,
    "seed_posts": q_seed_posts,
    "team_info": q_team_info,
    "run_metrics": q_run_metrics,
    "listing_totals": q_listing_totals,
    "stream_windows": q_stream_windows,
    "stream_sieve": q_stream_sieve,
    "stream_posts": q_stream_posts,
    "deliver_posts": q_deliver_posts,
    "redelivery": q_redelivery,
    "deliver_posts_writer": q_deliver_posts_writer,
    "delivered_metrics": q_delivered_metrics,
    "history_pages": q_history_pages,
    "channel_pages": q_channel_pages,
    "listing_pages": q_listing_pages,
    "rejects": q_rejects,
    "team_payload": q_team_payload,
    "deliver_users": q_deliver_users,
    "deliver_channels": q_deliver_channels,
    "deliver_team": q_deliver_team,
    "union_categories": q_union_categories,
    "dedup_versions": q_dedup_versions,
    "unnumbered_pages": q_unnumbered_pages,
    "page_rejects": q_page_rejects,
    "landed_twice": q_landed_twice,
    "corrupt_pages": q_corrupt_pages,
    "place_groups": q_place_groups,
    "stream_sieve_files": q_stream_sieve_files,
    "stream_windows_files": q_stream_windows_files,
    "stream_route_windows": q_stream_route_windows,
    "stream_state_summary": q_stream_state_summary,
    "stream_channel_progress": q_stream_channel_progress,
    "stream_counters": q_stream_counters,
    "stream_team_info": q_stream_team_info,
}
