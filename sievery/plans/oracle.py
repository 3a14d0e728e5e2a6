"""DuckDB twins of the registered queries (``plans/catalog.py``).

The SQL re-derives the adapter views from the same parquet tables and
computes each result independently: the expected JSON texts are written out
by string assembly here, not produced by the encoders under test, so a
value-hash match checks the encoders byte for byte.
"""

from __future__ import annotations

from ..operators.payloads import DEFAULT_BYTES as MAX_BYTES
from . import catalog as Q


def _s(col: str) -> str:
    return f"CAST({col} AS VARCHAR)"


def _jq(col: str) -> str:
    """JSON text of a nullable plain string (no escaping needed here)."""
    return f"CASE WHEN {col} IS NULL THEN 'null' ELSE '\"' || {col} || '\"' END"


# ---------------------------------------------------------------- messages
_MESSAGES = f"""
ev AS (
  SELECT event_id, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         epoch_us(ts) AS us
  FROM events
),
shaped AS (
  SELECT event_id, user_id, event_type, k, us,
    'C' || {_s('user_id % 27')} AS channel,
    event_id AS seq,
    {_s('us // 1000000')} || '.' || lpad({_s('us % 1000000')}, 6, '0') AS ts,
    us // 1000000 AS secs,
    CASE WHEN event_type = 'error' THEN 'bot_message'
         WHEN event_type = 'view' THEN 'file_share'
         WHEN event_type = 'signup' THEN 'file_comment'
         WHEN event_type = 'purchase' AND k % 2 = 0 THEN 'channel_join' END AS subtype,
    event_type || ' #' || {_s('event_id')}
      || CASE WHEN k % 4 = 0 THEN ' cc <@U' || {_s('user_id')} || '>' ELSE '' END AS text,
    CASE WHEN event_type <> 'error' THEN 'U' || {_s('user_id')} END AS usr,
    CASE WHEN event_type = 'error' THEN 'bot-' || {_s('user_id')} END AS username,
    CASE WHEN event_type = 'error' THEN 'B' || {_s('user_id')} END AS bot_id,
    CASE WHEN event_type = 'signup' THEN 'note ' || {_s('event_id')} END AS comment,
    CASE WHEN event_type = 'click' THEN '[{{"id":"A' || {_s('event_id')} || '","k":' || {_s('k')} || '}}]'
         WHEN event_type = 'error' AND k % 2 = 1 THEN '[{{"id":"A' || {_s('event_id')} || '"}}]' END AS attachments,
    k % 3 = 0 AS has_reaction,
    k % 4 = 0 AS has_mention,
    k % 5 = 0 AS has_reply,
    (event_type = 'view' AND k % 7 = 0) AS has_comment
  FROM ev
),
lists AS (
  SELECT *,
    CASE WHEN has_reaction THEN '[{{"name":"tada","users":["U' || {_s('user_id + 1')} || '"],"count":1}}]' ELSE '[]' END AS reactions_json,
    CASE WHEN has_mention THEN '["U' || {_s('user_id')} || '"]' ELSE '[]' END AS mentions_json,
    CASE WHEN has_reply THEN '[{{"ts":"' || ts || '","user":"U' || {_s('user_id + 2')} || '"}}]' ELSE '[]' END AS replies_json,
    CASE WHEN has_comment THEN '[{{"id":"Fc' || {_s('event_id')} || '","timestamp":' || {_s('secs')} || ',"user":"U' || {_s('user_id')} || '"}}]' ELSE '[]' END AS comments_json,
    CASE WHEN event_type IN ('view', 'signup') THEN
      '{{"filetype":"text","id":"F' || {_s('event_id')} || '","title":"file ' || {_s('event_id')}
      || '","url_private":"https://files.example/F' || {_s('event_id')} || '","external_type":null,"timestamp":'
      || {_s('secs')} || ',"pretty_type":"Plain Text","name":"F' || {_s('event_id')}
      || '.txt","mimetype":"text/plain","permalink":"https://files.example/p/F' || {_s('event_id')}
      || '","created":' || {_s('secs')} || ',"mode":"hosted","thumb_64":null,"thumb_80":null,"thumb_360":null}}'
    ELSE 'null' END AS file_json
  FROM shaped
),
rawed AS (
  SELECT *,
    CASE WHEN event_type = 'purchase' THEN
      CASE WHEN k % 13 = 0 THEN left(full_raw, length(full_raw) - 1) ELSE full_raw END END AS raw
  FROM (
    SELECT *,
      '{{"type":"message",' || CASE WHEN subtype IS NOT NULL THEN '"subtype":"' || subtype || '",' ELSE '' END
      || '"user":' || {_jq('usr')} || ',"text":"' || text || '","ts":"' || ts || '",'
      || CASE WHEN k % 11 = 0 THEN '"key":{{' || list_body || '}}' ELSE list_body END || '}}' AS full_raw
    FROM (
      SELECT *, '"reactions":' || reactions_json || ',"mentions":' || mentions_json
                || CASE WHEN has_reply THEN ',"replies":' || replies_json ELSE '' END AS list_body
      FROM lists))
),
classified AS (
  SELECT *,
    CASE WHEN subtype = 'file_share' THEN 'file_share'
         WHEN subtype = 'file_comment' THEN 'file_comment'
         WHEN bot_id IS NOT NULL OR subtype = 'bot_message' THEN 'bot'
         WHEN coalesce(json_array_length(attachments) > 0, false) THEN 'user_attachment'
         ELSE 'whitelisted' END AS category
  FROM rawed
),
messages AS (
  SELECT *,
    CAST(CASE category WHEN 'bot' THEN 1 WHEN 'user_attachment' THEN 2 WHEN 'file_share' THEN 3
                       WHEN 'file_comment' THEN 4 WHEN 'whitelisted' THEN 5 END AS INTEGER) AS category_ord,
    CASE category WHEN 'bot' THEN 1 WHEN 'file_share' THEN 2 WHEN 'user_attachment' THEN 3
                  WHEN 'file_comment' THEN 4 WHEN 'whitelisted' THEN 5 END AS order_a,
    CASE WHEN category IN ('bot', 'user_attachment', 'file_comment') THEN has_reaction OR has_mention
         WHEN category = 'file_share' THEN has_mention OR has_comment
         WHEN category = 'whitelisted' THEN
           CASE WHEN json_valid(raw) THEN
             coalesce(json_type(raw, '$.reactions') = 'ARRAY' AND json_array_length(raw, '$.reactions') > 0, false)
             OR coalesce(json_type(raw, '$.mentions') = 'ARRAY' AND json_array_length(raw, '$.mentions') > 0, false)
             OR coalesce(json_type(raw, '$.replies') = 'ARRAY' AND json_array_length(raw, '$.replies') > 0, false)
           ELSE false END
         ELSE false END AS notable
  FROM classified
)"""

# Expected delivered JSON per record kind.
_BOT_JSON = f"""'{{"type":"message","subtype":' || {_jq('subtype')} || ',"text":"' || text || '","ts":"' || ts || '"'
  || CASE WHEN bot_id IS NOT NULL THEN ',"bot_id":"' || bot_id || '"' ELSE '' END
  || CASE WHEN username IS NOT NULL THEN ',"username":"' || username || '"' ELSE '' END
  || CASE WHEN attachments IS NOT NULL THEN ',"attachments":' || attachments ELSE '' END
  || CASE WHEN has_reaction THEN ',"reactions":' || reactions_json ELSE '' END
  || CASE WHEN has_reply THEN ',"replies":' || replies_json ELSE '' END
  || CASE WHEN has_mention THEN ',"mentions":' || mentions_json ELSE '' END || '}}'"""

_USER_ATTACHMENT_JSON = f"""'{{"type":"message","text":"' || text || '","ts":"' || ts || '"'
  || CASE WHEN usr IS NOT NULL THEN ',"user":"' || usr || '"' ELSE '' END
  || CASE WHEN coalesce(json_array_length(attachments) > 0, false) THEN ',"attachments":' || attachments ELSE '' END
  || CASE WHEN has_reaction THEN ',"reactions":' || reactions_json ELSE '' END
  || CASE WHEN has_reply THEN ',"replies":' || replies_json ELSE '' END
  || CASE WHEN has_mention THEN ',"mentions":' || mentions_json ELSE '' END || '}}'"""

_FILE_SHARE_JSON = f"""'{{"type":"message","subtype":' || {_jq('subtype')} || ',"text":"' || text
  || '","file":' || file_json || ',"comments":' || comments_json || ',"ts":"' || ts || '"'
  || CASE WHEN comment IS NOT NULL AND comment <> '' THEN ',"comment":"' || comment || '"' ELSE '' END
  || ',"user":' || {_jq('usr')} || ',"bot_id":' || {_jq('bot_id')}
  || CASE WHEN has_mention THEN ',"mentions":' || mentions_json ELSE '' END || '}}'"""

_FILE_COMMENT_JSON = f"""'{{"type":"message","subtype":' || {_jq('subtype')} || ',"text":"' || text
  || '","user":' || {_jq('usr')} || ',"comment":' || {_jq('comment')} || ',"mentions":' || mentions_json
  || ',"reactions":' || reactions_json || ',"ts":"' || ts || '"}}'"""

_MSG_JSON = f"""CASE category WHEN 'bot' THEN {_BOT_JSON}
  WHEN 'user_attachment' THEN {_USER_ATTACHMENT_JSON}
  WHEN 'file_share' THEN {_FILE_SHARE_JSON}
  WHEN 'file_comment' THEN {_FILE_COMMENT_JSON}
  ELSE raw END"""

# ---------------------------------------------------------------- listings
_CHANNELS = """
chan_counts AS (SELECT c_nationkey, count(*) AS num_members FROM customer GROUP BY c_nationkey),
channels AS (
  SELECT 'C' || CAST(n_nationkey AS VARCHAR) AS id, lower(n_name) AS name,
         CAST(coalesce(num_members, 0) AS BIGINT) AS num_members,
         'T' || CAST(n_regionkey AS VARCHAR) AS team_id, n_nationkey
  FROM nation LEFT JOIN chan_counts ON n_nationkey = c_nationkey
  UNION ALL
  SELECT 'Q' || CAST(r_regionkey AS VARCHAR), 'quiet ' || lower(r_name), 0,
         'T' || CAST(r_regionkey AS VARCHAR), -1
  FROM region
)"""

_CHANNEL_JSON = """'{"id":"' || id || '","name":"' || name || '","is_channel":true,"created":0,"creator":"U0",'
  || '"is_archived":false,"is_general":' || CASE WHEN n_nationkey = 0 THEN 'true' ELSE 'false' END
  || ',"name_normalized":"' || name || '","is_shared":false,"is_org_shared":false,"is_member":true,'
  || '"is_private":false,"is_mpim":false,"members":[],"topic":{"value":"all about ' || name
  || '","creator":"U0","last_set":0},"purpose":{"value":"all about ' || name
  || '","creator":"U0","last_set":0},"previous_names":[],"num_members":' || CAST(num_members AS VARCHAR)
  || ',"team_id":"' || team_id || '"}'"""

_USERS = """
users AS (
  SELECT 'U' || CAST(c_custkey AS VARCHAR) AS id, 'T' || CAST(n_regionkey AS VARCHAR) AS team_id,
         lower(replace(c_name, '#', '')) AS name, c_name AS real_name, c_mktsegment AS status_text,
         c_acctbal > 9000 AS is_admin
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
)"""

_USER_JSON = f"""'{{"id":"' || id || '","team_id":' || {_jq('team_id')} || ',"name":"' || name
  || '","deleted":false,"first_name":null,"real_name":"' || real_name || '","last_name":null,"display_name":"'
  || name || '","email":"' || name || '@users.example","is_bot":false,"status_text":' || {_jq('status_text')}
  || ',"status_emoji":null,"title":null,"skype":null,"phone":null,"is_owner":false,"is_primary_owner":false,'
  || '"image_72":null,"is_admin":' || CASE WHEN is_admin THEN 'true' WHEN NOT is_admin THEN 'false' ELSE 'null' END
  || ',"bot_id":null,"user":null}}'"""

_EMOJIS = """
emojis AS (
  SELECT 'T' || CAST(p_partkey % 5 AS VARCHAR) AS team_id, 'e' || CAST(p_partkey AS VARCHAR) AS name,
         CASE WHEN NOT (p_size > 40) THEN 'https://emoji.example/' || CAST(p_partkey AS VARCHAR) || '.png' END AS url,
         CASE WHEN p_size > 40 THEN 'e' || CAST(p_partkey - 5 AS VARCHAR) END AS alias_of
  FROM part
),
resolved AS (
  SELECT a.team_id, a.name, a.alias_of, coalesce(a.url, b.url) AS resolved_url,
         CASE WHEN a.alias_of IS NULL THEN 'direct' WHEN b.name IS NULL THEN 'missing_target'
              WHEN b.url IS NULL THEN 'unresolved_chain' ELSE 'alias' END AS status
  FROM emojis a LEFT JOIN emojis b
    ON a.alias_of IS NOT NULL AND a.team_id = b.team_id AND a.alias_of = b.name
)"""


_WIRE_NOTABLE = "(notable OR (category = 'whitelisted' AND json_valid(raw) AND has_mention))"


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


def _payloads(order_col: str, chunk: int) -> str:
    """Slices of each channel's order: at most ``chunk`` items, cut by bytes as well."""
    return f"""
items AS (SELECT channel, seq, {order_col} AS ord, {_MSG_JSON} AS json FROM messages WHERE notable),
ranked AS (
  SELECT *, (row_number() OVER w - 1) // {chunk}
            + CAST(coalesce(sum(strlen(json) + 1) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                   AS BIGINT) // {MAX_BYTES} AS chunk
  FROM items WINDOW w AS (PARTITION BY channel ORDER BY ord, seq)),
grouped AS (
  SELECT channel, chunk, count(*) AS n_items,
         first(seq ORDER BY ord, seq) AS first_seq, last(seq ORDER BY ord, seq) AS last_seq,
         '[' || string_agg(json, ',' ORDER BY ord, seq) || ']' AS body
  FROM ranked GROUP BY channel, chunk
)"""


def _listing(table: str, json: str, size: int, template: str) -> str:
    """Payloads of a listing, per team."""
    return f"""
{table}_recs AS (
  SELECT team_id, id, {json} AS json,
         (row_number() OVER (PARTITION BY team_id ORDER BY id) - 1) // {size} AS chunk FROM {table}),
{table}_payloads AS (
  SELECT team_id, chunk, replace('{template}', '<team_id>', coalesce(team_id, '')) AS url,
         count(*) AS n_items, first(id ORDER BY id) AS first_id, last(id ORDER BY id) AS last_id,
         sha256(replace('{template}', '<team_id>', coalesce(team_id, '')) || chr(10)
                || '[' || string_agg(json, ',' ORDER BY id) || ']') AS key
  FROM {table}_recs GROUP BY team_id, chunk)"""


# the reply of sinks.delivery.selective_service
_STATUS = "CASE WHEN key < '4' THEN 'NOK' WHEN key < '6' THEN 'UNKNOWN' ELSE 'OK' END"

_TEAM_PAYLOADS = f"""
e AS (
  SELECT team_id, name,
         '{{"name":"' || name || '","url":"' || coalesce(url, 'alias:' || alias_of) || '"}}' AS json,
         (row_number() OVER (PARTITION BY team_id ORDER BY name) - 1) // {Q.TEAM_BATCH} AS chunk
  FROM emojis),
eg AS (SELECT team_id, chunk, count(*) AS n_items, string_agg(json, ',' ORDER BY name) AS items
       FROM e GROUP BY team_id, chunk),
t AS (
  SELECT 'T' || CAST(r_regionkey AS VARCHAR) AS team_id,
         '{{"id":"T' || CAST(r_regionkey AS VARCHAR) || '","name":"' || r_name || '","domain":"'
         || replace(lower(r_name), ' ', '-') || '","email_domain":"' || replace(lower(r_name), ' ', '-')
         || '.example","image_132":"https://img.example/' || replace(lower(r_name), ' ', '-') || '_132.png"' AS head
  FROM region),
team_payloads AS (
  SELECT t.team_id, coalesce(eg.chunk, 0) AS chunk,
         replace('{Q.TEAM_URL}', '<team_id>', t.team_id) AS url, coalesce(eg.n_items, 0) AS n_items,
         sha256(replace('{Q.TEAM_URL}', '<team_id>', t.team_id) || chr(10)
                || t.head || ',"emojis":[' || coalesce(eg.items, '') || ']}}') AS key
  FROM t LEFT JOIN eg ON t.team_id = eg.team_id)"""


def _sql() -> dict[str, str]:
    msg = _with(_MESSAGES)
    url = (f"replace(replace('{Q.URL_TEMPLATE}', '<team_id>', coalesce(c.team_id, '')), "
           f"'<channel_id>', g.channel)")
    routes = f"""
routes AS (SELECT id AS channel, num_members,
                  CASE WHEN num_members >= {Q.ROUTE_MIN_MEMBERS} THEN 'gte' ELSE 'lt' END AS route
           FROM channels)"""
    bl = ", ".join(f"'{s}'" for s in Q.BLACKLIST)
    return {
        "sieve_counts": msg + """
SELECT channel, category, count(*) AS n_seen, count(*) FILTER (WHERE notable) AS n_kept
FROM messages GROUP BY channel, category""",

        "skipped_channels": _with(_MESSAGES, _CHANNELS) + """
SELECT id AS channel, name FROM channels
WHERE id NOT IN (SELECT DISTINCT channel FROM messages WHERE notable)""",

        "channel_activity": _with(_MESSAGES, _CHANNELS) + """
SELECT c.id AS channel, CAST(coalesce(n.cnt, 0) AS BIGINT) AS n_notable, coalesce(n.cnt, 0) = 0 AS skipped
FROM channels c LEFT JOIN (SELECT channel, count(*) AS cnt FROM messages WHERE notable GROUP BY channel) n
  ON c.id = n.channel""",

        "channel_totals": msg + """
SELECT channel,
  count(*) FILTER (WHERE category = 'bot') AS n_bot,
  count(*) FILTER (WHERE category = 'user_attachment') AS n_user_attachment,
  count(*) FILTER (WHERE category = 'file_share') AS n_file_share,
  count(*) FILTER (WHERE category = 'file_comment') AS n_file_comment,
  count(*) FILTER (WHERE category = 'whitelisted') AS n_whitelisted,
  count(*) AS n_messages
FROM messages WHERE notable GROUP BY channel""",

        "conversation_posts": """
WITH c AS (
  SELECT a.conv_id, a.turn, a.role, a.text, CASE WHEN a.conv_id % 7 <> 0 THEN b.turn END AS next_turn,
         regexp_extract_all(a.text, '<@([UW][A-Z0-9]+)(?:\\|[^>]*)?>', 1) AS ids
  FROM (SELECT conv_id, turn, role, CASE WHEN conv_id % 3 = 0 AND turn = 1
                                         THEN coalesce(text, '') || ' <@U' || CAST(conv_id AS VARCHAR) || '>'
                                         ELSE text END AS text FROM conversations) a LEFT JOIN conversations b ON a.conv_id = b.conv_id AND a.turn + 1 = b.turn)
SELECT 'V' || CAST(conv_id AS VARCHAR) AS channel, count(*) AS n_messages,
       count(*) FILTER (WHERE (role = 'assistant' AND len(ids) > 0)
                              OR (role <> 'assistant' AND (len(ids) > 0 OR next_turn IS NOT NULL))) AS n_notable,
       CAST(sum(len(ids)) AS BIGINT) AS n_mentions,
       count(*) FILTER (WHERE (role = 'assistant' AND len(ids) > 0)
                              OR (role <> 'assistant' AND (len(ids) > 0 OR next_turn IS NOT NULL))) = 0 AS skipped
FROM c GROUP BY conv_id""",

        "json_presence": msg + """
SELECT seq, json_valid(raw) AS parse_ok,
  CASE WHEN json_valid(raw) THEN coalesce(json_type(raw, '$.reactions') = 'ARRAY', false) ELSE false END AS has_reactions,
  CASE WHEN json_valid(raw) THEN CASE WHEN json_type(raw, '$.reactions') = 'ARRAY' THEN CAST(json_array_length(raw, '$.reactions') AS INTEGER) END END AS n_reactions,
  CASE WHEN json_valid(raw) THEN coalesce(json_type(raw, '$.mentions') = 'ARRAY', false) ELSE false END AS has_mentions,
  CASE WHEN json_valid(raw) THEN CASE WHEN json_type(raw, '$.mentions') = 'ARRAY' THEN CAST(json_array_length(raw, '$.mentions') AS INTEGER) END END AS n_mentions,
  CASE WHEN json_valid(raw) THEN coalesce(json_type(raw, '$.replies') = 'ARRAY', false) ELSE false END AS has_replies,
  CASE WHEN json_valid(raw) THEN CASE WHEN json_type(raw, '$.replies') = 'ARRAY' THEN CAST(json_array_length(raw, '$.replies') AS INTEGER) END END AS n_replies,
  notable AS keep
FROM messages WHERE category = 'whitelisted'""",

        "encode_file_share": msg + f"SELECT seq, {_FILE_SHARE_JSON} AS json FROM messages WHERE category = 'file_share'",
        "encode_bot": msg + f"SELECT seq, {_BOT_JSON} AS json FROM messages WHERE category = 'bot'",
        "encode_user_attachment": msg + f"SELECT seq, {_USER_ATTACHMENT_JSON} AS json FROM messages WHERE category = 'user_attachment'",
        "encode_file_comment": msg + f"SELECT seq, {_FILE_COMMENT_JSON} AS json FROM messages WHERE category = 'file_comment'",

        "encode_users": _with(_USERS) + f"SELECT id, {_USER_JSON} AS json FROM users",
        "encode_channels": _with(_CHANNELS) + f"SELECT id, {_CHANNEL_JSON} AS json FROM channels",

        "post_payloads": _with(_MESSAGES, _CHANNELS, _payloads("category_ord", Q.CHUNK)) + f"""
SELECT c.team_id, g.channel, g.chunk, {url} AS url, g.n_items, g.first_seq, g.last_seq, g.body,
       sha256({url} || chr(10) || g.body) AS key
FROM grouped g LEFT JOIN channels c ON g.channel = c.id""",

        "post_payload_slices": _with(_MESSAGES, _CHANNELS, _payloads("category_ord", Q.SLICE)) + f"""
SELECT g.channel, g.chunk, g.n_items, g.first_seq, g.last_seq,
       sha256({url} || chr(10) || g.body) AS key
FROM grouped g LEFT JOIN channels c ON g.channel = c.id""",

        "channel_posts": _with(_MESSAGES, _payloads("order_a", Q.CHUNK)) + """
SELECT channel, chunk, n_items, first_seq, last_seq,
       '{"channel":"' || channel || '","posts":' || body || '}' AS record
FROM grouped""",

        "route_channels": _with(_CHANNELS, routes) + "SELECT channel, num_members, route FROM routes",

        "display_channels": _with(_CHANNELS, routes) + """
SELECT '{"route":"' || route || '","num_members":' || CAST(num_members AS VARCHAR) || '}' AS line, count(*) AS n
FROM routes GROUP BY ALL""",

        "route_windows": _with(_MESSAGES, _CHANNELS, routes) + """
SELECT (m.us // 900000000 - g.i) * 900 AS window_start, (m.us // 900000000 - g.i) * 900 + 3600 AS window_end,
       r.route, count(*) AS n, count(DISTINCT m.channel) AS n_channels
FROM messages m JOIN routes r ON m.channel = r.channel, range(0, 4) g(i)
GROUP BY 1, 2, 3""",

        "route_window_channels": _with(_MESSAGES, _CHANNELS, routes) + """
SELECT DISTINCT (m.us // 900000000 - g.i) * 900 AS window_start, r.route, m.channel
FROM messages m JOIN routes r ON m.channel = r.channel, range(0, 4) g(i)""",

        "route_report": _with(_MESSAGES, _CHANNELS) + """
SELECT (m.us // 100000 - g.i) * 100 AS window_start_ms,
       CASE WHEN c.num_members >= 5 THEN 'gte' ELSE 'lt' END AS route,
       count(*) AS n, count(DISTINCT m.channel) AS n_channels
FROM messages m JOIN channels c ON m.channel = c.id, range(0, 10) g(i)
GROUP BY 1, 2""",

        "classify": msg + "SELECT seq, channel, category, category_ord FROM messages",

        "mentions": """
WITH d AS (SELECT doc_id, '<@U' || CAST(doc_id AS VARCHAR) || '> ' || text || ' <@W' || CAST(doc_id * 7 AS VARCHAR) || '|someone>' AS text
           FROM documents),
x AS (SELECT doc_id, regexp_extract_all(text, '<@([UW][A-Z0-9]+)(?:\\|[^>]*)?>', 1) AS ids FROM d)
SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_mentions, array_to_string(ids, ',') AS mentions FROM x""",

        "emoji_alias": _with(_EMOJIS) + "SELECT team_id, name, alias_of, resolved_url, status FROM resolved",

        "blacklist": msg + f"""
SELECT channel, category, count(*) AS n FROM messages
WHERE subtype IS NULL OR subtype NOT IN ({bl}) GROUP BY channel, category""",

        "split_ids": _with(_USERS) + f"""
SELECT id, CAST(ntile({Q.SPLIT_K}) OVER (ORDER BY id) AS INTEGER) AS part FROM (SELECT DISTINCT id FROM users)""",

        "response_status": """
WITH r AS (
  SELECT event_id,
    CASE event_id % 7 WHEN 0 THEN '{"received":' || CAST(user_id AS VARCHAR) || '}'
      WHEN 1 THEN '{"message":[]}' WHEN 2 THEN '{"message":[{"error":"rejected"}]}'
      WHEN 3 THEN '{"errors":"bad payload"}' WHEN 4 THEN '{"received":null}'
      WHEN 5 THEN '{"message":[1]}' ELSE 'upstream timeout' END AS body
  FROM events)
SELECT event_id,
  CASE WHEN NOT json_valid(body) THEN 'UNKNOWN'
       WHEN json_type(body, '$.received') IN ('BIGINT', 'UBIGINT') THEN 'OK'
       WHEN json_type(body, '$.message') = 'ARRAY'
            AND len(list_filter(json_extract(body, '$.message[*]'), lambda x: json_type(x) <> 'OBJECT')) = 0 THEN 'NOK'
       ELSE 'UNKNOWN' END AS status
FROM r""",

        "dedup_posts": msg + """
SELECT channel, count(*) AS n_messages FROM (SELECT DISTINCT channel, ts FROM messages) GROUP BY channel""",

        "seed_users": _with(_USERS, _listing("users", _USER_JSON, Q.USER_BATCH, Q.USERS_URL)) + """
SELECT team_id, chunk, url, n_items, first_id, last_id, key FROM users_payloads""",

        "deliver_users": _with(_USERS, _listing("users", _USER_JSON, Q.USER_BATCH, Q.USERS_URL)) + f"""
SELECT team_id, chunk, url, n_items, key, {_STATUS} AS status FROM users_payloads""",

        "deliver_channels": _with(_CHANNELS, _listing("channels", _CHANNEL_JSON, Q.CHANNEL_BATCH, Q.CHANNELS_URL)) + f"""
SELECT team_id, chunk, url, n_items, key, {_STATUS} AS status FROM channels_payloads""",

        "deliver_team": _with(_EMOJIS, _TEAM_PAYLOADS) + f"""
SELECT team_id, chunk, url, n_items, key, {_STATUS} AS status FROM team_payloads""",

        "seed_channels": _with(_CHANNELS, _listing("channels", _CHANNEL_JSON, Q.CHANNEL_BATCH, Q.CHANNELS_URL)) + """
SELECT team_id, chunk, url, n_items, first_id, last_id, key FROM channels_payloads""",

        "seed_posts": _with(_MESSAGES, _CHANNELS) + f"""
SELECT channel, CAST(ceil(count(*) / {Q.SLICE}) AS BIGINT) AS n_payloads, CAST(count(*) AS BIGINT) AS n_items
FROM messages WHERE notable AND (subtype IS NULL OR subtype NOT IN ({bl}))
  AND channel IN (SELECT id FROM channels) GROUP BY channel""",

        "team_info": _with(_EMOJIS) + """
SELECT 'T' || CAST(r_regionkey AS VARCHAR) AS team_id, r_name AS name,
       replace(lower(r_name), ' ', '-') AS domain,
       CAST(coalesce(s.n_emojis, 0) AS BIGINT) AS n_emojis,
       CAST(coalesce(s.n_aliases, 0) AS BIGINT) AS n_aliases,
       CAST(coalesce(s.n_unresolved, 0) AS BIGINT) AS n_unresolved
FROM region LEFT JOIN (
  SELECT team_id, count(*) AS n_emojis, count(*) FILTER (WHERE status = 'alias') AS n_aliases,
         count(*) FILTER (WHERE status IN ('unresolved_chain', 'missing_target')) AS n_unresolved
  FROM resolved GROUP BY team_id) s ON 'T' || CAST(r_regionkey AS VARCHAR) = s.team_id""",

        "run_metrics": _with(_MESSAGES, _CHANNELS, _payloads("category_ord", Q.SLICE), _USERS, _EMOJIS,
                             _listing("users", _USER_JSON, Q.USER_BATCH, Q.USERS_URL),
                             _listing("channels", _CHANNEL_JSON, Q.CHANNEL_BATCH, Q.CHANNELS_URL),
                             _TEAM_PAYLOADS) + f"""
, r AS (
  SELECT 'posts' AS kind, c.team_id, g.n_items, sha256({url} || chr(10) || g.body) AS key
  FROM grouped g LEFT JOIN channels c ON g.channel = c.id
  UNION ALL SELECT 'users', team_id, n_items, key FROM users_payloads
  UNION ALL SELECT 'channels', team_id, n_items, key FROM channels_payloads
  UNION ALL SELECT 'team', team_id, n_items, key FROM team_payloads),
s AS (SELECT *, {_STATUS} AS status FROM r)
SELECT 'mapper_channels' AS metric, count(*) AS value FROM channels
UNION ALL SELECT 'mapper_posts', count(*) FROM messages WHERE notable
UNION ALL SELECT 'sink_posts', CAST(coalesce(sum(n_items), 0) AS BIGINT) FROM s WHERE status = 'OK' AND kind = 'posts'
UNION ALL SELECT 'sink_channels', CAST(coalesce(sum(n_items), 0) AS BIGINT) FROM s WHERE status = 'OK' AND kind = 'channels'
UNION ALL SELECT 'sink_users', CAST(coalesce(sum(n_items), 0) AS BIGINT) FROM s WHERE status = 'OK' AND kind = 'users'
UNION ALL SELECT 'sink_teams', count(DISTINCT team_id) FROM s WHERE status = 'OK' AND kind = 'team'
UNION ALL SELECT 'refused_payloads', count(*) FROM s WHERE status <> 'OK'""",

        "stream_windows": msg + """
SELECT * FROM (
  SELECT (us // 900000000 - g.i) * 900 AS window_start, (us // 900000000 - g.i) * 900 + 3600 AS window_end,
         category, count(*) AS n
  FROM messages, range(0, 4) g(i)
  GROUP BY 1, 2, 3)
WHERE window_end * 1000000 <= (SELECT max(us) - 600000000 FROM messages)""",

        "stream_route_windows": _with(_MESSAGES, _CHANNELS, routes) + """
SELECT * FROM (
  SELECT (m.us // 900000000 - g.i) * 900 AS window_start, (m.us // 900000000 - g.i) * 900 + 3600 AS window_end,
         r.route, count(*) AS n, count(DISTINCT m.channel) AS n_channels
  FROM messages m JOIN routes r ON m.channel = r.channel, range(0, 4) g(i)
  GROUP BY 1, 2, 3)
WHERE window_end * 1000000 <= (SELECT max(us) - 600000000 FROM messages)""",

        # the windows still open, per channel; windows per route come and go with their close
        "stream_state_summary": msg + """
SELECT 'stateStoreSave' AS name, CAST(2 AS BIGINT) AS n_operators, count(*) AS n_keys FROM (
  SELECT DISTINCT us // 900000000 - g.i AS w, channel FROM messages, range(0, 4) g(i))
WHERE (w * 900 + 3600) * 1000000 > (SELECT max(us) - 600000000 FROM messages)""",

        "stream_channel_progress": _with(_MESSAGES, _CHANNELS) + """
, t AS (SELECT min(us) + (max(us) - min(us)) // 2 AS middle, max(us) AS high FROM messages),
p AS (
  SELECT channel, max(us) AS last_us, count(*) AS messages,
         CAST(count(DISTINCT us >= middle) - 1 AS INTEGER) AS restarts
  FROM messages, t GROUP BY channel)
SELECT coalesce(p.channel, c.id) AS channel, last_us, CAST(coalesce(messages, 0) AS BIGINT) AS messages,
       coalesce(restarts, 0) AS restarts,
       coalesce(last_us // 1000 + 3600000 <= (high - 600000000) // 1000, true) AS silent
FROM p FULL JOIN channels c ON p.channel = c.id, t""",

        "stream_counters": msg + """
SELECT 'seen_posts' AS metric, count(*) AS value FROM messages
UNION ALL SELECT 'mapper_posts', count(*) FROM messages WHERE notable
UNION ALL SELECT 'late_rows', 0
UNION ALL SELECT 'seen_' || category, count(*) FROM messages GROUP BY category""",

        "stream_team_info": f"""
SELECT 'T' || CAST(r_regionkey AS VARCHAR) AS team_id, r_name AS name, replace(lower(r_name), ' ', '-') AS domain,
       CAST({Q.RESPONSES_FROM} + 600 * r_regionkey AS BIGINT) AS landed,
       CAST(count(p_partkey) AS BIGINT) AS n_emojis,
       CAST(count(*) FILTER (WHERE p_size > 40) AS BIGINT) AS n_aliases
FROM region LEFT JOIN part ON p_partkey % 5 = r_regionkey AND r_regionkey IN (0, 1, 4)
GROUP BY r_regionkey, r_name""",

        "stream_sieve": msg + """
SELECT channel, category, count(*) AS n_kept FROM messages WHERE notable GROUP BY channel, category""",

        "stream_sieve_files": msg + """
SELECT channel, category, count(*) AS n_kept FROM messages WHERE notable GROUP BY channel, category""",

        # the files overlap by less than a day, which is the watermark's delay
        "stream_windows_files": msg + """
SELECT * FROM (
  SELECT (us // 900000000 - g.i) * 900 AS window_start, (us // 900000000 - g.i) * 900 + 3600 AS window_end,
         category, count(*) AS n
  FROM messages, range(0, 4) g(i)
  GROUP BY 1, 2, 3)
WHERE window_end * 1000000 <= (SELECT max(us) - 86400000000 FROM messages)""",

        "unnumbered_pages": msg + f"""
, wire AS (SELECT channel, category_ord, us FROM messages WHERE {_WIRE_NOTABLE}),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY channel ORDER BY category_ord, us) - 1) // {Q.SLICE} AS chunk
           FROM wire)
SELECT channel, chunk, count(*) AS n_items, first(us ORDER BY category_ord, us) AS first_seq,
       last(us ORDER BY category_ord, us) AS last_seq
FROM ranked GROUP BY channel, chunk""",

        # odd messages land plain, then with their reactions; even ones the other way round
        "dedup_versions": msg + """
, v AS (SELECT *, category = 'whitelisted' AND notable
               OR category IN ('bot', 'user_attachment', 'file_comment') AND has_mention
               OR category = 'file_share' AND (has_mention OR has_comment) AS plain FROM messages)
SELECT channel, category, count(*) AS n_kept,
       CAST(count(*) FILTER (WHERE has_reaction AND (seq % 2 = 1 OR NOT plain)) AS BIGINT) AS n_reacted
FROM v WHERE notable GROUP BY channel, category""",

        "union_categories": msg + """
SELECT category, category_ord, count(*) AS n, CAST(sum(seq) AS BIGINT) AS seqs
FROM messages GROUP BY category, category_ord""",

        "page_rejects": msg + """
SELECT 'messages' AS source, 'message is not a JSON object with a ts' AS reason, count(*) AS n
FROM messages WHERE category = 'whitelisted' AND NOT json_valid(raw) HAVING count(*) > 0
UNION ALL
SELECT 'history', 'no_access_' || lower(r_name), count(*) FROM region GROUP BY r_name""",

        "landed_twice": _with(_MESSAGES, _CHANNELS) + f"""
SELECT channel, CAST(ceil(count(DISTINCT ts) / {Q.SLICE}) AS BIGINT) AS n_payloads,
       CAST(count(DISTINCT ts) AS BIGINT) AS n_items
FROM messages WHERE {_WIRE_NOTABLE} AND (subtype IS NULL OR subtype NOT IN ({bl}))
  AND channel IN (SELECT id FROM channels) GROUP BY channel""",

        "corrupt_pages": msg + """
SELECT 'messages' AS source, channel AS key, 'message is not a JSON object with a ts' AS reason,
       raw AS text, count(*) AS n
FROM messages WHERE category = 'whitelisted' AND NOT json_valid(raw) GROUP BY ALL
UNION ALL
SELECT 'messages', 'N' || CAST(n_nationkey AS VARCHAR), 'message is not a JSON object with a ts',
       '{"text":"no time"}', count(*) FROM nation GROUP BY n_nationkey
UNION ALL
SELECT 'messages', 'N' || CAST(n_nationkey AS VARCHAR), 'message has an unreadable ts',
       '{"ts":"soon","text":"' || n_name || '"}', count(*) FROM nation GROUP BY ALL
UNION ALL
SELECT 'history', NULL, 'no_access_' || lower(r_name), NULL, count(*) FROM region GROUP BY r_name
UNION ALL
SELECT 'history', NULL, 'malformed page',
       '{"ok":true,"channel":"S' || CAST(s_suppkey AS VARCHAR) || '","messages":[{"ts":"17', count(*)
FROM supplier GROUP BY s_suppkey""",

        "place_groups": _with(_USERS) + f"""
SELECT part, count(*) AS n_users, CAST(1 AS BIGINT) AS n_tasks, CAST(part - 1 AS INTEGER) AS task
FROM (SELECT CAST(ntile({Q.SPLIT_K}) OVER (ORDER BY id) AS INTEGER) AS part FROM users) GROUP BY part""",

        "stream_posts": msg + f"""
SELECT channel, CAST(count(*) AS BIGINT) AS n_items FROM messages
WHERE {_WIRE_NOTABLE} AND (subtype IS NULL OR subtype NOT IN ({bl})) GROUP BY channel""",

        "deliver_posts": _with(_MESSAGES, _CHANNELS, _payloads("category_ord", Q.CHUNK)) + f"""
SELECT g.channel, g.chunk, sha256({url} || chr(10) || g.body) AS key, g.n_items, 'OK' AS status
FROM grouped g LEFT JOIN channels c ON g.channel = c.id""",

        "deliver_posts_writer": _with(_MESSAGES, _CHANNELS, _payloads("category_ord", Q.CHUNK)) + f"""
SELECT g.channel, g.chunk, sha256({url} || chr(10) || g.body) AS key, g.n_items, 'OK' AS status
FROM grouped g LEFT JOIN channels c ON g.channel = c.id""",

        # refused at the first attempt if three divides the key's first 32 bits, at the second if nine does
        "redelivery": _with(_MESSAGES, _CHANNELS, _payloads("category_ord", Q.SLICE)) + f"""
, r AS (SELECT g.channel, g.chunk, g.n_items, sha256({url} || chr(10) || g.body) AS key
        FROM grouped g LEFT JOIN channels c ON g.channel = c.id)
SELECT channel, chunk, key, n_items,
       CAST(CASE WHEN ('0x' || substr(key, 1, 8))::BIGINT % 9 = 0 THEN 3
                 WHEN ('0x' || substr(key, 1, 8))::BIGINT % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS attempts,
       CAST(1 AS BIGINT) AS accepted, 'OK' AS status
FROM r""",

        "delivered_metrics": _with(_MESSAGES, _CHANNELS, _payloads("category_ord", Q.SLICE)) + f"""
, r AS (SELECT g.n_items, sha256({url} || chr(10) || g.body) AS key
        FROM grouped g LEFT JOIN channels c ON g.channel = c.id),
s AS (SELECT *, {_STATUS} AS status FROM r)
SELECT 'sink_posts' AS metric, CAST(coalesce(sum(n_items) FILTER (WHERE status = 'OK'), 0) AS BIGINT) AS value FROM s
UNION ALL SELECT 'sink_channels', 0
UNION ALL SELECT 'sink_users', 0
UNION ALL SELECT 'sink_teams', 0
UNION ALL SELECT 'refused_payloads', count(*) FILTER (WHERE status <> 'OK') FROM s""",

        # pages carry no mentions: the reader adds those of the text, also to plain
        # posts whose lists are nested
        "history_pages": msg + f"""
SELECT channel, category, count(*) AS n_kept FROM messages WHERE {_WIRE_NOTABLE} GROUP BY channel, category""",

        "channel_pages": msg + f"""
SELECT channel, category, count(*) AS n_kept, CAST(1 AS BIGINT) AS n_splits
FROM messages WHERE {_WIRE_NOTABLE} GROUP BY channel, category""",

        "listing_pages": _with(_USERS, _CHANNELS, _EMOJIS) + f"""
SELECT 'users' AS listing, id, {_USER_JSON} AS json FROM users
UNION ALL
SELECT 'channels', id, {_CHANNEL_JSON.replace(""" || ',"team_id":"' || team_id || '"}'""", """ || '}'""")} FROM channels
UNION ALL
SELECT 'team', 'T' || CAST(r_regionkey AS VARCHAR),
       '{{"id":"T' || CAST(r_regionkey AS VARCHAR) || '","name":"' || r_name || '","domain":"'
       || replace(lower(r_name), ' ', '-') || '","email_domain":"' || replace(lower(r_name), ' ', '-')
       || '.example","image_132":"https://img.example/' || replace(lower(r_name), ' ', '-') || '_132.png"}}'
FROM region
UNION ALL
SELECT 'team', '', '{{"id":"","name":"unnamed","domain":"unnamed","email_domain":"unnamed.example","image_132":"https://img.example/unnamed_132.png"}}'
UNION ALL
SELECT 'emoji', team_id || '/' || name,
       '{{"url":' || {_jq('url')} || ',"alias_of":' || {_jq('alias_of')} || '}}'
FROM emojis""",

        "rejects": _with(_MESSAGES, _CHANNELS, _EMOJIS, _payloads("category_ord", Q.SLICE)) + f"""
, r AS (SELECT sha256({url} || chr(10) || g.body) AS key FROM grouped g LEFT JOIN channels c ON g.channel = c.id)
SELECT 'whitelisted' AS source, channel || '/' || ts AS key, 'raw message is not readable JSON' AS reason
FROM messages WHERE category = 'whitelisted' AND NOT json_valid(raw)
UNION ALL
SELECT 'blacklist', channel || '/' || ts, 'blacklisted subtype ' || subtype
FROM messages WHERE subtype IN ({bl})
UNION ALL
SELECT 'emoji', team_id || '/' || name, status || ': ' || alias_of
FROM resolved WHERE status IN ('unresolved_chain', 'missing_target')
UNION ALL
SELECT 'delivery', key, CASE WHEN key < '4' THEN 'NOK: {{"message":[{{"error":"refused"}}]}}'
                             ELSE 'UNKNOWN: upstream timeout' END FROM r WHERE key < '6'""",

        "team_payload": _with(_EMOJIS, _TEAM_PAYLOADS) + """
SELECT team_id, chunk, url, n_items, key FROM team_payloads""",

        "listing_totals": """
SELECT 'users' AS listing, count(*) AS value FROM customer
UNION ALL SELECT 'channels', (SELECT count(*) FROM nation) + (SELECT count(*) FROM region)
UNION ALL SELECT 'teams', count(*) FROM region""",
    }


ORACLE: dict[str, str] = _sql()
