"""F-1..F-6: typed rules, whitelisted JSON rule, laws."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievery import schemas
from sievery.functions import classify as C
from sievery.operators import sieve

EMPTY_R = "array<struct<name:string,users:array<string>,count:bigint>>"


def _msgs(spark, rows):
    """rows: (seq, category, n_reactions, n_mentions, n_comments, raw)."""
    data = []
    for seq, cat, nr, nm, nc, raw in rows:
        data.append({
            "channel": "C1", "category": cat, "seq": seq, "ts": f"{seq}.000000",
            "reactions": [{"name": "r", "users": ["U1"], "count": 1}] * nr,
            "mentions": ["U2"] * nm,
            "comments": [{"id": "x", "timestamp": 1, "user": "U3"}] * nc,
            "replies": [], "raw": raw,
        })
    schema = ("channel string, category string, seq bigint, ts string, "
              f"reactions {EMPTY_R}, mentions array<string>, "
              "comments array<struct<id:string,timestamp:bigint,user:string>>, "
              "replies array<struct<ts:string,user:string>>, raw string")
    return spark.createDataFrame(data, schema)


def _kept(df):
    return sorted(r["seq"] for r in sieve.sieve(df).select("seq").collect())


def test_typed_rules(spark):
    rows = [
        (1, C.BOT, 0, 0, 0, None),             # nothing -> dropped
        (2, C.BOT, 1, 0, 0, None),             # reactions -> kept
        (3, C.USER_ATTACHMENT, 0, 1, 0, None),  # mentions -> kept
        (4, C.USER_ATTACHMENT, 0, 0, 1, None),  # comments do not count -> dropped
        (5, C.FILE_SHARE, 1, 0, 0, None),      # reactions do not count -> dropped
        (6, C.FILE_SHARE, 0, 0, 1, None),      # comments -> kept
        (7, C.FILE_SHARE, 0, 1, 0, None),      # mentions -> kept
        (8, C.FILE_COMMENT, 1, 0, 0, None),    # reactions -> kept
        (9, C.FILE_COMMENT, 0, 0, 0, None),    # nothing -> dropped
        (10, "other", 1, 1, 1, None),          # unknown category -> dropped
    ]
    assert _kept(_msgs(spark, rows)) == [2, 3, 6, 7, 8]


def test_whitelisted_json_rule(spark):
    cases = {
        1: '{"reactions":[{"name":"x"}]}',         # non-empty top-level array
        2: '{"reactions":[]}',                      # present but empty
        3: '{"key":{"mentions":["U1"]}}',           # nested: absent
        4: '{"mentions":["U1"]',                    # broken text: absent
        5: '{"replies":[{"ts":"1.0","user":"U1"}]}',  # replies count
        6: '{"mentions":"U1"}',                     # not an array
        7: '{"mentions":["U1"],"mentions":[]}',     # duplicate keys: refused
        8: '[1,2,3]',                               # not an object
        9: None,
        10: '{"reactions":[],"mentions":[],"replies":["x"]}',
    }
    rows = [(k, C.WHITELISTED, 0, 0, 0, v) for k, v in cases.items()]
    assert _kept(_msgs(spark, rows)) == [1, 5, 10]


def test_presence_lenses(spark):
    from sievery.functions import jsonfields as J
    df = spark.createDataFrame([("{\"mentions\":[]}",), ("{\"a\":{\"mentions\":[1]}}",), ("{",)], "raw string")
    v = J.parse(F.col("raw"))
    got = df.select(J.mentions_field(v).isNotNull().alias("p")).collect()
    assert [r["p"] for r in got] == [True, False, False]


row_strategy = st.tuples(
    st.sampled_from(C.CATEGORIES), st.integers(0, 2), st.integers(0, 2), st.integers(0, 2),
    st.sampled_from([None, '{"reactions":[1]}', '{"mentions":[]}', '{"x":[1]}', '{"replies":[2]}', "{"]))


def _brute(cat, nr, nm, nc, raw):
    import json
    if cat in (C.BOT, C.USER_ATTACHMENT, C.FILE_COMMENT):
        return nr > 0 or nm > 0
    if cat == C.FILE_SHARE:
        return nm > 0 or nc > 0
    try:
        obj = json.loads(raw) if raw else None
    except ValueError:
        return False
    if not isinstance(obj, dict):
        return False
    return any(isinstance(obj.get(k), list) and obj.get(k) for k in ("reactions", "mentions", "replies"))


@settings(max_examples=10, deadline=None)
@given(st.lists(row_strategy, min_size=1, max_size=30))
def test_sieve_matches_brute_force_and_laws(spark, rows):
    data = [(i,) + r for i, r in enumerate(rows)]
    df = _msgs(spark, data)
    kept = _kept(df)
    assert kept == [i for i, *r in data if _brute(*r)]
    # laws: a subset, and idempotent
    once = sieve.sieve(df)
    assert _kept(once) == kept


def test_skipped_channels(spark):
    chans = spark.createDataFrame([("C1",), ("C2",)], "id string")
    notable = spark.createDataFrame([("C1", 1)], "channel string, seq int")
    assert [r["id"] for r in sieve.skipped_channels(chans, notable).collect()] == ["C2"]


def test_message_schema_is_canonical(spark):
    from sievery.sources import tables as T
    m = T.load_messages(spark, "/root/testdata/sf0.001")
    assert m.columns == schemas.MESSAGE_COLUMNS


def test_conversation_adapter_threads(spark):
    from sievery.sources import tables as T
    m = T.load_conversation_messages(spark, "/root/testdata/sf0.001")
    assert m.columns == schemas.MESSAGE_COLUMNS
    last = m.groupBy("channel").agg(F.max("seq").alias("last"))
    tail = m.join(last, "channel").filter(F.col("seq") == F.col("last"))
    assert tail.filter(F.size("replies") > 0).count() == 0        # last turn: no reply
    inner = m.join(last, "channel").filter(F.col("seq") < F.col("last"))
    silent = F.expr("cast(substr(channel, 2) AS int) % 7 = 0")      # these keep no replies
    assert inner.filter(~silent & (F.size("replies") != 1)).count() == 0   # others: the next turn
    assert inner.filter(silent & (F.size("replies") > 0)).count() == 0
    assert set(r["category"] for r in m.select("category").distinct().collect()) <= {
        C.BOT, C.WHITELISTED}


def test_of_a_repeated_key_the_last_value_counts_where_allowed(spark):
    df = spark.createDataFrame([('{"mentions":[],"mentions":["U1"]}',), ('{"mentions":["U1"],"mentions":[]}',)],
                               "raw string")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    try:
        got = [r["k"] for r in df.select(sieve.keep_whitelisted().alias("k")).collect()]
    finally:
        spark.conf.unset("spark.sql.variant.allowDuplicateKeys")
    assert got == [True, False]
