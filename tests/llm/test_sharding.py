import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from sievery.llm import sharding as S
from sievery.llm.queries import op11_sharding
from tests.llm.fixtures import TEXTS, documents


def draw(*parts):
    return int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:15], 16)


def brute(rows, shards=16, bucket_rows=S.BUCKET_ROWS, bucket_bytes=S.BUCKET_BYTES):
    """(id, size, crc, shard, slot) of every row by plain loops."""
    keys = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows]
    n = max(1, -(-len(keys) // bucket_rows), -(-sum(k[1] for k in keys) // bucket_bytes))
    buckets = {}
    for key in keys:
        h = draw(S.SEED, "null" if key[0] is None else key[0], *key[1:])
        buckets.setdefault(h % n, []).append(key)
    line = []
    for b in sorted(buckets):
        own = sorted(buckets[b], key=lambda k: (k[0] is not None, k))
        for k in range(len(own)):
            j = draw(S.SEED, b, k) % (k + 1)
            own[k], own[j] = own[j], own[k]
        line += own
    out, size = [], len(line)
    for p, key in enumerate(line):
        s = p * shards // size
        out.append((*key, s, p - -(-s * size // shards)))
    return out


def placed(df):
    return [(r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()),
             r.place.shard, r.place.slot) for r in df.collect()]


def by_text(rows):
    return sorted(map(str, rows))


@pytest.mark.parametrize("rows, size", [(1024, 4 << 20), (5, 4 << 20), (1024, 3000)])
def test_places_equal_brute_force(spark, rows, size):
    got = placed(S.shard(documents(spark), bucket_rows=rows, bucket_bytes=size))
    assert by_text(got) == by_text(brute(TEXTS, 16, rows, size))


def test_columns_are_kept_and_the_law_holds(spark):
    docs = documents(spark).withColumn("place", F.lit("mine"))
    out = S.shard(docs, shards=4)
    assert out.columns[:-1] == docs.columns and out.columns[-1] not in docs.columns
    own = out.columns[-1]
    per = {}
    for s, k in out.select(f"{own}.shard", f"{own}.slot").collect():
        per.setdefault(s, []).append(k)
    assert sorted(per) == [0, 1, 2, 3]
    assert all(sorted(v) == list(range(len(v))) for v in per.values())
    assert max(map(len, per.values())) - min(map(len, per.values())) <= 1
    assert by_text(out.drop(own).collect()) == by_text(docs.collect())


def test_same_rows_same_places_whatever_the_partitions(spark):
    docs = documents(spark)
    a = placed(S.shard(docs, bucket_rows=4))
    b = placed(S.shard(docs.repartition(7), bucket_rows=4))
    assert by_text(a) == by_text(b)
    assert by_text(placed(S.shard(docs, seed=5, bucket_rows=4))) != by_text(a)


def test_many_equal_rows_spread_over_buckets(spark, monkeypatch):
    monkeypatch.setattr(S, "COPIES", 10)
    docs = documents(spark, [(None, "same text")] * 400 + [(i, f"text {i}") for i in range(800)])
    held = S.shuffled(docs, bucket_rows=50)
    sizes = [n for _, n in held.groupBy("bucket").count().collect()]
    assert sum(sizes) == 1200 and max(sizes) < 100
    for bound in (0, S.BROADCAST_ROWS):               # by shuffle, by broadcast
        monkeypatch.setattr(S, "BROADCAST_ROWS", bound)
        out = S.shard(docs, bucket_rows=50).select("doc_id", "text", "place.*").collect()
        assert sorted((r.shard, r.slot) for r in out) == [(s, k) for s in range(16) for k in range(75)]
        assert by_text((r.doc_id, r.text) for r in out) == by_text(
            (r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())


def test_every_order_of_a_small_bucket_comes_about_as_often(spark):
    n = 6000
    seen = spark.range(n).select(F.array_join(S.fisher_yates(
        F.array(F.lit(0), F.lit(1), F.lit(2)), 1, F.col("id")), "").alias("o")).groupBy("o").count().collect()
    assert len(seen) == 6 and all(abs(r["count"] - n / 6) < 5 * (n / 6) ** 0.5 for r in seen)


def test_fewer_rows_than_shards_one_shard_and_no_rows(spark):
    got = placed(S.shard(documents(spark, [(1, "a"), (2, None), (None, "")])))
    assert by_text(got) == by_text(brute([(1, "a"), (2, None), (None, "")]))
    one = placed(S.shard(documents(spark), shards=1))
    assert sorted(r[4] for r in one) == list(range(len(TEXTS)))
    empty = S.shard(documents(spark).limit(0))
    assert empty.count() == 0 and empty.columns[-1] == "place"
    with pytest.raises(ValueError):
        S.shard(documents(spark), shards=0)


def test_written_shards_read_back_in_order(spark, tmpdir_path):
    docs = documents(spark).select("doc_id", "text")
    S.write(S.shard(docs, shards=3), tmpdir_path + "/shards")
    back = spark.read.parquet(tmpdir_path + "/shards")
    assert by_text((r.doc_id, r.text) for r in back.collect()) == by_text((i, t) for i, t in TEXTS)
    for s in range(3):
        slots = [r.slot for r in back.filter(F.col("shard") == s).collect()]
        assert sorted(slots) == list(range(len(slots)))


def test_query_and_plan(spark):
    out = op11_sharding(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    plan = out._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert by_text((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in out.collect()) == by_text(brute(rows))
