import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievery.llm import ann
from sievery.llm.common import read_table

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()),
                       T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("rank", T.StringType()), T.StructField("code", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "r", "c") for i, v in rows], SCHEMA).repartition(3)


def brute(rows, k=10):
    ok = [(i, np.array(v, np.float64)) for i, v in rows
          if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, x in ok:
        if q % 100 == 0:
            best = {}
            for i, y in ok:
                if i != q and len(y) == len(x):
                    s = float(np.sqrt(((y - x) ** 2).sum()))
                    best[i] = min(s, best.get(i, s))
            out[q] = sorted((s, i) for i, s in best.items())[:k]
    return out


def search(spark, rows):
    return ann.search(frame(spark, rows), F.col("vec_id") % 100 == 0).collect()


def test_recall_and_exact_scores_on_the_table(spark):
    table = read_table(spark, "/root/testdata/sf0.01", "embeddings")
    got = ann.search(table, F.col("vec_id") % 100 == 0).collect()
    expected = brute([(r.vec_id, list(r.embedding)) for r in table.collect()])
    found = sum(any(r.vec_id == i and abs(r.score - s) < 1e-12 for s, i in expected[r.query_id]) for r in got)
    assert found >= 0.9 * sum(map(len, expected.values()))
    for q in expected:
        own = sorted((r.rank, r.score, r.vec_id) for r in got if r.query_id == q)
        assert [r for r, _, _ in own] == list(range(1, len(own) + 1))
        assert [x[1:] for x in own] == sorted(x[1:] for x in own)


def test_clusters_are_found_exactly(spark, monkeypatch):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((20, 16)) * 20
    rows = [(i, (centres[i % 20] + rng.standard_normal(16) * 0.1).astype(np.float32).tolist())
            for i in range(2000)]
    monkeypatch.setattr(ann, "PART", 50)
    got = {}
    for r in search(spark, rows):
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    for q, best in brute(rows).items():
        assert [v for _, v in sorted(got[q])] == [i for _, i in best]


def test_queries_of_a_region_are_dealt_into_parts(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(4).tolist()) for i in range(1200)]
    whole = sorted(map(tuple, ann.search(frame(spark, rows), F.col("vec_id") % 3 == 0).collect()))
    monkeypatch.setattr(ann, "QUERY_PART", 30)
    monkeypatch.setattr(ann, "PART", 200)
    parts = sorted(map(tuple, ann.search(frame(spark, rows), F.col("vec_id") % 3 == 0).collect()))
    found = {}
    for q, _, v, _ in parts:
        found.setdefault(q, set()).add(v)
    assert len(parts) == len(whole) == 4000
    hit = sum(len({v for q2, _, v, _ in whole if q2 == q} & found[q]) for q in list(found)[:40])
    assert hit >= 0.9 * 400


def test_queries_that_no_probe_settles_are_finished_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(6) * (1 + 50 * (i % 7 == 0))).tolist()) for i in range(700)]
    monkeypatch.setattr(ann, "SURE", 1.1)                 # none is ever sure
    monkeypatch.setattr(ann, "BLOCK_BYTES", 100)          # two queries a block
    got = {}
    for r in ann.search(frame(spark, rows), F.col("vec_id") % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    want = brute([(i, np.float32(v).tolist()) for i, v in rows])
    assert {q: [v for _, v in sorted(x)] for q, x in got.items()} == {q: [i for _, i in b] for q, b in want.items()}


def test_odd_vectors_ties_and_repeated_rows(spark):
    one = [1.0, 0.0, 0.0]
    rows = [(0, one), (100, one), (5, one), (5, one), (3, one), (7, [0.0, 0.0, 0.0]), (8, None), (9, []),
            (10, [1.0, None, 0.0]), (11, [1.0, float("nan"), 0.0]), (12, [float("inf"), 0.0, 0.0]),
            (None, one), (13, [1.0, 0.0]), (200, [1.0, 0.0]), (14, [1.0, 0.5, 0.0])]
    got = {}
    for r in search(spark, rows):
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == [0, 100, 200]
    assert sorted(got[0]) == [(1, 3, 0.0), (2, 5, 0.0), (3, 100, 0.0), (4, 14, 0.5)]
    assert sorted(got[200]) == [(1, 13, 0.0)]


def test_many_copies_of_one_vector(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART", 100)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(1500)]
    got = {}
    for r in search(spark, rows):
        got.setdefault(r.query_id, []).append(r.vec_id)
    for q, found in got.items():
        assert sorted(found) == [i for i in range(11) if i != q][:10]
    assert len(got) == 15


def test_empty_table(spark):
    assert search(spark, []) == []


def test_probes_come_in_order_of_success():
    place = np.array([[0.1, 0.5, 0.95, 0.4, 0.5, 0.6]])
    visited = ann.probed(place)[0]
    assert visited[0].tolist() == [0, 0, 0, 0, 0, 0]
    assert visited[1].tolist() == [0, 0, 1, 0, 0, 0] and visited[2].tolist() == [-1, 0, 0, 0, 0, 0]
    assert len({tuple(v) for v in visited.tolist()}) == min(ann.PROBES, 3 ** ann.HASHES)


def recall(got, expected, queries):
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    return sum(len(found.get(q, set()) & {i for _, i in expected[q]}) for q in queries) / sum(
        len(expected[q]) for q in queries)


def near_copies_first(seed=5, n=6000, dim=32):
    """Unit vectors, of which those stored first, a third, are near copies of one."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[:n // 3] = x[0] + rng.standard_normal((n // 3, dim)) * 0.001
    return x


def in_order(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)],
                                 "vec_id long, embedding array<double>")


def test_near_copies_stored_first_do_not_set_the_width_for_all(spark):
    x = near_copies_first()
    got = ann.search(in_order(spark, x), F.col("vec_id") % 100 == 0).collect()
    expected = brute([(i, v.tolist()) for i, v in enumerate(x)])
    inside, outside = recall(got, expected, range(0, 2000, 100)), recall(got, expected, range(2000, 6000, 100))
    print("recall inside", inside, "outside", outside)
    assert inside >= 0.9 and outside >= 0.9


def test_far_queries_get_all_their_neighbours(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((4000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[::100] *= 4                                      # every query lies far from all others
    got = ann.search(in_order(spark, x), F.col("vec_id") % 100 == 0).collect()
    expected = brute([(i, v.tolist()) for i, v in enumerate(x)])
    print("recall of far queries", recall(got, expected, expected), "rows", len(got), "of", 10 * len(expected))
    assert len(got) == 10 * len(expected) and recall(got, expected, expected) >= 0.9
