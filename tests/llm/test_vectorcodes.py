import hashlib
import math

import numpy as np
from pyspark.sql import types as T

from sievery.llm import vectorcodes as V
from sievery.llm.queries import op12_vector_codes

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()),
                       T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("code", T.StringType()),
                       T.StructField("KEY", T.StringType()), T.StructField("v", T.StringType())])


def frame(spark, rows):
    return spark.createDataFrame([(i, v, n, "c", "k", "v") for i, v, n in rows], SCHEMA).repartition(3)


def brute(rows, rounds=6):
    """Every part against every entry, with plain integers."""
    ok = [(i, [math.floor(4096 * x) for x in v], n) for i, v, n in rows
          if v and None not in v and all(map(math.isfinite, v)) and max(map(abs, v)) < 16384]
    ok.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    first = next((len(v) for _, v, _ in ok if len(v) % 8 == 0), None)
    ok = [r for r in ok if len(r[1]) == first]
    if not ok:
        return [], ""
    m = first // 8
    parts = [[r[1][p * m:(p + 1) * m] for r in ok] for p in range(8)]
    books = [[list(x) for x in parts[p][:16]] for p in range(8)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(8):
            who = [near(x, books[p])[1] for x in parts[p]]
            for e in range(len(books[p])):
                own = [x for x, w in zip(parts[p], who, strict=True) if w == e]
                if own:
                    books[p][e] = [sum(col) // len(own) for col in zip(*own, strict=True)]
    best = [[near(x, books[p]) for x in parts[p]] for p in range(8)]
    out = [(r[0], "".join(f"{best[p][k][1]:02x}" for p in range(8)), sum(best[p][k][0] for p in range(8)), r[2])
           for k, r in enumerate(ok)]
    digest = hashlib.sha256(",".join(str(v) for b in books for c in b for v in c).encode()).hexdigest()
    return [(i, c, e, sum(x[2] for x in out if x[3] == n)) for i, c, e, n in out], digest


def same(got, rows):
    want, digest = brute(rows)
    assert sorted(map(str, [tuple(r)[:4] for r in got])) == sorted(map(str, want))
    assert {r.codebooks_sha256 for r in got} <= {digest}


def test_equal_brute_force_on_clusters(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((30, 32))
    rows = [(i, (centres[i % 30] + rng.standard_normal(32) * 0.05).astype(np.float32).tolist(),
             None if i % 3 == 0 else i % 5) for i in range(900)]
    monkeypatch.setattr(V, "BLOCK", 100)
    same(V.compress(frame(spark, rows)).collect(), rows)


def test_odd_vectors_ties_and_repeated_rows(spark):
    one = [1.0, -0.5, 0.25, 0.0, 3.0, 0.1, -0.1, 9.0]
    rows = [(5, one, 1), (5, one, 1), (5, [x + 1 for x in one], 1), (None, one, 1), (3, one[::-1], None),
            (4, [-x for x in one], None), (7, None, 1), (8, [], 1), (9, [1.0] * 7 + [None], 1),
            (10, [float("nan")] * 8, 1), (11, [float("inf")] * 8, 1), (12, [1.0] * 9, 1), (13, [1.0] * 16, 1),
            (14, [0.0] * 8, 2), (15, [1e-9] * 8, 2), (16, [-1e-9] * 8, 2), (17, [1e30] * 8, 2)]
    got = V.compress(frame(spark, rows)).collect()
    assert len(got) == 9
    same(got, rows)


def test_more_equal_vectors_than_entries(spark):
    rows = [(i, [0.5] * 8, 0) for i in range(40)] + [(i, [float(i % 3)] * 8, 1) for i in range(40, 80)]
    same(V.compress(frame(spark, rows)).collect(), rows)


def test_fewer_rows_than_entries_and_none(spark):
    rows = [(i, [float(i)] * 8, i) for i in range(5)]
    same(V.compress(frame(spark, rows)).collect(), rows)
    out = V.compress(frame(spark, []))
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and out.count() == 0
    assert V.compress(frame(spark, [(1, None, 1), (2, [1.0] * 3, 1)])).count() == 0


def full(x, book):
    d = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
    return d.argmin(axis=1), d.min(axis=1)


def test_balls_give_the_nearest_entry_from_any_start_with_less_work():
    rng = np.random.default_rng(1)
    centres = rng.integers(-9000, 9000, (16, 6))
    x = centres[rng.integers(0, 16, 3000)] + rng.integers(-300, 300, (3000, 6))
    book = np.vstack([centres[:14], centres[:2]]).astype(np.int64)           # equal entries: lower index
    want, far = full(x, book)
    none = np.zeros(16, bool)
    for start in (np.zeros(3000, int), rng.integers(0, 16, 3000), want):
        new, d, work = V.assign(x, start.astype(np.uint8), book, none)
        assert (new == want).all() and (d == far).all()
    assert work < 3000 * 16 / 3                        # from the last codes, most members meet few entries


def test_quiet_balls_are_those_that_no_moved_entry_can_reach():
    book = np.array([[0, 0], [100, 0], [1000, 0], [1100, 0]])
    before = book.copy()
    before[3] = [1101, 0]
    radius = np.array([60, 60, 60, 60]) ** 2
    assert V.quiet_balls(book, before, radius).tolist() == [True, True, False, False]
    assert V.quiet_balls(book, None, radius).tolist() == [False] * 4
    x = np.array([[50, 0], [1050, 0]])
    new, d, _ = V.assign(x, np.array([1, 3], np.uint8), book, np.array([True, True, False, False]))
    assert new.tolist() == [1, 2] and d.tolist() == [-1, 2500]


def test_only_the_last_state_stays_in_the_shared_folder(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(V, "scratch_path", lambda s, name: f"{tmpdir_path}/{name}-{np.random.randint(1 << 60)}")
    coded, _ = V.fit(frame(spark, [(i, [float(i % 7)] * 8, 0) for i in range(50)]))
    import os
    assert len(os.listdir(tmpdir_path)) == 1 and coded.count() == 50


def test_query(spark):
    got = op12_vector_codes(spark, "/root/testdata/sf0.001").collect()
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    same(got, [(r.vec_id, r.embedding, r.label) for r in rows])
