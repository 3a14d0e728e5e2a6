import numpy as np

from sievery.llm import neardup as N
from tests.llm.fixtures import TEXTS, documents, prose


def brute(texts):
    own = [(i, N.bag((t or "").encode())) for i, t in texts if i is not None]
    parent = {i: i for i, _ in own}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for k, (i, a) in enumerate(own):
        for j, b in own[:k]:
            both, all_ = N.overlap(a, b)
            if all_ and both * 5 >= all_ * 4:
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in parent}


def test_equals_brute_force(spark):
    got = N.near_duplicates(documents(spark)).collect()
    expected = brute(TEXTS)
    assert {r.doc_id: r.class_id for r in got if r.doc_id is not None} == expected
    assert len(got) == len(TEXTS)
    assert all(r.kept == (r.doc_id is None or r.class_id == r.doc_id) for r in got)
    assert all(r.class_id is None for r in got if r.doc_id is None)


def family(n):
    """Texts that differ from a common one in ever more places, so some are linked by chains only."""
    base = prose(9, 300).split()
    out = []
    for i in range(n):
        w = list(base)
        for k in range(i % 12):
            w[(k * 23 + i) % 300] = f"changed{i}x{k}"
        out.append((1000 + i, " ".join(w)))
    return out


def test_dense_family_and_blocks(spark, monkeypatch):
    texts = family(60) + [(2000 + i, prose(100 + i, 80)) for i in range(20)]
    expected = brute(texts)
    for block in (512, 7):
        monkeypatch.setattr(N, "BLOCK", block)
        got = {r.doc_id: r.class_id for r in N.near_duplicates(documents(spark, texts)).collect()}
        assert got == expected


def test_keep_one_keeps_columns_and_the_smallest(spark):
    docs = documents(spark)
    out = N.keep_one(docs)
    assert out.columns == docs.columns
    expected = brute(TEXTS)
    assert sorted(str(r.doc_id) for r in out.collect()) == sorted(
        str(i) for i, _ in TEXTS if i is None or expected[i] == i)


def test_empty_table(spark):
    docs = documents(spark).limit(0)
    assert N.near_duplicates(docs).count() == 0 and N.keep_one(docs).count() == 0


def test_registers_agree_as_often_as_the_weighted_jaccard_similarity():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2 ** 63, 400).astype(np.uint64)
    a, b = rng.integers(1, 9, 400), rng.integers(0, 9, 400)
    truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    agree = []
    for salt in range(30):
        y = N.mix(x + np.uint64(salt))
        doc = np.concatenate([np.repeat(0, a.sum()), np.repeat(1, b.sum())])
        sig = N.signatures(doc, np.concatenate([np.repeat(y, a), np.repeat(y, b)]), 2)
        agree.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(agree) - truth) < 4 * (truth * (1 - truth) / (30 * N.REGISTERS)) ** 0.5


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.id: r.label for r in N.components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_a_large_bucket_with_an_outlier_meets_its_blocks_once(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 10)
    rows = [(7, d, 0, 5) for d in range(1, 1001)] + [(8, d, 0, 5) for d in range(1, 40)]
    labels = [(d, 1) for d in range(1, 1000)] + [(1000, 1000)] + [(d, d) for d in ()]
    held = N.open_buckets(spark.createDataFrame(rows, "key long, doc long, pivot long, size long"),
                          spark.createDataFrame(labels, "id long, label long"))
    assert {r.key for r in held.select("key").distinct().collect()} == {7}       # the other one is settled
    met = N.block_pairs(held).collect()
    assert len(met) <= 2 * 1000 + 200 and {r.doc for r in met} == set(range(1, 1001))
    together = {}
    for r in met:
        together.setdefault((r.i, r.j), []).append(r.label)
    assert all(len(set(x)) == 2 for x in together.values() if len(x) > 1)


def test_every_two_components_of_an_open_bucket_meet(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 10)
    label = {d: (1 if d <= 40 else 2 if d <= 70 else d // 3) for d in range(1, 140)}
    held = N.open_buckets(spark.createDataFrame([(7, d, 0, 5) for d in label], "key long, doc long, pivot long, size long"),
                          spark.createDataFrame(list(label.items()), "id long, label long"))
    blocks = {}
    for r in N.block_pairs(held).collect():
        blocks.setdefault((r.i, r.j), {}).setdefault(r.block, []).append(r.doc)
    met = set()
    for (i, j), sides in blocks.items():
        for a in sides.get(i, ()):
            for b in sides.get(j, ()):
                if label[a] != label[b]:
                    met.add((min(a, b), max(a, b)))
    assert met == {(a, b) for a in label for b in label if a < b and label[a] != label[b]}
    assert max(len(x) for sides in blocks.values() for x in sides.values()) <= 30


def test_documents_without_words_and_many_copies(spark, monkeypatch):
    texts = [(i, "") for i in range(50)] + [(100 + i, prose(3, 60)) for i in range(400)] + [(900, prose(4, 60))]
    got = {r.doc_id: r.class_id for r in N.near_duplicates(documents(spark, texts)).collect()}
    assert got == {**{i: i for i in range(50)}, **{100 + i: 100 for i in range(400)}, 900: 900}
