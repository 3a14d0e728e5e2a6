import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from sievery.llm import shards as S
from tests.llm.fixtures import TEXTS, documents


def test_round_trip_equals_the_library(spark, monkeypatch):
    tok = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = sorted(((i is not None, i or 0, t or "") for i, t in TEXTS))
    expected, start = [], 0
    for known, i, t in rows:
        ids = tok.encode(t, add_special_tokens=False).ids + [2]
        expected.append((i if known else None, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    for size in (S.SHARD_IDS, 300):
        monkeypatch.setattr(S, "SHARD_IDS", size)
        got = S.read(S.write(documents(spark))).collect()
        assert sorted(((r.start, r.doc_id, r.n_tokens, bytes(r.ids)) for r in got)) == [
            (s, i, n, b) for i, s, n, b in expected]


def test_empty_table(spark):
    assert S.read(S.write(documents(spark).limit(0))).count() == 0


def test_files_are_read_back_from_a_path(spark, tmpdir_path):
    S.write(documents(spark), path=tmpdir_path + "/shards")
    assert S.read(S.read_table(spark, tmpdir_path + "/shards")).count() == len(TEXTS)


def test_grammar_expands_to_the_ids():
    rng = np.random.default_rng(5)
    for ids in ([], [1], [1, 1], [1] * 101, rng.integers(0, 5, 4000).tolist(),
                rng.zipf(1.5, 20000).clip(0, 9999).tolist(), [1, 2, 1, 2, 3] * 500):
        x = np.array(ids, np.uint32)
        base = int(x.max()) + 1 if len(x) else 0
        rules, symbols = S.compress(x, base)
        assert (S.expand(symbols, rules, base) == x).all()
        lengths = S.expansion_lengths(rules, base)
        assert sum(int(lengths[s - base]) if s >= base else 1 for s in symbols.tolist()) == len(x)
    assert len(symbols) < len(x) / 3 and len(rules)


def test_random_access(spark):
    rng = np.random.default_rng(6)
    docs = [rng.integers(0, 7, n).astype("<u4").tobytes() for n in (0, 5, 3000, 1, 800)]
    shard = S.Shard(S.write_shard([1, None, 3, 4, 5], docs))
    flat = np.frombuffer(b"".join(docs), "<u4")
    assert shard.docs == [1, None, 3, 4, 5] and shard.sizes.tolist() == [0, 5, 3000, 1, 800]
    assert (shard.ids() == flat).all() and len(shard.rules)
    for a, b in ((0, 0), (0, 1), (17, 18), (100, 2000), (3800, len(flat)), (0, len(flat))):
        assert (shard.range(a, b) == flat[a:b]).all()


def test_rounds_go_on_until_no_pair_is_frequent():
    rng = np.random.default_rng(2)
    text = rng.integers(0, 3000, 400)
    copies = np.concatenate([text] * 500).astype(np.uint32)
    rules, symbols = S.compress(copies, 3000)
    assert len(symbols) < 60 and (S.expand(symbols, rules, 3000) == copies).all()
    assert int(S.expansion_lengths(rules, 3000).max()) > 64 * 16
    prose = rng.zipf(1.3, 60000).clip(0, 9999).astype(np.uint32)
    rules, symbols = S.compress(prose, 10000)
    pairs = symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:]
    values, n = np.unique(pairs, return_counts=True)
    same = (values >> np.uint64(32)) == (values & np.uint64(0xFFFFFFFF))
    assert (n[~same] < S.LEAST_COUNT).all() and (S.expand(symbols, rules, 10000) == prose).all()


def test_rows_that_lack_an_id_are_spread_over_parts(spark):
    docs = documents(spark, [(None, "the same text") for _ in range(600)] + [(i, f"text {i}") for i in range(600)])
    merged = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merged, "false")
    try:
        table = S.write(docs)
        parts = [r.n_docs for r in table.collect()]
        got = S.read(table).collect()
    finally:
        spark.conf.set(merged, "true")
    assert sum(parts) == 1200 and max(parts) < 400
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    assert all(r.doc_id is None for r in got if r.start < starts[599][0])
