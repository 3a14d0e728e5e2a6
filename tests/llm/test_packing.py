import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sievery.llm import packing
from tests.llm.fixtures import TEXTS, documents


def test_every_id_in_one_piece_and_no_overlap(spark):
    rows = packing.pack(documents(spark)).collect()
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    whole = {}
    for i, t in TEXTS:
        whole.setdefault(str(i), []).append(tok.encode(t or "", add_special_tokens=False).ids + [1])
    got = {}
    for r in rows:
        assert r.length == len(r.ids) // 4 and 0 < r.length <= 2048
        got.setdefault((str(r.doc_id), r.doc_tokens), []).append((r.start, bytes(r.ids)))
    for i, versions in whole.items():
        for ids in versions:
            parts = sorted(set(got[i, len(ids)]))
            assert np.frombuffer(b"".join(p for _, p in parts), "<u4").tolist() in versions
    assert sum(r.length for r in rows) == sum(len(v) for vs in whole.values() for v in vs)
    for seq in {r.sequence_id for r in rows}:
        own = sorted((r.offset, r.length) for r in rows if r.sequence_id == seq)
        assert [o for o, _ in own] == list(np.cumsum([0] + [n for _, n in own])[:-1])
        assert sum(n for _, n in own) <= 2048


def test_empty_table(spark):
    assert packing.pack(documents(spark).limit(0)).count() == 0


def naive(lengths, capacity):
    left, bins, offsets = [], [], []
    for n in lengths:
        k = next((i for i, c in enumerate(left) if c >= n), len(left))
        if k == len(left):
            left.append(capacity)
        bins.append(k)
        offsets.append(capacity - left[k])
        left[k] -= n
    return bins, offsets


def test_tournament_tree_is_first_fit():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 3, 50, 700):
        lengths = sorted(rng.integers(1, 101, n).tolist(), reverse=True)
        assert packing.first_fit_decreasing(lengths, 100) == naive(lengths, 100)


def test_little_padding(spark):
    from tests.llm.fixtures import prose
    docs = documents(spark, [(i, prose(i, 30 + i * 7 % 900)) for i in range(400)])
    fill = packing.pack(docs).groupBy("sequence_id").agg(F.sum("length").alias("n"))
    used, sequences = fill.agg(F.sum("n"), F.count("*")).first()
    assert used / (sequences * 2048) > 0.99


def test_rows_that_lack_an_id_are_spread_over_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 100)
    docs = documents(spark, [(None, "the same text")] * 500 + [(5, "another text")] * 500)
    groups = {}
    for r in packing.pack(docs).collect():
        groups[r.sequence_id >> 32] = groups.get(r.sequence_id >> 32, 0) + 1
    assert len(groups) == 10 and max(groups.values()) < 200
