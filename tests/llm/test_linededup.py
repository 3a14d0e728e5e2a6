import numpy as np

from sievery.llm import linededup as L
from tests.llm.fixtures import TEXTS, documents

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WHITE))


def brute(texts):
    holders = {}
    for i, t in texts:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, t in texts:
        lines = (t or "").split("\n")
        left = [x for x in lines if not (i is not None and len(holders.get(key(x), ())) > 1
                                         and i != min(holders[key(x)]))]
        out.append((str(i), "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out)


def result(df):
    return sorted((str(r["doc_id"]), r["text"], r[-1]["n_lines"], r[-1]["n_dropped"]) for r in df.collect())


def test_equals_brute_force_and_keeps_columns(spark):
    docs = documents(spark)
    out = L.dedup_lines(docs)
    assert out.columns[:-1] == docs.columns
    assert result(out) == brute(TEXTS)


def test_without_filter_the_result_is_the_same(spark, monkeypatch):
    monkeypatch.setattr(L, "MAX_BITS", 8)
    assert L.filter_bits(100) == 0
    assert result(L.dedup_lines(documents(spark))) == brute(TEXTS)


def test_hot_line(spark):
    texts = [(i, f"a very common line\nown line number {i:05}") for i in range(3000)]
    assert result(L.dedup_lines(documents(spark, texts))) == brute(texts)


def test_empty_table(spark):
    assert L.dedup_lines(documents(spark).limit(0)).count() == 0


def test_filter_has_no_false_negatives():
    h = np.random.default_rng(1).integers(0, 2 ** 64, 5000, np.uint64)
    bitmap = np.zeros(L.filter_bits(5000) // 8, np.uint8)
    L.put(bitmap, h[:2500])
    assert L.holds(bitmap, h[:2500]).all()
    assert L.holds(bitmap, h[2500:]).mean() < 0.05
