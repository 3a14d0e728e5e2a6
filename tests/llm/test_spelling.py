import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sievery.llm import spelling as S
from sievery.llm.queries import op13_spelling_variants
from tests.llm.fixtures import TEXTS, documents

LETTERS = "abcdeé"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def brute(rows):
    n = brute_words(rows)
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda x: (-n[x], x))
            if n[best] >= 5 * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return sorted(out, key=str)


def typed(rng, word):
    i, c = rng.randrange(len(word) + 1), rng.choice(LETTERS)
    return rng.choice([word[:i] + c + word[i:], word[:i] + c + word[i + 1:], word[:i] + word[i + 1:]])


def test_variants_equal_brute_force(spark):
    rng = random.Random(3)
    base = ["".join(rng.choices(LETTERS, k=rng.randrange(6, 11))) for _ in range(60)]
    rows = []
    for doc in range(300):
        own = []
        for _ in range(40):
            word = rng.choice(base[:1 + doc % 60])
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                word = typed(rng, word)
            own.append(word.upper() if rng.random() < 0.1 else word)
        rows.append((doc, rng.choice([" ", ", ", "\n", "7"]).join(own)))
    rows.append((900, "chainword " * 160 + "chainwort " * 30 + "cheinwort " * 5))
    got = S.variants(documents(spark, rows)).collect()
    want = brute(rows)
    assert sorted(map(tuple, got), key=str) == want
    assert any(r[1] and r[1] != r[2] for r in want)               # a chain of forms


@pytest.mark.parametrize("least", [1, 3, 64])
def test_near_pairs_equal_brute_force(spark, monkeypatch, least):
    """Grams of every length, words whose every gram may change, lists that are split."""
    monkeypatch.setattr(S, "LEAST_FREQUENT", least)
    rng = random.Random(least)
    words = {"".join(rng.choices("ab", k=rng.randrange(6, 9))) for _ in range(300)}
    words |= {"aaaaaa" + "".join(rng.choices("abc", k=rng.randrange(0, 5))) for _ in range(200)}
    words |= {"ab" * 31, "ab" * 31 + "a", "ab" * 32, "ab" * 32 + "b", "a" * 500, "a" * 501, "b" + "a" * 500}
    words |= {typed(rng, w) for w in list(words)}
    words = sorted(w for w in words if len(w) >= 6)
    table = spark.createDataFrame([(w, 5 + k % 7) for k, w in enumerate(words)], "word string, n long")
    got = S.near_pairs(table).collect()
    want = {(a, b, 5 + k % 7) for a in words for k, b in enumerate(words) if one_edit(a, b)}
    assert len(got) == len(want) and set(map(tuple, got)) == want


def test_an_edit_changes_no_more_grams_than_the_bound():
    rng = random.Random(11)
    for trial in range(300):
        seen = ["".join(rng.choices("abc", k=8)) for _ in range(rng.choice([1, 5, 40]))]
        count = Counter(w[a:a + k] for w in seen for k in (2, 3) for a in range(9 - k))
        frequent = {g: n for g, n in count.items() if n > 2}
        frequent = {g: n for g, n in frequent.items() if g[:2] in frequent}
        grams = S.Grams(frequent)
        word = "".join(rng.choices("abc", k=rng.randrange(6, 12)))
        lost = grams.lost(word, grams.cut(word))
        assert grams.cut(word)[-1][1] == len(word)
        for i in range(len(word) + 1):
            for c in ("a", "b", "c", "z", ""):
                for other, behind in ((word[:i] + c + word[i:], i), (word[:i] + c + word[i + 1:], i + 1)):
                    if len(other) < 2 or behind > len(word):
                        continue
                    there, shift = set(grams.cut(other)), len(other) - len(word)
                    stay = sum((z <= i and (a, z) in there) or (a >= behind and (a + shift, z + shift) in there)
                               for a, z in grams.cut(word))
                    assert len(grams.cut(word)) - stay <= lost
                    if one_edit(word, other):
                        common = set(grams.keys(word)) & set(grams.keys(other))
                        assert common


def test_words_null_texts_repeated_rows_and_case(spark):
    rows = TEXTS + [(None, "ÀÉîøß ÀÉîøßx ÷×÷×÷× plainword Plainword PLAINWORD")] * 5
    got = {r.word: r.n for r in S.words(documents(spark, rows)).collect()}
    assert got == brute_words(rows) and "plainword" in got and "ÀÉîøßx" in got and "÷×÷×÷×" in got


def test_empty_table_and_no_near_words(spark):
    out = S.variants(documents(spark).limit(0))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"] and out.count() == 0
    rows = [(1, "wonderful " * 5)]
    assert [tuple(r) for r in S.variants(documents(spark, rows)).collect()] == [
        ("wonderful", None, "wonderful", 5, 0, None)]


def test_ties_go_to_the_first_word(spark):
    rows = [(k, ("abcdex " + "abcdey " * 5 + "abcdea " * 5) * 5) for k in (1,)]
    assert brute(rows) == sorted(map(tuple, S.variants(documents(spark, rows)).collect()), key=str)


def test_roots_by_jumps(spark):
    chain = [(f"w{i:03}", f"w{i + 1:03}") for i in range(37)] + [("x", "w010"), ("y", "z")]
    got = dict(S.roots(spark.createDataFrame(chain, "word string, form string")).collect())
    assert got == {**{f"w{i:03}": "w037" for i in range(37)}, "x": "w037", "y": "z"}
    assert S.roots(spark.createDataFrame([], "word string, form string")).count() == 0


def test_long_lists_are_split(spark):
    rows = [("<ab", f"ab{i:03}".translate(str.maketrans("0123456789", "cdefghijkl")), 5) for i in range(300)]
    lists = S.split_lists(spark.createDataFrame(rows, "key string, word string, n long"), 20)
    assert lists.groupBy("key").count().agg(F.max("count")).first()[0] <= 31
    assert {r.word for r in lists.collect()} == {w for _, w, _ in rows}


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = op13_spelling_variants(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got), key=str) == brute([tuple(r) for r in rows])
