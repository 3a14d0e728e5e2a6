import re

from sievery.llm import quality as Q
from tests.llm.fixtures import TEXTS, documents


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {j for at in seen.values() if len(at) > 1 for i in at for j in (i, i + 1, i + 2)}
    n, chars, symbols = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text))
    dup = len(lines) - len(set(lines))
    failed = n < 50 or 100 * len(covered) > 50 * n
    kept = not (failed or symbols * 100 > n * 20 or dup * 100 > 50 * len(lines)
                or chars < 2 * n or chars > 25 * n)
    return n, chars, symbols, dup, len(covered), failed, kept


def test_measures_equal_brute_force(spark):
    got = Q.annotate(documents(spark)).collect()
    assert sorted((str(r[0]), tuple(r)[1:]) for r in got) == sorted(
        (str(i), brute(t)) for i, t in TEXTS)


def test_keep_good_keeps_columns_and_rows(spark):
    docs = documents(spark)
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(
        str(i) for i, t in TEXTS if brute(t)[-1])


def test_empty_table(spark):
    docs = documents(spark).limit(0)
    assert Q.annotate(docs).count() == 0 and Q.keep_good(docs).count() == 0


def test_order_is_by_rejections_per_cost_and_never_changes_a_verdict(spark):
    # rule 1 rejects most for its cost; of what it lets through rule 0 rejects more than rule 2
    sample = [(0b010, [1, 1, 4])] * 6 + [(0b011, [1, 1, 4])] * 2 + [(0b001, [1, 1, 4]), (0b100, [1, 1, 4])]
    assert Q.plan_order(sample, 3) == [1, 0, 2]
    assert sorted(Q.plan_order([], 3)) == [0, 1, 2]
    docs = documents(spark)
    for order in (Q.RULES, Q.RULES[::-1]):
        rejected = docs.select("doc_id", Q.rejection(docs, order=order).isNull().alias("kept"))
        assert sorted((str(i), k) for i, k in rejected.collect()) == sorted(
            (str(i), brute(t)[-1]) for i, t in TEXTS)


def test_no_python_on_the_main_path(spark):
    plan = Q.annotate(documents(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
