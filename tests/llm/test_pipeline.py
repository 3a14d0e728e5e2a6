import corpus_pipeline
from sievery.llm import linededup, neardup, packing, quality, secretscan
from tests.llm.test_linededup import brute as lines_of
from tests.llm.test_neardup import brute as classes_of
from tests.llm.test_quality import brute as measures_of
from tests.llm.fixtures import prose

SECRET = 'token = "0123456789abcdef0123456789abcdef01234567"'
LINE = "Licensed under some well known licence text."
BODY = prose(21, 150)
TEXTS = [(1, BODY + "\n" + LINE), (2, BODY + "\n" + LINE), (3, prose(22, 200) + "\n" + LINE + "\n" + SECRET),
         (4, "too short"), (5, "word " * 80), (6, None), (7, BODY.replace("alpha", "other", 1)),
         (8, prose(23, 90))]


def documents(spark):
    from pyspark.sql import Row
    return spark.createDataFrame([Row(doc_id=i, text=t, lang="en", source="s", n_chars=len(t or ""))
                                  for i, t in TEXTS], "doc_id long, text string, lang string, source string, n_chars long")


def test_stages_equal_brute_force(spark):
    docs = documents(spark)
    columns = docs.columns
    expected = [(i, t) for i, t in TEXTS if measures_of(t)[-1]]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_dedup", "secret_scans", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == columns
        if name == "line_dedup":
            expected = [(int(i), t) for i, t, _, _ in lines_of(expected)]
        elif name == "near_dedup":
            of = classes_of(expected)
            expected = [(i, t) for i, t in expected if of[i] == i]
        elif name == "secret_scans":
            expected = [(i, secretscan.masked(t, secretscan.scan(t))) for i, t in expected]
        rows = docs.collect()
        assert sorted((r.doc_id, r.text) for r in rows) == sorted(expected), name
        assert all(r.n_chars == len(r.text) and r.lang == "en" for r in rows)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert {r.doc_id for r in out} == {i for i, _ in expected}
    assert sum(r.length for r in out) == sum({r.doc_id: r.doc_tokens for r in out}.values())


def test_run_reads_the_table_and_is_registered(spark):
    import __spark_entry__ as E
    assert E.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in E.oracle_sql()
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    ops = [q for q in E.queries() if q.startswith("op")]
    assert sorted(int(q[2:].split("_")[0]) for q in ops) == list(range(1, 14))


def test_stages_take_empty_tables(spark):
    docs = documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 0


def test_operators_are_imported_by_nothing_else():
    import pathlib
    root = pathlib.Path(corpus_pipeline.__file__).parent
    for path in [*(root / "sievery").rglob("*.py"), *(root / "tools").rglob("*.py"), root / "bench.py"]:
        if "llm" not in path.parts:
            assert "sievery.llm" not in path.read_text() and "from .llm" not in path.read_text()
    assert all((quality, linededup, neardup, packing))
