"""Quality rules as a short-circuit cascade (operator 1, DataFrame functions only).

A document is kept when no rule rejects it.  The rules are an AND, so their
order changes the cost and never the verdict: a bounded sample gives, for
every subset of failing rules, how often it occurs and what each rule costs
there; ``plan_order`` then orders the rules greedily by rejections per cost
among the documents that earlier rules let through.  ``cascade`` is one CASE
expression in that order, so a rejected document skips the dearer rules.

Words are runs of ``[^\\x20\\x09-\\x0D]``.  Defined results: a null or empty
text has no words and fails ``few_words``; rows are judged one by one, so
repeated rows and ties get equal verdicts; other columns are never touched; an
empty table gives an empty result (and the declared order).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievery.llm.common import free_name, text_or_empty

WHITE = " \t\n\u000b\f\r"
SPACES = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"

# Limits (percent where a ratio).
MIN_WORDS = 50
MAX_REPEATED = 50       # words inside repeated 3-word windows
MAX_SYMBOLS = 20        # symbols per 100 words
MAX_DUP_LINES = 50      # repeated lines per 100 lines with a word
WORD_LENGTH = (2, 25)   # mean code points per word

SAMPLE_ROWS = 1000      # rows that the order is estimated on; never changes a verdict


# ------------------------------------------------------------------ measures

def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACES))


def word_chars(w: Column) -> Column:
    return F.char_length(F.array_join(w, ""))


def n_symbols(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))


def word_lines(text: Column) -> Column:
    """Lines with a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")


def n_dup_lines(lines: Column) -> Column:
    return F.size(lines) - F.size(F.array_distinct(lines))


def n_repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in the text.

    Distinct window hashes settle most texts at once.  Otherwise the windows
    are sorted (hash, then the words themselves, then position), neighbours
    that are equal word for word give the repeated starts, and each start
    covers three words less its overlap with the next.  O(n log n), exact.
    """
    n = F.size(w)
    starts = F.sequence(F.lit(0), n - 3)

    def hashed(i: Column) -> Column:
        return F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))

    def window(i: Column) -> Column:
        return F.struct(hashed(i).alias("h"), F.get(w, i).alias("a"), F.get(w, i + 1).alias("b"),
                        F.get(w, i + 2).alias("c"), i.alias("i"))

    def same(x: Column, y: Column) -> Column:
        return ((x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"])
                & (x["c"] == y["c"]))

    def repeated(s: Column) -> Column:
        pairs = F.zip_with(s, F.slice(s, F.lit(2), F.size(s)), lambda x, y: F.when(
            same(x, y), F.array(x["i"], y["i"])).otherwise(F.array().cast("array<int>")))
        return F.sort_array(F.array_distinct(F.flatten(pairs)))

    def covered(p: Column) -> Column:
        steps = F.zip_with(p, F.slice(p, F.lit(2), F.size(p)), lambda x, y: F.least(
            F.lit(3), F.coalesce(y - x, F.lit(3))))
        return F.aggregate(steps, F.lit(0), lambda acc, x: acc + x)

    exact = bind(F.sort_array(F.transform(starts, window)),
                 lambda s: bind(repeated(s), lambda p: F.when(F.size(p) == 0, 0).otherwise(
                     covered(p))))
    return F.when(n < 4, 0).otherwise(bind(
        F.transform(starts, hashed),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(exact)))


# ------------------------------------------------------------------ rules

@dataclass(frozen=True)
class Rule:
    """``fails(text, words)``; ``cost``: estimated work units for one text."""

    name: str
    fails: Callable[[Column, Column], Column]
    cost: Callable[[Column, Column], Column]


RULES: tuple[Rule, ...] = (
    Rule("few_words", lambda t, w: F.size(w) < MIN_WORDS, lambda t, w: F.lit(1.0)),
    Rule("repeated_windows",
         lambda t, w: n_repeat_words(w) * 100 > F.size(w) * MAX_REPEATED,
         lambda t, w: F.size(w) * 30.0 + 1),
    Rule("symbols", lambda t, w: n_symbols(t) * 100 > F.size(w) * MAX_SYMBOLS,
         lambda t, w: F.char_length(t) * 1.0 + 1),
    Rule("repeated_lines",
         lambda t, w: bind(word_lines(t), lambda x: n_dup_lines(x) * 100 > F.size(x)
                           * MAX_DUP_LINES),
         lambda t, w: F.char_length(t) * 0.5 + 1),
    Rule("word_length",
         lambda t, w: bind(word_chars(w), lambda c: (c < F.size(w) * WORD_LENGTH[0])
                           | (c > F.size(w) * WORD_LENGTH[1])),
         lambda t, w: F.size(w) * 2.0 + 1),
)


def estimate(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES,
             sample_rows: int = SAMPLE_ROWS) -> list[tuple[int, list[float]]]:
    """(mask of failing rules, cost of each rule) of about ``sample_rows`` documents, twice
    as many at most, drawn by a hash over all rows.
    """
    t = text_or_empty(text)
    mask = sum((F.when(r.fails(F.col("t"), F.col("w")), 1 << i).otherwise(0)
                for i, r in enumerate(rules)), F.lit(0))
    every = max(1, docs.count() // sample_rows)
    drawn = F.pmod(F.xxhash64("t", F.monotonically_increasing_id()), F.lit(every)) == 0
    rows = (docs.select(t.alias("t")).filter(drawn).limit(2 * sample_rows)
            .select("t", words(F.col("t")).alias("w"))
            .select(mask.alias("m"), F.array(*[r.cost(F.col("t"), F.col("w")).cast("double")
                                               for r in rules]).alias("c")).collect())
    return [(r["m"], list(r["c"])) for r in rows]


def plan_order(sample: list[tuple[int, list[float]]], n_rules: int) -> list[int]:
    """Rule indexes by rejections per cost among the documents still in the cascade."""
    left, order, todo = list(sample), [], list(range(n_rules))
    while todo:
        def worth(i: int) -> float:
            cost = sum(c[i] for _, c in left)
            return sum(m >> i & 1 for m, _ in left) / cost if cost else 0.0
        best = max(todo, key=lambda i: (worth(i), -i))
        order.append(best)
        todo.remove(best)
        left = [(m, c) for m, c in left if not m >> best & 1]
    return order


def ordered_rules(docs: DataFrame, text: str = "text",
                  rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    return tuple(rules[i] for i in plan_order(estimate(docs, text, rules), len(rules)))


def cascade(text: Column, w: Column, order: tuple[Rule, ...]) -> Column:
    """Name of the first rule of ``order`` that rejects the text; null: kept."""
    first, *rest = order
    out = F.when(first.fails(text, w), F.lit(first.name))
    for r in rest:
        out = out.when(r.fails(text, w), F.lit(r.name))
    return out


def rejection(docs: DataFrame, text: str = "text",
              order: tuple[Rule, ...] | None = None) -> Column:
    """The cascade as a column over ``docs``."""
    chosen = order or ordered_rules(docs, text)
    t = text_or_empty(text)
    return bind(words(t), lambda w: cascade(t, w, chosen))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents that no rule rejects, all columns as they were."""
    return docs.filter(rejection(docs, text).isNull())


def annotate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Base measures and verdict of every document.

    Columns: the id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words (long), base_failed, kept.  The base rules need the measures
    of every document, so here the cascade starts from them.
    """
    order = ordered_rules(docs, text)
    t, w = free_name(docs, "t"), "w"
    base = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias(t))
    split = base.select("doc_id", t, words(F.col(t)).alias(w))
    measured = split.select(
        "doc_id", t, w, F.size(w).cast("long").alias("n_words"),
        word_chars(F.col(w)).cast("long").alias("word_chars"),
        n_symbols(F.col(t)).cast("long").alias("n_symbols"),
        bind(word_lines(F.col(t)), n_dup_lines).cast("long").alias("n_dup_lines"),
        n_repeat_words(F.col(w)).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)
    base_rules = ("few_words", "repeated_windows")
    rest = tuple(r for r in order if r.name not in base_rules)
    verdict = F.when(failed, F.lit(False)).otherwise(
        cascade(F.col(t), F.col(w), rest).isNull())
    return measured.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                           "n_repeat_words", failed.alias("base_failed"),
                           verdict.alias("kept"))
