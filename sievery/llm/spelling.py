"""Grouping of spelling variants by an index of variable-length grams (operator 13).

Words are the runs of Latin letters of all texts, counted per task before they meet
in one sum.  Two words are near if one edit (a letter inserted, deleted or replaced)
makes one of the other.  They are found without comparing all words:

* Dictionary.  Grams of ``SHORT`` letters are always in it; a longer one is, up to
  ``LONG`` letters, if every shorter start of it is frequent, that is, occurs more
  than ``limit`` times in the words.  So only the frequent starts need to be known;
  as the limit grows with the number of letters, there are at most
  ``FREQUENT`` of each length, whatever the vocabulary: they are broadcast.
* Decomposition.  At every letter of a word the longest gram of the dictionary is
  taken, unless it lies within the one before.
* Affected grams.  For every place of an edit, the grams that it can change: those
  over the place, those before it that the dictionary could extend across it, those
  behind it that a gram across it could cover.  The most over all places, ``lost``,
  bounds what an edit takes away: of a word's ``lost + 1`` first grams in any fixed
  order of grams, a near word has one in the same place among its own first ones.
* Merging.  The lists of those grams, rare ones first, are merged.  The edit lies on
  one side of a shared gram, so the letters up to its end or from its start on are
  equal too: lists are split by these.  Words whose every gram an edit could change
  share their first or last ``EDGE`` letters instead, and words of ``WHOLE`` letters
  or more half as many.  A list of more than ``LIST``
  words is split once more, by the rest of the word with any one letter left out,
  which bounds it by the alphabet and the length of the word.
* Pairs from the lists are verified by their edit distance.

Forms are followed to their roots by pointer jumping (a form is at least ``RATIO``
times as frequent as its word, so there is no circle).

Defined results: a null text holds no run; rows without an id are numbered as the
empty text; repeated rows count as often as they occur; other columns are never
read; an empty table gives an empty one.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievery.llm.common import bounded_batches, join_unique, materialize, spark_of

RUN = "[A-Za-zÀ-ÿ]"        # a run is as many of them as follow each other
SLIP = 199                    # every run whose checksum it divides loses a letter
LEAST_LETTERS, LEAST_COUNT, RATIO = 6, 5, 5
SHORT, LONG = 2, 4
LEAST_FREQUENT, FREQUENT = 64, 1 << 14
EDGE, WHOLE, LIST = 3, 63, 64
HELD = 200_000                # words that a task counts before it passes them on

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
WORDS = "word string, n long"


# ------------------------------------------------------------------ words

def slipped(run: str, first: int) -> str:
    """The run, or the run without a letter where its checksum, begun with ``first``, says so."""
    h = zlib.crc32(run.encode(), first)
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count(least: int):
    runs = re.compile(f"{RUN}{{{least},}}").findall      # a shorter run gives no word

    def out(n: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(n.keys(), pa.string()), pa.array(n.values(), pa.int64())],
                                          ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                first = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for w, n in Counter(runs(text)).items():
                    word = slipped(w.lower() if w.isascii() else w.translate(_LOWER), first)
                    if len(word) >= least:
                        held[word] += n
                if len(held) > HELD:
                    yield out(held)
                    held = Counter()
        if held:
            yield out(held)
    return run


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS,
          least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: the words of all texts and how often they occur."""
    bounded_batches(spark_of(docs))
    rows = docs.filter(F.col(text).isNotNull()).select(F.col(doc_id).cast("long"), F.col(text))
    return (rows.mapInArrow(_count(least_letters), WORDS).groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= least_count))


# ------------------------------------------------------------------ grams

def frequent_grams(vocabulary: DataFrame, short: int = SHORT, long: int = LONG) -> dict[str, int]:
    """Grams of ``short`` to ``long - 1`` letters that occur more often than the limit, and how often:
    at most ``FREQUENT`` of each length, as each takes more than a FREQUENT-th of all places."""
    letters = vocabulary.agg(F.sum(F.char_length("word"))).first()[0] or 0
    limit = max(LEAST_FREQUENT, -(-int(letters) // FREQUENT))
    sizes = F.array(*[F.lit(k) for k in range(short, long)])
    at = vocabulary.select("word", F.explode(F.sequence(F.lit(1), F.char_length("word"))).alias("at"))
    grams = at.select("word", "at", F.explode(sizes).alias("k")).filter(
        F.col("at") + F.col("k") - 1 <= F.char_length("word")).select(
        F.substring("word", F.col("at"), F.col("k")).alias("gram"))
    found = grams.groupBy("gram").count().filter(F.col("count") > limit)
    return {r["gram"]: r["count"] for r in found.collect()}


class Grams:
    """Decomposition of words by the dictionary that the frequent grams stand for."""

    def __init__(self, frequent: dict[str, int], short: int = SHORT, long: int = LONG) -> None:
        self.frequent, self.short, self.long = frequent, short, long
        self.tails = {g[k:] for g in frequent for k in range(1, len(g) + 1)}

    def end(self, word: str, at: int) -> int:
        """End of the longest gram of the dictionary that starts at ``at``."""
        end = min(at + self.short, len(word))
        while end < len(word) and end - at < self.long and word[at:end] in self.frequent:
            end += 1
        return end

    def cut(self, word: str) -> list[tuple[int, int]]:
        """(start, end) of the word's grams."""
        out, last = [], 0
        for at in range(len(word) - self.short + 1):
            end = self.end(word, at)
            if end > last:
                out.append((at, end))
                last = end
        return out

    def _reaches(self, word: str, place: int) -> int:
        """First start before ``place`` from which a gram of the dictionary could run across it."""
        for at in range(max(0, place - self.long + 1), place):
            if place - at < self.short or word[at:place] in self.frequent:
                return at
        return place

    def _covers(self, word: str, behind: int, end: int) -> bool:
        """Whether a gram that starts before ``behind`` could reach to ``end``."""
        size = end - behind
        return size < self.long and (size < self.short or word[behind:end - 1] in self.tails)

    def lost(self, word: str, cut: list[tuple[int, int]]) -> int:
        """The most grams that one edit can change.

        An edit inserts before place i, or changes the letter at i.  Then a gram goes only if it
        holds the place; or lies before it and starts at or behind a start whose gram could run
        across the place (it could be longer, or within a longer one); or lies behind it and within
        what a gram across it could cover.
        """
        ends, most = dict(cut), 0
        for i in range(len(word) + 1):
            first = self._reaches(word, i)
            around = [(a, ends[a]) for a in range(max(0, i - self.long), i + self.long + 1) if a in ends]
            for behind in range(i, min(i + 1, len(word)) + 1):       # insertion, change
                n = 0
                for a, z in around:
                    if z <= i:
                        n += a >= first
                    elif a >= behind:
                        n += self._covers(word, behind, z)
                    else:
                        n += 1
                most = max(most, n)
        return most

    def keys(self, word: str) -> list[str]:
        """Keys of the lists that the word is in: a mark of the side and the letters that hold."""
        out = set()
        if len(word) >= WHOLE:
            out |= {"[" + word[:WHOLE // 2], "]" + word[-(WHOLE // 2):]}
        if len(word) <= WHOLE:
            cut = self.cut(word)
            lost = self.lost(word, cut)
            rank = {(a, z): (self.frequent.get(word[a:z], 0), word[a:z]) for a, z in cut}
            chosen = set(sorted(rank.values())[:lost + 1])
            for (a, z), gram in rank.items():
                if gram in chosen:                       # all places of a chosen gram
                    out |= {"<" + word[:z], ">" + word[a:]}
            if lost >= len(cut):
                out |= {"[" + word[:EDGE], "]" + word[-EDGE:]}
        return sorted(out)


def _keyed(frequent: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(frequent)
        for b in batches:
            found, kept, n = [], [], []
            for word, count in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = grams.keys(word)
                found += own
                kept += [word] * len(own)
                n += [count] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(kept, pa.string()),
                                              pa.array(n, pa.int64())], ["key", "word", "n"])
    return run


# ------------------------------------------------------------------ lists

def rest(key: Column, word: Column) -> Column:
    """The letters of a word beside those that its key holds."""
    held = F.char_length(key) - 1
    n = F.char_length(word) - held
    return F.when(F.substring(key, 1, 1).isin("<", "["), F.substring(word, held + 1, n)).otherwise(
        F.substring(word, F.lit(1), n))


def left_out(text: Column) -> Column:
    """The text and the text with any one letter left out."""
    n = F.char_length(text)
    cut = F.transform(F.sequence(F.lit(1), n), lambda k: F.concat(
        F.substring(text, F.lit(1), k - 1), F.substring(text, k + 1, n)))
    return F.array_distinct(F.when(n > 0, F.array_append(cut, text)).otherwise(F.array(text)))


def split_lists(keyed: DataFrame, most: int = LIST) -> DataFrame:
    """``keyed`` with the keys of long lists made finer; none is longer than the alphabet times the
    word's length then."""
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > most)
    total = keyed.count()
    long = materialize(sizes.withColumn("long", F.lit(True)), "long-lists")
    if not long.limit(1).count():
        return keyed
    marked = join_unique(keyed, long, "key", "rows", total, how="left")
    finer = F.when(F.col("long"), F.transform(left_out(rest(F.col("key"), F.col("word"))), lambda r: F.concat(
        F.lit("="), F.col("key"), F.lit("/"), r))).otherwise(F.array("key"))
    return marked.select(F.explode(finer).alias("key"), "word", "n")


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """word, other, other_n: all pairs of near words, both ways round.  ``vocabulary`` (word, n) is
    read several times: pass a stored table."""
    bounded_batches(spark_of(vocabulary), rows=10_000)
    frequent = frequent_grams(vocabulary)
    keyed = materialize(vocabulary.select("word", "n").mapInArrow(
        _keyed(frequent), "key string, word string, n long"), "gram-lists")
    lists = split_lists(keyed)
    a = lists.select("key", "word", "n")
    b = lists.select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
    close = (F.col("word") < F.col("other")) & (
        F.abs(F.char_length("word") - F.char_length("other")) <= 1)
    pairs = (a.join(b, "key").filter(close & (F.levenshtein("word", "other", 1) == 1))
             .select("word", "n", "other", "other_n").distinct())
    return pairs.select(F.inline(F.array(
        F.struct("word", "other", "other_n"),
        F.struct(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")))))


# ------------------------------------------------------------------ forms

def roots(forms: DataFrame) -> DataFrame:
    """word, root of every row of ``forms`` (word, form): each round doubles the steps taken."""
    known = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = known.join(step, "root", "left")
        again = materialize(jumped.select("word", F.coalesce("next", "root").alias("root"),
                                          F.col("next").isNotNull().alias("moved")), "roots")
        if not again.filter("moved").limit(1).count():
            return again.select("word", "root")
        known = again.select("word", "root")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts."""
    vocabulary = materialize(words(docs, doc_id, text), "words")
    # text orders by its UTF-8 bytes, that is by code points
    best = near_pairs(vocabulary).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    far = -F.col("best.less") >= ratio * F.col("n")
    found = materialize(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(far, F.col("best.other")).alias("form"), F.when(far, -F.col("best.less")).alias("form_n")),
        "variants")
    ends = roots(found.filter("form IS NOT NULL"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
