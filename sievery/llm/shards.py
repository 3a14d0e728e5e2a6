"""Token ids in binary shards compressed by a Re-Pair grammar (operator 9).

Documents are dealt by ranges of their id, encoded, and written in ascending id
order in shards of about ``SHARD_IDS`` ids.  In every shard frequent pairs of
neighbouring symbols are replaced by new symbols, again and again, until no pair occurs
``LEAST_COUNT`` times; a round replaces many pairs at once, chosen by falling count so that no symbol is the
right half of one and the left half of another, which keeps their occurrences
apart.  The shard stores the rules, the length that each rule expands to, and the
remaining sequence, so a range of ids is decoded from the symbols that cover it.

A shard is one binary value; the table of shards (Parquet in the shared folder or
at ``path``) is the file format::

    magic, version, base, rules, symbols, documents, ids            7 x uint32/uint64
    left, right, expansion length of every rule                     uint32 each
    symbols                                                         uint32 each
    document ids (int64), null flags (uint8), ids of each (uint64)

Defined results: a null or empty text is the end id alone; rows without an id
come first; rows that share an id follow each other by the start of their text, then by
its hash, and may lie in several shards; other columns are never read; an empty table gives an empty one.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievery.llm import tokens
from sievery.llm.common import bounded_batches, materialize, spark_of, text_or_empty
from sievery.llm.tokens import pieces_of

END_ID = 2
SHARD_IDS = 1 << 20
PAIRS = 4096                  # new symbols of a round at most
LEAST_COUNT = 16              # of a pair that is replaced
MAGIC, VERSION = 0x52505347, 1
HEAD = struct.Struct("<4I3Q")
TABLE_BITS = 18
HEAD_LETTERS = 32
WRITE_ROWS = 4000             # texts that are encoded together, of at most 16 MB
BROADCAST_SHARDS = 1_000_000  # of starts: at most about 30 MB

SHARDS = "part int, shard int, n_docs long, n_ids long, data binary"


# ------------------------------------------------------------------ grammar

def slots(key: np.ndarray) -> np.ndarray:
    return (key * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def by_count(values: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The pairs that occur ``LEAST_COUNT`` times or more, by falling count."""
    some = n >= LEAST_COUNT
    values, n = values[some], n[some]
    return values[np.lexsort((values, -n))]


def frequent_pairs(key: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """Frequent pairs by falling count, one of each slot of a hash table at most: the last pair of a
    slot is counted.  Another frequent one of the slot comes up once that one is replaced, at the
    latest when no such pair is frequent and all are counted."""
    held = np.zeros(1 << TABLE_BITS, np.uint64)
    held[slot] = key
    found = by_count(held, np.bincount(slot[held[slot] == key], minlength=1 << TABLE_BITS))
    return found if len(found) else by_count(*np.unique(key, return_counts=True))


def chosen_pairs(values: np.ndarray) -> list[int]:
    """Pairs that can be replaced in one round without meeting each other, one for a slot."""
    left, right, taken, out = set(), set(), set(), []
    some = values[:4 * PAIRS]
    for key, slot in zip(some.tolist(), slots(some).tolist(), strict=True):
        a, b = key >> 32, key & 0xFFFFFFFF
        if slot in taken or a in right or b in left or a == b and a in left:
            continue
        taken.add(slot)
        left.add(a)
        right.add(b)
        out.append(key)
        if len(out) == PAIRS:
            break
    return out


def compress(ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(rules as rows left, right; symbols): symbol base + i stands for rule i."""
    s, rules = ids.astype(np.uint32), []
    live = np.arange(max(len(s) - 1, 0))              # places whose pair may be frequent
    while True:
        key = s[live].astype(np.uint64) << np.uint64(32) | s[live + 1]
        slot = slots(key)
        some = np.bincount(slot, minlength=1 << TABLE_BITS)[slot] >= LEAST_COUNT
        live, key, slot = live[some], key[some], slot[some]
        pairs = np.array(chosen_pairs(frequent_pairs(key, slot)), np.uint64)
        if not len(pairs):
            break
        rule_of = np.full(1 << TABLE_BITS, -1, np.int64)
        rule_of[slots(pairs)] = np.arange(len(pairs))
        rule = rule_of[slot]
        hit = np.flatnonzero(rule >= 0)
        hit = hit[pairs[rule[hit]] == key[hit]]
        place, rule = live[hit], rule[hit]
        # only places of a pair of equal symbols can touch: every second one of a run counts
        first = np.ones(len(place), bool)
        first[1:] = place[1:] != place[:-1] + 1
        run = np.maximum.accumulate(np.where(first, np.arange(len(place)), 0))
        even = (np.arange(len(place)) - run) % 2 == 0
        place, rule = place[even], rule[even]
        s = s.copy()
        s[place] = base + len(rules) + rule
        keep, alive = np.ones(len(s), bool), np.zeros(len(s), bool)
        keep[place + 1], alive[live] = False, True
        s, alive, at = s[keep], alive[keep], place - np.arange(len(place))
        # of other pairs only the counts have fallen; those with a new symbol are new
        alive[at] = alive[np.maximum(at - 1, 0)] = True
        live = np.flatnonzero(alive[:-1])
        rules += [(k >> 32, k & 0xFFFFFFFF) for k in pairs.tolist()]
    return np.array(rules, np.uint32).reshape(-1, 2), s


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    out = []
    for a, b in rules.tolist():                       # a rule uses earlier rules only
        out.append((out[a - base] if a >= base else 1) + (out[b - base] if b >= base else 1))
    return np.array(out, np.uint32)


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for.  The rules are opened level by level, each once, behind one
    another in a table of ids, from which the symbols' runs are then taken."""
    lengths = np.ones(base + len(rules), np.int64)
    lengths[base:] = expansion_lengths(rules, base)
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    table = np.empty(int(lengths.sum()), np.uint32)
    table[:base] = np.arange(base)
    level = np.zeros(base + len(rules), np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        level[base + i] = 1 + max(level[a], level[b])
    for k in range(1, int(level.max(initial=0)) + 1):
        own = np.flatnonzero(level == k)
        for side, shift in ((0, np.zeros(len(own), np.int64)), (1, lengths[rules[own - base, 0]])):
            part = rules[own - base, side]
            table[pieces_of(lengths[part], starts[own] + shift)] = table[pieces_of(lengths[part], starts[part])]
    return table[pieces_of(lengths[symbols], starts[symbols])]


# ------------------------------------------------------------------ format

def write_shard(docs: list[int | None], ids: list[bytes]) -> bytes:
    flat = np.frombuffer(b"".join(ids), "<u4")
    base = int(flat.max()) + 1 if len(flat) else 0
    rules, symbols = compress(flat, base)
    return b"".join([
        HEAD.pack(MAGIC, VERSION, base, len(rules), len(symbols), len(docs), len(flat)),
        np.ascontiguousarray(rules[:, 0], "<u4").tobytes(),
        np.ascontiguousarray(rules[:, 1], "<u4").tobytes(),
        expansion_lengths(rules, base).astype("<u4").tobytes(), symbols.astype("<u4").tobytes(),
        np.array([d or 0 for d in docs], "<i8").tobytes(),
        np.array([d is None for d in docs], np.uint8).tobytes(),
        np.array([len(x) // 4 for x in ids], "<u8").tobytes()])


class Shard:
    """Reader of one shard."""

    def __init__(self, data: bytes) -> None:
        magic, version, self.base, rules, symbols, docs, self.n_ids = HEAD.unpack_from(data)
        if (magic, version) != (MAGIC, VERSION):
            raise ValueError("not a token shard")
        at = HEAD.size

        def column(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out
        left, right = column("<u4", rules), column("<u4", rules)
        self.rules = np.stack([left, right], axis=1)
        self.lengths, self.symbols = column("<u4", rules), column("<u4", symbols)
        ids, null = column("<i8", docs), column("u1", docs)
        self.docs = [None if n else d for d, n in zip(ids.tolist(), null.tolist(), strict=True)]
        self.sizes = column("<u8", docs).astype(np.int64)

    def ids(self) -> np.ndarray:
        return expand(self.symbols, self.rules, self.base)

    def range(self, start: int, end: int) -> np.ndarray:
        """Ids start to end (exclusive) of the shard, from the symbols that cover them only."""
        size = np.ones(len(self.symbols), np.int64)
        rule = self.symbols >= self.base
        size[rule] = self.lengths[self.symbols[rule] - self.base]
        stop = np.cumsum(size)
        a, b = np.searchsorted(stop, start, "right"), np.searchsorted(stop, end, "left")
        before = int(stop[a - 1]) if a else 0
        return expand(self.symbols[a:b + 1], self.rules, self.base)[start - before:end - before]


# ------------------------------------------------------------------ operator

def _write(path: str | None, name: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tokens.tokenizer_path(path, name))
        end, part = tokens.packed([end_id]), TaskContext.get().partitionId()
        docs, ids, size, shard = [], [], 0, 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()),
                "n_docs": pa.array([len(docs)], pa.int64()), "n_ids": pa.array([size], pa.int64()),
                "data": pa.array([write_shard(docs, ids)], pa.binary())})
        for b in batches:
            for doc, own in zip(b.column(0).to_pylist(), encode(b.column(1).to_pylist()), strict=True):
                docs.append(doc)
                ids.append(own + end)
                size += len(own) // 4 + 1
                if size >= SHARD_IDS:
                    yield out()
                    docs, ids, size, shard = [], [], 0, shard + 1
        if docs:
            yield out()
    return run


def write(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
          name: str = tokens.WORD_BPE, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Write the shards and return their table as it is read back."""
    spark = spark_of(docs)
    bounded_batches(spark, rows=WRITE_ROWS)
    t = text_or_empty(text)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), t.alias("t"),
                       F.substring(t, 1, HEAD_LETTERS).alias("head"), F.xxhash64(t).alias("h"),
                       F.monotonically_increasing_id().alias("n"))
    # rows that share an id, or lack one, are told apart, so they are cut like any others
    order = ["doc_id", "head", "h", "n"]
    table = (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "t")
             .mapInArrow(_write(tokenizer, name, end_id), SHARDS))
    if path is None:
        return materialize(table, "token-shards")
    table.write.parquet(path)
    return read_table(spark, path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARDS).parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for first, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            shard = Shard(data)
            raw = shard.ids().astype("<u4").tobytes()
            stop = np.cumsum(shard.sizes)
            start = stop - shard.sizes
            for k in range(0, len(stop), 500):
                a, z = start[k:k + 500].tolist(), stop[k:k + 500].tolist()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(shard.docs[k:k + 500], pa.int64()),
                    "start": pa.array([first + x for x in a], pa.int64()),
                    "n_tokens": pa.array([y - x for x, y in zip(a, z, strict=True)], pa.int64()),
                    "ids": pa.array([raw[4 * x:4 * y] for x, y in zip(a, z, strict=True)],
                                    pa.binary())})


def read(shards: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids of every document.

    The shards' starts are sums over (part, shard): first within a part, then over
    the parts, so the one-task window has a row per part only.
    """
    bounded_batches(spark_of(shards))
    sizes = shards.select("part", "shard", "n_ids")
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("before"))
    starts = sizes.select("part", "shard", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("own")
                          ).join(parts, "part").select("part", "shard",
                                                       (F.col("own") + F.col("before")).alias("first"))
    if sizes.count() <= BROADCAST_SHARDS:             # checked; else the shards are shuffled
        starts = F.broadcast(starts)
    return shards.select("part", "shard", "data").join(starts, ["part", "shard"]).select(
        "first", "data").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids binary")
