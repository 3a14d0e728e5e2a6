"""Line de-duplication with two Bloom filters (operator 2).

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z
lower-cased.  A key of at least ``MIN_CHARS`` code points that at least two
documents hold loses all its lines except those in the smallest doc_id.

1. Every task sets the hashes of its documents' keys in two Bloom filters, one
   for keys seen once and one for keys seen in a second document.  The filters'
   non-empty blocks are merged block by block (a key is seen twice if two tasks
   have it once); only the merged *twice* filter, at most ``MAX_BITS`` bits, is
   broadcast.
2. Only lines that the filter suspects are shuffled, with their whole keys: a
   partial aggregate per key confirms repeats exactly and picks the smallest id.
   Very frequent keys (at most 1000) get it by broadcast, the others by a join.
3. Each document gets the list of its own keys to drop.

Beyond ``MAX_BITS / MIN_BITS_PER_LINE`` lines the filter would pass nearly all,
so every line counts as suspected and step 2 settles all of them exactly.

Defined results: a null or empty text is one empty line; a row without an id is
neither first nor repeated and keeps its lines; rows that share an id are one
document; other columns are kept as they are; an empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievery.llm.common import (bounded_batches, free_name, join_unique, materialize, spark_of,
                                text_or_empty)

MIN_CHARS = 10
BITS_PER_LINE = 16
MIN_BITS_PER_LINE = 4
MAX_BITS = 1 << 30          # 128 MB: the size bound of the broadcast
BLOCK = 1 << 13             # bytes of a filter block


def line_keys(text: bytes) -> list[bytes]:
    """Key of every line, in order (``bytes`` methods touch ASCII only)."""
    return [x.strip() for x in text.lower().split(b"\n")]


def long_enough(key: bytes) -> bool:
    n = len(key)
    return n >= 4 * MIN_CHARS or (n >= MIN_CHARS and len(key.decode("utf-8", "replace")) >= MIN_CHARS)


def document_keys(text: bytes) -> set[bytes]:
    return {k for k in line_keys(text) if long_enough(k)}


def hashes(keys) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64)


def probes(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Two bit positions of each hash; ``bits`` is a power of two."""
    mask = np.uint64(bits - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
                                         >> np.uint64(20) & mask).astype(np.int64)


def holds(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    found = np.ones(len(h), bool)
    for p in probes(h, 8 * len(bitmap)):
        found &= (bitmap[p >> 3] >> (p & 7).astype(np.uint8) & 1).astype(bool)
    return found


def put(bitmap: np.ndarray, h: np.ndarray) -> None:
    for p in probes(h, 8 * len(bitmap)):
        np.bitwise_or.at(bitmap, p >> 3, (1 << (p & 7)).astype(np.uint8))


def _packed(a: np.ndarray) -> bytes:
    return zlib.compress(a.tobytes(), 1) if a.any() else b""


def _unpacked(b: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(b), np.uint8) if b else np.zeros(BLOCK, np.uint8)


def _sketch(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for b in batches:
            found = [hashes(document_keys(t)) for t in b.column(0).cast(pa.binary()).to_pylist()]
            if not found:
                continue
            h, n = np.unique(np.concatenate(found), return_counts=True)
            put(twice, h[(n > 1) | holds(once, h)])
            put(once, h)
        full = np.flatnonzero(once.reshape(-1, BLOCK).any(axis=1))
        for i in range(0, len(full), 256):
            part = [int(k) for k in full[i:i + 256]]
            yield pa.RecordBatch.from_pydict({
                "block": pa.array(part, pa.int32()),
                "once": pa.array([_packed(once[k * BLOCK:(k + 1) * BLOCK]) for k in part], pa.binary()),
                "twice": pa.array([_packed(twice[k * BLOCK:(k + 1) * BLOCK]) for k in part], pa.binary())})
    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, read as a stream: one block's two bitmaps are held."""
    block, once, twice = None, None, None

    def out():
        return pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()),
                                           "twice": pa.array([_packed(twice)], pa.binary())})
    for b in batches:
        for k, o, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if k != block:
                if block is not None and twice.any():
                    yield out()
                block, once, twice = k, np.zeros(BLOCK, np.uint8), np.zeros(BLOCK, np.uint8)
            o, t = _unpacked(o), _unpacked(t)
            twice |= t | (once & o)
            once |= o
    if block is not None and twice.any():
        yield out()


def filter_bits(n_lines: int) -> int:
    """Bits of one filter (a power of two), or 0 where it could not tell lines apart."""
    if n_lines * MIN_BITS_PER_LINE > MAX_BITS:
        return 0
    bits = 8 * BLOCK
    while bits < min(n_lines * BITS_PER_LINE, MAX_BITS):
        bits *= 2
    return bits


def twice_filter(docs: DataFrame, text: str, bits: int) -> np.ndarray:
    """The merged filter of keys that at least two documents seem to hold."""
    blocks = (docs.select(text_or_empty(text).alias("t"))
              .mapInArrow(_sketch(bits), "block int, once binary, twice binary")
              .repartition("block").sortWithinPartitions("block")
              .mapInArrow(_merge, "block int, twice binary"))
    bitmap = np.zeros(bits // 8, np.uint8)
    for row in blocks.toLocalIterator():
        bitmap[row["block"] * BLOCK:(row["block"] + 1) * BLOCK] = _unpacked(bytes(row["twice"]))
    return bitmap


def _suspects(filtered):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(filtered.value, np.uint8) if filtered is not None else None
        for b in batches:
            ids, keys = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(),
                            strict=True):
                own = list(document_keys(t))
                if own and bitmap is not None:
                    own = [k for k, hit in zip(own, holds(bitmap, hashes(own)), strict=True) if hit]
                ids += [i] * len(own)
                keys += own
            for k in range(0, len(ids), 20_000):
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids[k:k + 20_000], pa.int64()),
                    "key": pa.array(keys[k:k + 20_000], pa.binary())})
    return run


def dropped_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, keys): the keys whose lines a document loses; documents without any are absent."""
    spark = spark_of(docs)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("t"))
    n = rows.agg((F.count(F.lit(1)) + F.coalesce(F.sum(
        F.octet_length("t") - F.octet_length(F.replace("t", F.lit("\n")))), F.lit(0))).alias("n")
        ).first()["n"]
    bits = filter_bits(int(n))
    filtered = spark.sparkContext.broadcast(twice_filter(rows, "t", bits).tobytes()) if bits else None
    suspects = materialize(rows.filter("doc_id IS NOT NULL")
                           .mapInArrow(_suspects(filtered), "doc_id long, key binary"),
                           "suspected-lines")
    first = materialize(
        suspects.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
                                    F.count(F.lit(1)).alias("holders"))
        .filter("first < last").select("key", "first", "holders"), "repeated-lines")
    return (join_unique(suspects, first, "key", "holders", suspects.count()).filter("doc_id <> first")
            .groupBy("doc_id").agg(F.collect_set("key").alias("keys")))


def _strip(text: pa.Array, keys: pa.Array) -> pa.Array:
    kept, total, gone = [], [], []
    for t, drop in zip(text.cast(pa.binary()).to_pylist(), keys.to_pylist(), strict=True):
        lines = t.split(b"\n")
        left = lines
        if drop:
            drop = set(drop)
            left = [x for x, k in zip(lines, line_keys(t), strict=True) if k not in drop]
        kept.append(b"\n".join(left) if drop else t)
        total.append(len(lines))
        gone.append(len(lines) - len(left))
    return pa.StructArray.from_arrays(
        [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()),
         pa.array(gone, pa.int64())], ["text", "n_lines", "n_dropped"])


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns with the text without its dropped lines, and a struct column
    ``lines`` (text, n_lines, n_dropped) under a free name, which is the last column."""
    bounded_batches(spark_of(docs))
    keys, lines, own = free_name(docs, "keys"), free_name(docs, "lines"), free_name(docs, "own")
    gone = dropped_keys(docs, doc_id, text).select(F.col("doc_id").alias(own),
                                                   F.col("keys").alias(keys))
    # F.arrow_udf takes whole Arrow columns; the other columns stay in the JVM.
    strip = F.arrow_udf(_typed(_strip), "text string, n_lines long, n_dropped long")
    joined = docs.join(gone.hint("shuffle_hash"), F.col(doc_id).cast("long") == F.col(own), "left")
    return joined.withColumn(lines, strip(text_or_empty(text), F.col(keys))).select(
        *[F.col(lines)["text"].alias(c) if c == text else F.col(c) for c in docs.columns], lines)


def _typed(f):
    def strip(text: pa.Array, keys: pa.Array) -> pa.Array:
        return f(text, keys)
    return strip
