"""Near-duplicate classes from BagMinHash signatures (operator 3).

A document is the multiset of its five-word shingles (words are runs of
``[^\\x20\\x09-\\x0D]``, A-Z lower-cased; a text of one to four words is one
shingle).  Two documents are linked when the weighted Jaccard similarity of
their multisets (sum of minima over sum of maxima) is at least 0.8; a class is
a connected component of links and is named by its smallest doc_id.

BagMinHash (Ertl 2018): the weight axis of a shingle is cut at 1, 2, 4, 8, ...;
every (shingle, interval) has its own Poisson process over all registers, of a
rate proportional to the interval's length.  Each point carries a register and
a place inside its interval, which stands for the halving steps down to the
discretised weight: a point counts in a document if its place lies below the
shingle's weight there.  A register keeps the smallest point, so two registers
are equal with a probability of exactly the weighted Jaccard similarity.  Points
are drawn in ascending order up to a limit that fills all registers; a document
with a register left empty is drawn again with twice the limit.

1. Exact copies meet on a 128-bit digest of their words (partial minimum per
   digest); only the smallest id of each text goes on.
2. 32 bands of 5 registers.  In every bucket each document is paired with the
   bucket's smallest id only (a join that AQE can split), and the pairs are
   verified on their whole texts.
3. Where a bucket still holds several components, its documents are compared
   across components, block by block, on their signatures; pairs whose estimate
   is not hopelessly low (``DOUBT``, six standard errors under 0.8) are verified
   there on their texts, until their components are joined.  So no link between
   components is lost, and what leaves a block is at most one link for each
   component it joins, never its pairs.
4. Connected components by minimum labels with pointer jumping.

At a similarity of 0.8 two documents share no band with a probability of 3e-6.

Defined results: a null or empty text has no shingles and is its own class; a
row without an id has no class (null) and is kept; rows that share an id are one
document; an empty table gives an empty one; other columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievery.llm.common import (
    bounded_batches, free_name, join_unique, materialize, spark_of, text_or_empty,
)

SHINGLE = 5
BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
LEAST = (4, 5)                # similarity 4/5
DOUBT = 0.8 - 6 * (0.8 * 0.2 / REGISTERS) ** 0.5
BLOCK = 512                   # documents of a bucket that are compared at once
BLOCK_BYTES = 16 << 20        # and their text at most, beside one document
BROADCAST_IDS = 2_000_000     # 16 MB of ids: the size bound of the broadcast

_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def times(n: int, k: np.uint64) -> np.uint64:
    """n * k modulo 2**64, without numpy's scalar overflow warning."""
    return np.uint64(n * int(k) & 0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _K2
    x = (x ^ (x >> np.uint64(29))) * _K1
    return x ^ (x >> np.uint64(32))


def unit(x: np.ndarray) -> np.ndarray:
    """Uniform numbers inside (0, 1)."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def split_words(text: bytes) -> list[bytes]:
    return text.lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def fold(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of each row of aligned word hashes, in order."""
    out = parts[0] + np.uint64(len(parts))
    for p in parts[1:]:
        out = (out ^ (out >> np.uint64(31))) * _K1 + p
    return mix(out)


def shingles(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(document index, shingle hash) of every shingle with repeats, in document order."""
    sizes = np.array([len(w) for w in texts], np.int64)
    h = word_hashes([x for w in texts for x in w])
    doc = np.repeat(np.arange(len(texts)), sizes)
    found_d, found_h = [], []
    if len(h) >= SHINGLE:
        n = len(h) - SHINGLE + 1
        whole = doc[:n] == doc[SHINGLE - 1:]
        s = fold([h[i:n + i] for i in range(SHINGLE)])
        found_d.append(doc[:n][whole])
        found_h.append(s[whole])
    starts = np.cumsum(sizes) - sizes
    for size in range(1, SHINGLE):
        short = np.flatnonzero(sizes == size)
        if len(short):
            found_d.append(short)
            found_h.append(fold([h[starts[short] + i] for i in range(size)]))
    if not found_d:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(found_d), np.concatenate(found_h)


def bags(doc: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, shingle) with its count, sorted."""
    order = np.lexsort((s, doc))
    doc, s = doc[order], s[order]
    first = np.ones(len(s), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (s[1:] != s[:-1])
    at = np.flatnonzero(first)
    return doc[at], s[at], np.diff(np.append(at, len(s)))


def draw(doc: np.ndarray, s: np.ndarray, count: np.ndarray, n_docs: int,
         limit: np.ndarray) -> np.ndarray:
    """Registers of every document from the points below ``limit`` of its document."""
    out = np.full(n_docs * REGISTERS, np.inf)
    low, level = 0, 0
    d, x, c = doc, s, count
    while len(d):
        length = max(low, 1)
        seed = mix(x + times(level, _K2))
        a_d, a_seed, a_c, t = d, seed, c, np.zeros(len(d))
        j = 0
        while len(a_d):
            r = mix(a_seed + times(2 * j + 1, _K1))
            t = t - np.log(unit(r)) / (REGISTERS * length)
            live = t < limit[a_d]
            a_d, a_seed, a_c, t = a_d[live], a_seed[live], a_c[live], t[live]
            r = mix(a_seed + times(2 * j + 2, _K1))
            reg = (r % np.uint64(REGISTERS)).astype(np.int64)
            place = a_d * REGISTERS + reg
            if low:
                inside = low + unit(mix(r)) * length < a_c
                np.minimum.at(out, place[inside], t[inside])
            else:
                np.minimum.at(out, place, t)
            j += 1
        low, level = max(2 * low, 1), level + 1
        more = c > low
        d, x, c = d[more], x[more], c[more]
    return out.reshape(n_docs, REGISTERS)


def signatures(doc: np.ndarray, s: np.ndarray, n_docs: int) -> np.ndarray:
    """Registers of every document (infinite for a document without shingles)."""
    d, x, c = bags(doc, s)
    weight = np.bincount(d, c, n_docs)
    limit = (np.log(REGISTERS) + 3) / np.maximum(weight, 1)
    out = draw(d, x, c, n_docs, limit)
    while True:
        again = np.flatnonzero(np.isinf(out).any(axis=1) & (weight > 0))
        if not len(again):
            return out
        limit[again] *= 2
        place = np.full(n_docs, -1)
        place[again] = np.arange(len(again))
        own = place[d] >= 0
        out[again] = draw(place[d[own]], x[own], c[own], len(again), limit[again])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for b in batches:
        ids = b.column(0)
        texts = [split_words(t) for t in b.column(1).cast(pa.binary()).to_pylist()]
        doc, s = shingles(texts)
        sig = signatures(doc, s, len(texts))
        bits = sig.view(np.uint64).reshape(len(texts), BANDS, ROWS)
        bands = fold([bits[:, :, i] for i in range(ROWS)]
                     + [np.broadcast_to(np.arange(BANDS, dtype=np.uint64), bits.shape[:2])])
        small = (mix(sig.view(np.uint64)) >> np.uint64(56)).astype(np.uint8)
        some = [bool(w) for w in texts]
        yield pa.RecordBatch.from_pydict({
            "doc_id": ids,
            "digest": pa.array([xxhash.xxh3_128_digest(b" ".join(w)) if w else None for w in texts],
                               pa.binary()),
            "bands": pa.array([r.view(np.int64) if k else None for r, k in zip(bands, some, strict=True)],
                              pa.list_(pa.int64())),
            "sig": pa.array([r.tobytes() for r in small], pa.binary()),
            "size": b.column(2)})


def sketch(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, bands, sig, size) of rows (doc_id, t); digest and bands are null without
    words, size is the text's bytes."""
    return docs.select("doc_id", "t", F.octet_length("t").cast("long")).mapInArrow(_sketch, "doc_id long, digest binary, bands array<long>, sig binary, size long")


# ------------------------------------------------------------------ verification

def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """Sum of minima and sum of maxima of two bags (sorted shingles, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    return both, int(a[1].sum() + b[1].sum()) - both


def bag(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    _, s = shingles([split_words(text)])
    return np.unique(s, return_counts=True)


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last_id, last = None, None
    for b in batches:
        ok = []
        left, right, text_a, text_b = b.columns
        text_a, text_b = text_a.cast(pa.binary()), text_b.cast(pa.binary())
        for k, other in enumerate(right.to_pylist()):
            if other != last_id:                      # rows of a hot partner follow each other
                last_id, last = other, bag(text_b[k].as_py())
            both, all_ = overlap(bag(text_a[k].as_py()), last)
            ok.append(both * LEAST[1] >= all_ * LEAST[0])
        mask = pa.array(ok, pa.bool_())
        yield pa.RecordBatch.from_arrays([left.filter(mask), right.filter(mask)], ["a", "b"])


def checked_ids(ids: DataFrame) -> DataFrame:
    """Distinct ids for a semi-join, marked for broadcast if they are few (checked)."""
    own = materialize(ids.distinct(), "ids")
    return F.broadcast(own) if own.count() <= BROADCAST_IDS else own


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of ids whose whole texts reach the similarity; ``texts``: (doc_id, t)."""
    ids = checked_ids(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))
    own = texts.join(ids, "doc_id", "left_semi")
    first, second = (own.select(F.col("doc_id").alias(k), F.col("t").alias(f"t{k}")) for k in "ab")
    return (pairs.join(first, "a").join(second, "b").select("a", "b", "ta", "tb")
            .mapInArrow(_similar, "a long, b long"))


# ------------------------------------------------------------------ components

def components(edges: DataFrame) -> DataFrame:
    """(id, label) of every end of ``edges`` (a, b): label is the smallest id it reaches.

    Each round takes the smallest label among the neighbours (partial minimum
    before the shuffle) and then the label's own label, until nothing changes.
    """
    both = materialize(edges.union(edges.select("b", "a")).distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("id"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = (both.join(labels, both.b == labels.id).groupBy("a")
                .agg(F.min("label").alias("near")))
        hooked = labels.join(near, labels.id == near.a).select(
            "id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = hooked.select(F.col("id").alias("to"), F.col("label").alias("next"))
        moved = materialize(hooked.join(jump, F.col("label") == F.col("to"), "left").select(
            "id", "old", F.least("label", "next").alias("label")), "labels")
        labels = moved.select("id", "label")
        if not moved.filter("old <> label").limit(1).count():
            return labels


# ------------------------------------------------------------------ candidates

def _across(key, rows):
    """Links of one bucket's blocks between documents of different components.

    A pair is looked at in the first band that it shares, and only while its ends
    are not connected by links found here; the likeliest partners come first.
    """
    import pandas as pd

    bucket, i, j = key
    sig = np.stack([np.frombuffer(x, np.uint8) for x in rows["sig"]])
    bands = np.stack(rows["bands"].tolist())
    ids, labels, side = (rows[c].to_numpy() for c in ("doc", "label", "block"))
    left, right = np.flatnonzero(side == i), np.flatnonzero(side == j)
    parent: dict[int, int] = {}
    bags_: dict[int, tuple] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    def own(k: int) -> tuple:
        if k not in bags_:
            bags_[k] = bag(rows["t"].iat[k].encode())
        return bags_[k]

    found = []
    for x in left.tolist():
        other = right[(labels[right] != labels[x]) & ((ids[right] > ids[x]) | (i != j))]
        if not len(other):
            continue
        first = (bands[other] == bands[x]).argmax(axis=1)
        alike = (sig[other] == sig[x]).mean(axis=1)
        here = (bands[x][first] == bucket) & (alike >= DOUBT)
        for y in other[here][np.argsort(-alike[here], kind="stable")].tolist():
            a, b = root(int(labels[x])), root(int(labels[y]))
            if a != b:
                both, all_ = overlap(own(x), own(y))
                if both * LEAST[1] >= all_ * LEAST[0]:
                    parent[max(a, b)] = min(a, b)
                    found.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def _blocks(n: str, size: str) -> Column:
    """Blocks that so many rows and bytes need."""
    return F.greatest(F.ceil(F.col(n) / BLOCK), F.ceil(F.col(size) / BLOCK_BYTES)).cast("int")


def open_buckets(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, doc, label, size, parts, own): the documents beside the pivot of buckets that hold
    several components.  ``own``: the component fills blocks of its own, ``parts`` of them; else
    ``parts`` is the number of blocks that the bucket's small components share."""
    named = rows.filter("doc <> pivot").join(labels, rows.doc == labels.id, "left").select(
        "key", "doc", F.coalesce("label", "doc").alias("label"), "size")
    per = named.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    own = (F.col("n") >= BLOCK / 2) | (F.col("bytes") >= BLOCK_BYTES / 2)
    per = per.withColumn("own", own)
    small = [F.sum(F.when(~F.col("own"), F.col(c))).alias(c) for c in ("n", "bytes")]
    some = per.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), *small).filter(
        "x < y").select("key", _blocks("n", "bytes").alias("shared"))
    sized = per.join(some, "key").select("key", "label", "own", F.when(
        F.col("own"), _blocks("n", "bytes")).otherwise(F.col("shared")).alias("parts"))
    return named.join(sized, ["key", "label"])


def block_pairs(held: DataFrame) -> DataFrame:
    """(key, i, j, doc, label, block): every document of ``open_buckets`` in each pair of blocks
    that may hold documents of two components: all pairs but those within one component.  So a
    bucket of one large component and a few others has as many rows as documents."""
    kind = F.when(F.col("own"), F.col("label").cast("string")).otherwise("shared")
    named = held.select("key", "doc", "label", "own", "parts", kind.alias("kind"), F.concat_ws(
        ":", kind, F.pmod(F.xxhash64("doc"), "parts").cast("string")).alias("block"))
    kinds = named.select("key", F.col("kind").alias("with"), F.col("parts").alias("others")).distinct()
    met = named.join(kinds, "key").filter("NOT own OR kind <> with").select(
        "key", "doc", "label", "block", "with", F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("k"))
    other = F.concat_ws(":", "with", F.col("k").cast("string"))
    return met.select("key", F.least("block", other).alias("i"), F.greatest("block", other).alias("j"),
                      "doc", "label", "block")


def cross_component_links(rows: DataFrame, labels: DataFrame, sketched: DataFrame,
                          texts: DataFrame) -> DataFrame:
    """Links (a < b) between band partners that are still in different components.

    ``rows``: (key, doc, pivot, size) of buckets.  A bucket whose documents beside
    the pivot are all in one component is settled: each was compared with the
    pivot.  The others are compared in blocks of bounded rows and bytes, dealt by
    component; only links that join components leave a block.
    """
    held = materialize(open_buckets(rows, labels), "open-buckets")
    ids = checked_ids(held.select(F.col("doc").alias("doc_id")))
    about = (sketched.filter("digest IS NOT NULL").select("doc_id", "bands", "sig")
             .join(ids, "doc_id", "left_semi")
             .join(texts.join(ids, "doc_id", "left_semi"), "doc_id"))
    paired = block_pairs(held).join(about, F.col("doc") == F.col("doc_id")).select(
        "key", "i", "j", "doc", "label", "block", "bands", "sig", "t")
    return paired.groupBy("key", "i", "j").applyInPandas(_across, "a long, b long").distinct()


# ------------------------------------------------------------------ operator

def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, class_id, kept) of every row; kept: the smallest doc_id of its class."""
    bounded_batches(spark_of(docs))
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("t"))
    known = texts.filter("doc_id IS NOT NULL")
    sketched = materialize(sketch(known), "sketch")
    reps = materialize(sketched.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n")), "reps")
    ids = reps.select("rep").distinct()
    banded = (sketched.select("doc_id", "size", F.explode("bands").alias("key"))
              .join(ids, F.col("doc_id") == F.col("rep"), "left_semi")
              .select("key", F.col("doc_id").alias("doc"), "size"))
    buckets = banded.groupBy("key").agg(F.min("doc").alias("pivot"), F.max("doc").alias("last")).filter(
        "pivot < last").select("key", "pivot")
    rows = materialize(banded.join(buckets, "key").select("key", "doc", "pivot", "size"), "buckets")
    star = materialize(rows.filter("doc <> pivot").select(
        F.col("doc").alias("a"), F.col("pivot").alias("b")).distinct(), "star")
    links = materialize(verified(star, known), "links")
    labels = components(links)

    more = materialize(cross_component_links(rows, labels, sketched, known), "links")
    if more.limit(1).count():
        labels = components(links.union(more))

    named = reps.join(labels, reps.rep == labels.id, "left").select(
        "digest", "n", F.coalesce("label", "rep").alias("class"))
    # a digest with many copies is broadcast; documents without words need no class
    worded = join_unique(sketched.filter("digest IS NOT NULL").select("doc_id", "digest"), named, "digest",
                         "n", sketched.count())
    wordless = sketched.filter("digest IS NULL").select("doc_id", F.col("doc_id").alias("class_id"))
    alone = texts.filter("doc_id IS NULL").select(
        "doc_id", F.lit(None).cast("long").alias("class_id"), F.lit(True).alias("kept"))
    return (worded.select("doc_id", F.col("class").alias("class_id")).unionByName(wordless)
            .select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))
            .union(alone))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose document is the smallest of its class, all columns as they were."""
    own = free_name(docs, "gone")
    gone = near_duplicates(docs, doc_id, text).filter("NOT kept").select(
        F.col("doc_id").alias(own)).distinct()
    return docs.join(gone, F.col(doc_id).cast("long") == F.col(own), "left_anti")
