"""Compression of vectors into codes of codebook entries by ball k-means (operator 12).

A vector's components become the integers floor(4096 x); the vector is cut into
``PARTS`` equal parts, and each part position has a codebook of ``ENTRIES`` entries,
first the parts of the vectors with the smallest ids.  A round assigns every part to
its nearest entry and moves every entry to the floored mean of its parts.  All
arithmetic is on integers, so results do not depend on the order of rows.

Ball k-means finds the same nearest entries with less work.  The parts that were
last assigned to an entry are its ball, whose radius is the largest distance from a
member to the entry.  An entry is a neighbour of the ball if it is at most twice the
radius away; no other one can be nearer to a member.  Neighbours sorted by distance
cut the ball into rings: a member at distance d meets only the neighbours within
2 d, one after the other, and a member in the stable core (no neighbour within 2 d)
meets none.  A ball whose entry did not move, and which no moved entry is a
neighbour of, is skipped whole.  Distances are compared as squares, hence exactly:
the neighbours of a member with squared distance s are those with D <= 4 s.

The state is a table of blocks of vectors with their codes, the radius of every ball
and the change of the sums of every entry's parts; a round reads it, writes the next
one to the shared folder and then removes the one before.  Only codebooks, radii and
sums (a few thousand numbers, whatever the table's size) reach the driver.

Defined results: vectors that are null, empty or hold null or non-finite components
take no part; nor do those with a component beyond 2^26 (squares must fit 64 bits)
or of another length than the kept vector with the smallest id whose length
``PARTS`` divides.  Ids order with null last, equal ids by their vectors; with fewer
than 16 kept rows there are as many entries; null labels form one group; repeated
rows are rows like any other; other columns are never read; an empty table gives an
empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievery.llm.common import bounded_batches, join_unique, materialize, spark_of
from sievery.session import scratch_path

PARTS, ENTRIES, ROUNDS = 8, 16, 6
SCALE, MOST = 4096, 1 << 26
BLOCK, BLOCK_BYTES = 4096, 4 << 20    # vectors in a row of the state, and bytes of their integers

# ``own`` is false in blocks whose rows are not assigned yet.
STATE = ("ids array<long>, labels array<string>, ints binary, codes binary, own boolean, "
         "radii array<long>, sums array<long>")
CODES = "vec_id long, label string, code string, error long"


# ------------------------------------------------------------------ rows

def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding",
                    label: str = "label") -> DataFrame:
    """vec_id, label (as text) and v (integers) of the vectors that take part, of any length."""
    whole = F.transform(F.col(embedding), lambda x: F.floor(x.cast("double") * SCALE))
    fits = F.forall(F.col(embedding), lambda x: F.abs(x.cast("double") * SCALE) < MOST)
    kept = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                          F.when(fits & (F.size(embedding) > 0), whole).alias("v"))
    return kept.filter("v IS NOT NULL")


def _blocks(size: int):
    def out(table: pa.Table) -> pa.RecordBatch:
        ints = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return _state(table.column("vec_id").to_pylist(), table.column("label").to_pylist(),
                      ints.astype("<i4"), np.zeros((table.num_rows, PARTS), np.uint8), False, [], [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= size:
                table = pa.Table.from_batches(held)
                for at in range(0, n - n % size, size):
                    yield out(table.slice(at, size))
                held = table.slice(n - n % size).to_batches() if n % size else []
                n %= size
        if n:
            yield out(pa.Table.from_batches(held))
    return run


def _state(ids, labels, ints: np.ndarray, codes: np.ndarray, own: bool, radii, sums) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.string())),
         pa.array([ints.tobytes()], pa.binary()), pa.array([codes.tobytes()], pa.binary()),
         pa.array([own]), pa.array([list(radii)], pa.list_(pa.int64())),
         pa.array([list(sums)], pa.list_(pa.int64()))],
        ["ids", "labels", "ints", "codes", "own", "radii", "sums"])


# ------------------------------------------------------------------ balls

def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distance of every row of ``x`` to the row of ``y`` beside it (or to one row)."""
    d = x - y
    return np.einsum("ij,ij->i", d, d)


def between(book: np.ndarray) -> np.ndarray:
    """Squared distances between all entries of one codebook."""
    return np.stack([distances(book, c) for c in book])


def quiet_balls(book: np.ndarray, before: np.ndarray | None, radius: np.ndarray) -> np.ndarray:
    """Balls whose members keep their entry: it did not move, nor did any neighbour, nor is a
    moved entry a neighbour now.  ``radius``: largest squared distance of a member, -1 if none."""
    if before is None:
        return np.zeros(len(book), bool)
    moved = (book != before).any(axis=1)
    near = between(book) <= 4 * radius[:, None]
    return ~moved & ~(near & moved[None, :]).any(axis=1)


def assign(x: np.ndarray, code: np.ndarray, book: np.ndarray, quiet: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, int]:
    """(nearest entries, squared distances, number of distances computed) of the parts ``x``;
    ``code`` is any entry of each, best the last one.  Members of quiet balls stay; their
    distance is not computed (-1)."""
    new, far, work, apart = code.copy(), np.full(len(x), -1, np.int64), 0, between(book)
    for a in range(len(book)):
        ball = np.flatnonzero(code == a) if not quiet[a] else ()
        if not len(ball):
            continue
        own = distances(x[ball], book[a])
        work += len(ball)
        order = np.lexsort((np.arange(len(book)), apart[a]))
        order = order[order != a]
        near = order[apart[a][order] <= 4 * own.max()]           # neighbours of the ball
        ring = np.searchsorted(apart[a][near], 4 * own, "right")  # of them, those that a member meets
        inner = np.argsort(-ring, kind="stable")
        best, who = own.copy(), np.full(len(ball), a)
        members = np.searchsorted(-ring[inner], -np.arange(1, len(near) + 1), "right")
        for j, n in zip(near.tolist(), members.tolist(), strict=True):
            rows = inner[:n]
            d = distances(x[ball[rows]], book[j])
            work += n
            better = (d < best[rows]) | (d == best[rows]) & (j < who[rows])
            best[rows[better]], who[rows[better]] = d[better], j
        new[ball], far[ball] = who, best
    return new, far, work


def _round(books: np.ndarray, before: np.ndarray | None, radii: np.ndarray, size: int):
    """One pass over the state: new codes, radii under ``books`` and changes of the sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entries = books.shape[1]
        calm = np.stack([quiet_balls(books[p], None if before is None else before[p], radii[p])
                         for p in range(PARTS)])
        for b in batches:
            for row in b.to_pylist():
                n, old = len(row["ids"]), row["own"]
                ints = np.frombuffer(row["ints"], "<i4").reshape(n, PARTS, size)
                codes = np.frombuffer(row["codes"], np.uint8).reshape(n, PARTS)
                quiet = calm if old else np.zeros_like(calm)
                # the entry of a quiet ball has not moved: its members are as far away as they were
                most = np.where(quiet, np.array(row["radii"], np.int64).reshape(PARTS, entries), -1) \
                    if old else np.full((PARTS, entries), -1, np.int64)
                new, change = codes.copy(), np.zeros((PARTS, entries, size + 1), np.int64)
                for p in range(PARTS):
                    if quiet[p][codes[:, p]].all():
                        continue
                    x = ints[:, p].astype(np.int64)
                    new[:, p], far, _ = assign(x, codes[:, p], books[p], quiet[p])
                    np.maximum.at(most[p], new[:, p], far)
                    went = np.flatnonzero(new[:, p] != codes[:, p]) if old else np.arange(n)
                    one = np.hstack([x[went], np.ones((len(went), 1), np.int64)])
                    np.add.at(change[p], new[went, p], one)
                    if old:
                        np.subtract.at(change[p], codes[went, p], one)
                yield _state(row["ids"], row["labels"], ints, new, True, most.ravel().tolist(),
                             change.ravel().tolist())
    return run


def _total(state: DataFrame, column: str, how, length: int) -> np.ndarray:
    """One array column aggregated place by place over all blocks; ``length`` rows reach the driver."""
    out = np.zeros(length, np.int64)
    for place, value in state.select(F.posexplode(column).alias("k", "x")).groupBy("k").agg(how("x")).collect():
        out[place] = value
    return out


def _stored(df: DataFrame, before: str | None = None) -> tuple[DataFrame, str]:
    """The state written to the shared folder, and its path; then the folder of the state that it
    replaces goes."""
    spark = spark_of(df)
    path = scratch_path(spark, "vector-blocks")
    df.write.parquet(path)
    if before:
        folder = spark._jvm.org.apache.hadoop.fs.Path(before)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return spark.read.schema(STATE).parquet(path), path


def floored_means(sums: np.ndarray, books: np.ndarray) -> np.ndarray:
    """Entries at the floored mean of their parts; unused ones stay."""
    count = sums[:, :, -1:]
    return np.where(count > 0, sums[:, :, :-1] // np.maximum(count, 1), books)


# ------------------------------------------------------------------ operator

def _codes(books: np.ndarray, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                n = len(row["ids"])
                ints = np.frombuffer(row["ints"], "<i4").reshape(n, PARTS, size)
                codes = np.frombuffer(row["codes"], np.uint8).reshape(n, PARTS)
                error = sum(distances(ints[:, p].astype(np.int64), books[p][codes[:, p]]) for p in range(PARTS))
                text = codes.tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], pa.int64()), pa.array(row["labels"], pa.string()),
                     pa.array([text[k:k + 2 * PARTS] for k in range(0, len(text), 2 * PARTS)]),
                     pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])
    return run


def first_codebooks(rows: DataFrame) -> np.ndarray | None:
    """(part, entry, position) from the kept rows with the smallest ids; None without any."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    first = rows.filter(F.size("v") % PARTS == 0).orderBy(*order).limit(1).select(F.size("v")).collect()
    if not first:
        return None
    n = first[0][0]
    found = rows.filter(F.size("v") == n).orderBy(*order).limit(ENTRIES).select("v").collect()
    return np.array([r["v"] for r in found], np.int64).reshape(len(found), PARTS, n // PARTS).transpose(1, 0, 2)


def fit(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
        rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label as text, code, error of every vector; codebooks by part, entry, position)."""
    spark = spark_of(vectors)
    bounded_batches(spark, rows=BLOCK)
    rows = integer_vectors(vectors, vec_id, embedding, label)
    books = first_codebooks(rows)
    if books is None:
        return spark.createDataFrame([], CODES), np.zeros((PARTS, 0, 0), np.int64)
    entries, size = books.shape[1:]
    before, radii = None, np.zeros((PARTS, entries), np.int64)
    sums = np.zeros((PARTS, entries, size + 1), np.int64)
    block = max(1, min(BLOCK, BLOCK_BYTES // (4 * PARTS * size)))
    state, path = _stored(rows.filter(F.size("v") == PARTS * size).mapInArrow(_blocks(block), STATE))
    for step in range(rounds + 1):
        state, path = _stored(state.mapInArrow(_round(books, before, radii, size), STATE), path)
        if step < rounds:
            radii = _total(state, "radii", F.max, PARTS * entries).reshape(radii.shape)
            sums += _total(state, "sums", F.sum, sums.size).reshape(sums.shape)
            before, books = books, floored_means(sums, books)
    return state.mapInArrow(_codes(books, size), CODES), books


def listed(books: np.ndarray) -> str:
    """All components of all codebooks, in order."""
    return ",".join(map(str, books.ravel().tolist()))


def compress(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
             ) -> DataFrame:
    """vec_id, code, error, label_error (sum over the rows with its label) and codebooks_sha256 of
    every vector."""
    coded, books = fit(vectors, vec_id, embedding, label)
    coded = materialize(coded.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("label")), F.lit("null"))),
                        "vector-codes")
    per = materialize(coded.groupBy("key").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")),
                      "label-errors")
    digest = hashlib.sha256(listed(books).encode()).hexdigest()
    # a hot label is broadcast, so its rows are not shuffled to one task
    return join_unique(coded, per, "key", "n", coded.count()).select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
