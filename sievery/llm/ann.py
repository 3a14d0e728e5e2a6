"""Approximate nearest neighbours by multiprobe p-stable hashing (operator 7).

Every table hashes a vector to ``floor((a . x + b) / w)`` for ``HASHES`` Gaussian
directions a.  A query visits, in every table, the ``PROBES`` buckets whose codes
differ by -1, 0 or +1 per hash and that are most likely to hold a near vector:
the squared distances from the query to the crossed bucket walls, summed, give
the order.  The candidates of a table's buckets are ranked by exact distance, and
the best of all tables and parts are merged.

The bucket widths come from the distances to the ``K``-th neighbour within a bounded
sample of ``SAMPLE`` distinct vectors, drawn by hash over all rows: distances within
a factor of two make one scale, and each scale has tables of its own, with a multiple
of its median distance as width, so a group of near copies does not set the width of
the others.  Every vector is indexed in the tables of every scale.

A query is done when it has ``k`` results and its probes would have met a vector as
far as the last of them with probability ``SURE`` at least (known from its places and
the normal law of the projections).  Queries start in the tables of the smallest
scale; those not done go on to the next, and after the last one they are compared
with all rows, in blocks of at most ``BLOCK_BYTES``.  So sparse queries and outliers
get all their neighbours, and queries with fewer than ``k`` candidates all of those.

Buckets are dealt
out by region (the first hashes of the code, as many as the row count asks
for); a region with more than ``PART`` vectors is split by vector id and one with more
than ``QUERY_PART`` probing queries by query id, and every part of the one meets every
part of the other, so neither a frequent vector nor a frequent region can fill one
task.  Only the ``k`` best of each part leave it; regions without queries are not sent.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part, neither do rows without an id; vectors of another
dimension than the query's are no candidates; of rows that share an id the
nearest counts, and a query never finds its own id; ties go to the smaller id;
fewer candidates than ``k`` give fewer rows; other columns are never read; an
empty table gives an empty one.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievery.llm.common import bounded_batches, materialize, spark_of
from sievery.session import scratch_path

K = 10
TABLES, HASHES, PROBES = 6, 6, 150
WIDTH = 1.45                  # bucket width over a scale's K-th neighbour distance
SAMPLE = 2000
SCALES, SCALE_SHARE = 4, 0.02  # tables at most; share of the sample that makes a scale
PART, QUERY_PART = 8192, 4096  # vectors, and queries, of a region that meet at once
SURE = 0.9                    # chance to meet the k-th neighbour at which a query is done
BLOCK_BYTES = 4 << 20         # of queries that are compared with all rows at once
SEED = 20240501


# ------------------------------------------------------------------ hashing

def directions(table: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Gaussian directions and offsets (in widths) of one table."""
    rng = np.random.default_rng([SEED, table, dim])
    return rng.standard_normal((dim, HASHES)), rng.uniform(0, 1, HASHES)


def places(x: np.ndarray, table: int, width: float) -> np.ndarray:
    """Place of each vector on each hash's axis, in bucket widths."""
    a, b = directions(table, x.shape[1])
    return np.einsum("ij,jk->ik", x, a) / width + b


def code(buckets: np.ndarray) -> np.ndarray:
    """One number for each row of bucket indexes."""
    out = np.zeros(buckets.shape[:-1], np.uint64)
    for i in range(buckets.shape[-1]):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + (
            buckets[..., i].astype(np.int64).view(np.uint64))
    return out.view(np.int64)


STEPS = np.array(list(itertools.product((0, -1, 1), repeat=HASHES)), np.int8)


def probed(place: np.ndarray) -> np.ndarray:
    """Bucket indexes that each query visits, in estimated order of success."""
    return np.floor(place)[:, None, :].astype(np.int64) + STEPS[chosen(place)]


def chosen(place: np.ndarray) -> np.ndarray:
    """Which of ``STEPS`` each query visits, in estimated order of success."""
    base = np.floor(place)
    low = (place - base) ** 2                         # to the wall below, in widths
    high = (1 - (place - base)) ** 2
    score = low @ (STEPS == -1).T + high @ (STEPS == 1).T
    n = min(PROBES, len(STEPS))
    return np.argsort(score, axis=1, kind="stable")[:, :n]


NORMAL = np.vectorize(lambda z: 0.5 * (1 + math.erf(z / math.sqrt(2))), otypes=[float])


def chance(x: np.ndarray, far: np.ndarray, width: float) -> np.ndarray:
    """Probability that the probes of each query meet a vector at its distance ``far``:
    a projection of their difference is normal with that deviation."""
    missed = np.ones(len(x))
    spread = np.maximum(far / width, 1e-12)[:, None, None]
    for t in range(TABLES):
        place = places(x, t, width)
        walls = np.arange(-1, 3) - (place - np.floor(place))[:, :, None]
        inside = np.diff(NORMAL(walls / spread), axis=2)          # per hash: one below, own, above
        steps = STEPS[chosen(place)].astype(np.int64) + 1
        met = np.ones(steps.shape[:2])
        for i in range(HASHES):
            met *= np.take_along_axis(inside[:, i], steps[:, :, i], axis=1)
        missed *= 1 - np.minimum(met.sum(axis=1), 1)
    return 1 - missed


def as_matrix(vectors: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), np.float64).reshape(len(vectors), -1)


def _by_dim(b: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[bytes]]]:
    ids, vectors = b.column(0).to_numpy(), b.column(1).to_pylist()
    dims = np.array([len(v) // 8 for v in vectors])
    for dim in np.unique(dims).tolist():
        own = np.flatnonzero(dims == dim)
        part = [vectors[i] for i in own]
        yield dim, ids[own], as_matrix(part), part


def _index(width: float, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, ids, x, raw in _by_dim(b):
                for t in range(TABLES):
                    cell = np.floor(places(x, t, width)).astype(np.int64)
                    yield pa.RecordBatch.from_pydict({
                        "dim": pa.array([dim] * len(ids), pa.int32()),
                        "tab": pa.array([t] * len(ids), pa.int32()),
                        "region": pa.array(code(cell[:, :depth])), "id": pa.array(ids),
                        "code": pa.array(code(cell)), "vec": pa.array(raw, pa.binary())})
    return run


def _probe(width: float, depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for dim, ids, x, raw in _by_dim(b):
                for t in range(TABLES):
                    cells = probed(places(x, t, width))
                    region, codes = code(cells[:, :, :depth]), code(cells)
                    rows = [(r, int(i), codes[q][region[q] == r], raw[q])
                            for q, i in enumerate(ids) for r in np.unique(region[q]).tolist()]
                    if rows:
                        regions, own, found, vec = zip(*rows, strict=True)
                        yield pa.RecordBatch.from_pydict({
                            "dim": pa.array([dim] * len(rows), pa.int32()),
                            "tab": pa.array([t] * len(rows), pa.int32()),
                            "region": pa.array(regions, pa.int64()), "id": pa.array(own, pa.int64()),
                            "codes": pa.array(found, pa.list_(pa.int64())),
                            "vec": pa.array(vec, pa.binary())})
    return run


# ------------------------------------------------------------------ ranking

def nearest(q: np.ndarray, own: int, x: np.ndarray, ids: np.ndarray, rough: np.ndarray,
            k: int) -> list[tuple[int, float]]:
    """The k nearest of the rows, exactly; ``rough`` squared distances save exact ones of
    rows that are clearly too far."""
    near = np.flatnonzero(ids != own)
    if len(near) > k:
        most = np.partition(rough[near], k - 1)[k - 1]
        near = near[rough[near] <= most + 1e-9 * (1 + abs(most))]
    exact = np.sqrt(((x[near] - q) ** 2).sum(axis=1))
    order = np.lexsort((ids[near], exact))
    out, seen = [], set()
    for i in order.tolist():
        if ids[near[i]] not in seen:
            seen.add(ids[near[i]])
            out.append((int(ids[near[i]]), float(exact[i])))
        if len(out) == k:
            break
    if len(out) < k and len(near) < int((ids != own).sum()):     # ids that occur in several rows
        return nearest(q, own, x, ids, np.zeros(len(ids)), k)
    return out


def _rank(k: int):
    def run(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(vectors) and len(queries):
            vectors = vectors.sort_values("code")
            codes, ids, x = (vectors["code"].to_numpy(), vectors["id"].to_numpy(),
                             as_matrix(vectors["vec"].tolist()))
            square = (x ** 2).sum(axis=1)
            for at in range(0, len(queries), 64):
                part = queries.iloc[at:at + 64]
                q = as_matrix(part["vec"].tolist())
                rough = square - 2 * (q @ x.T) + (q ** 2).sum(axis=1)[:, None]
                for i, (own, visited) in enumerate(zip(part["id"], part["codes"], strict=True)):
                    low = np.searchsorted(codes, visited, "left")
                    high = np.searchsorted(codes, visited, "right")
                    rows = [np.arange(a, z) for a, z in zip(low, high, strict=True) if z > a]
                    if rows:
                        rows = np.concatenate(rows)
                        out += [(own, v, s) for v, s in nearest(
                            q[i], own, x[rows], ids[rows], rough[i, rows], k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})
    return run


def _open(width: float, k: int):
    """Of queries with their results' count and largest distance: those that are not done."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, far = b.column(2).to_numpy(), b.column(3).to_numpy()
            vectors = b.column(1).to_pylist()
            rest = n < k
            dims = np.array([len(v) for v in vectors])
            for dim in np.unique(dims[~rest]).tolist():
                own = np.flatnonzero(~rest & (dims == dim))
                rest[own] = chance(as_matrix([vectors[i] for i in own]), far[own], width) < SURE
            yield pa.RecordBatch.from_pydict({
                "id": b.column(0).filter(pa.array(rest)), "vec": b.column(1).filter(pa.array(rest))})
    return run


def _scan(queries: list[tuple[int, bytes]], k: int):
    """The k nearest rows of each query among the rows of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = {}
        for dim in {len(v) // 8 for _, v in queries}:
            own = [(i, v) for i, v in queries if len(v) == 8 * dim]
            asked[dim] = [i for i, _ in own], as_matrix([v for _, v in own])
        best: dict[tuple[int, int], list[tuple[float, int]]] = {}
        for b in batches:
            for dim, ids, x, _ in _by_dim(b):
                if dim not in asked:
                    continue
                owns, q = asked[dim]
                square = (x ** 2).sum(axis=1)
                for at in range(0, len(q), 512):
                    part = q[at:at + 512]
                    size = (part ** 2).sum(axis=1)
                    rough = square - 2 * (part @ x.T) + size[:, None]
                    slack = 1e-9 * (1 + size + square.max())
                    for i, least in enumerate(rough.min(axis=1).tolist()):
                        now = best.get((dim, at + i), [])
                        if len(now) == k and least > now[-1][0] ** 2 + slack[i]:
                            continue
                        merged: dict[int, float] = {v: s for s, v in now}
                        for v, s in nearest(part[i], owns[at + i], x, ids, rough[i], k):
                            merged[v] = min(s, merged.get(v, s))
                        best[dim, at + i] = sorted((s, v) for v, s in merged.items())[:k]
        rows = [(asked[dim][0][i], v, s) for (dim, i), found in best.items() for s, v in found]
        for at in range(0, len(rows), 10_000):
            own, found, score = zip(*rows[at:at + 10_000], strict=True)
            yield pa.RecordBatch.from_pydict({
                "query_id": pa.array(own, pa.int64()), "vec_id": pa.array(found, pa.int64()),
                "score": pa.array(score, pa.float64())})
    return run


# ------------------------------------------------------------------ operator

def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    def odd(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return (vector.isNotNull() & ~F.exists(vector, odd)
            & F.exists(vector, lambda x: F.coalesce(x, F.lit(0.0)) != 0))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        lists = b.column(1)
        flat, at = lists.flatten().to_numpy(zero_copy_only=False), np.concatenate(
            [[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(int)
        raw = flat.astype(np.float64).tobytes()
        yield pa.RecordBatch.from_pydict({
            "id": b.column(0), "vec": pa.array([raw[8 * a:8 * z] for a, z in itertools.pairwise(at)],
                                               pa.binary())})


def neighbour_distances(sample: list[bytes], k: int = K) -> np.ndarray:
    """Distance of every sampled vector to its k-th neighbour in the sample."""
    dims, out = np.array([len(v) for v in sample]), [np.zeros(0)]
    for dim in np.unique(dims).tolist():
        x = as_matrix([v for v in sample if len(v) == dim])
        if len(x) > 1:
            square, last = (x ** 2).sum(axis=1), min(k, len(x) - 1)
            for at in range(0, len(x), 100):          # rough distances choose, exact ones count
                part = x[at:at + 100]
                near = np.argpartition(square - 2 * part @ x.T, last, axis=1)[:, :last + 1]
                out.append(np.sqrt(((x[near] - part[:, None]) ** 2).sum(axis=2)).max(axis=1))
    return np.concatenate(out)


def bucket_widths(far: np.ndarray) -> list[float]:
    """``WIDTH`` times the median of each scale of the neighbour distances, ascending.

    A scale with few of them joins the next larger one, whose wider buckets miss no more.
    """
    scales: list[list[float]] = []
    for v in np.sort(far[far > 0]).tolist():
        if scales and v < 2 * scales[-1][0]:
            scales[-1].append(v)
        else:
            scales.append([v])
    most = max(map(len, scales), default=0)
    scales = [s for s in scales if len(s) >= min(most, SCALE_SHARE * len(far))]
    while len(scales) > SCALES:
        del scales[int(np.argmin([len(s) for s in scales[:-1]]))]
    return [WIDTH * float(np.median(s)) for s in scales] or [1.0]


def _sample(base: DataFrame, n: int) -> list[bytes]:
    """At most ``SAMPLE`` distinct vectors, the first by hash; copies count as one."""
    hashed = base.select("vec", F.xxhash64("vec").alias("h"))
    share = max(1, n // (4 * SAMPLE))
    for m in dict.fromkeys((share, 1)):               # all rows, if copies leave too few
        got = (hashed.filter(F.pmod("h", F.lit(m)) == 0).dropDuplicates(["h"])
               .orderBy(F.xxhash64("h"), "h").limit(SAMPLE).collect())
        if len(got) >= SAMPLE // 4:
            break
    return [bytes(r["vec"]) for r in got]


def _found(base: DataFrame, asked: DataFrame, width: float, depth: int, k: int) -> DataFrame:
    """query_id, vec_id and score of what the tables of one width give; k best of each part."""
    keys = ["dim", "tab", "region"]
    index = base.mapInArrow(_index(width, depth),
                            "dim int, tab int, region long, id long, code long, vec binary")
    probes = materialize(asked.mapInArrow(
        _probe(width, depth), "dim int, tab int, region long, id long, codes array<long>, vec binary"), "probes")
    # two-step counts: partial counts per task meet per region; regions without queries go no further
    rows, queries = (df.groupBy(*keys).count().select(*keys, F.ceil(F.col("count") / most).cast("int").alias(name))
                     for df, most, name in ((index, PART, "parts"), (probes, QUERY_PART, "query_parts")))
    parts = materialize(rows.join(queries, keys), "regions")
    held = index.join(parts, keys).withColumn(
        "part", F.expr("cast(pmod(xxhash64(id), parts) as int)")).withColumn(
        "query_part", F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1))).drop("parts", "query_parts")
    sent = probes.join(parts, keys).withColumn(
        "query_part", F.expr("cast(pmod(xxhash64(id), query_parts) as int)")).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "query_parts")
    keys = [*keys, "part", "query_part"]
    return (held.groupBy(*keys).cogroup(sent.groupBy(*keys))
            .applyInPandas(_rank(k), "query_id long, vec_id long, score double"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def search(vectors: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score (Euclidean distance) of the ``k`` nearest
    candidates found for every row that ``is_query`` (over the columns of ``vectors``)."""
    bounded_batches(spark_of(vectors))
    some = vectors.filter(F.col(vec_id).isNotNull() & usable(F.col(vector)))
    rows = some.select(F.col(vec_id).cast("long").alias("id"),
                       F.col(vector).cast("array<double>").alias("v"), is_query.alias("is_query"))
    packed = "id long, vec binary"
    base = rows.select("id", "v").mapInArrow(_packed, packed)
    asked = rows.filter("is_query").select("id", "v").mapInArrow(_packed, packed)
    n = rows.count()
    depth = min(HASHES, max(1, math.ceil(math.log(max(n / PART, 1), 3))))
    widths = bucket_widths(neighbour_distances(_sample(base, n), k))
    parts, left = [], asked
    for width in widths:
        parts.append(materialize(_ranked(_found(base, left, width, depth, k), k), "nearest"))
        reached = functools.reduce(DataFrame.unionByName, parts)
        last = _ranked(reached, k).groupBy("query_id").agg(
            F.count(F.lit(1)).alias("n"), F.max("score").alias("far"))
        left = materialize(
            left.join(last, left["id"] == last["query_id"], "left")
            .select("id", "vec", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("far", F.lit(0.0)).alias("far"))
            .mapInArrow(_open(width, k), packed), "open")
    block: list[tuple[int, bytes]] = []
    size, scanned = 0, None
    for r in itertools.chain(left.dropDuplicates().toLocalIterator(), [None]):
        if block and (r is None or size + len(r["vec"]) > BLOCK_BYTES):
            found = _ranked(base.mapInArrow(_scan(block, k), "query_id long, vec_id long, score double"), k)
            scanned = scanned or scratch_path(spark_of(vectors), "scanned")
            found.write.mode("append").parquet(scanned)
            block, size = [], 0
        if r is not None:
            block.append((r["id"], bytes(r["vec"])))
            size += len(r["vec"])
    if scanned:
        parts.append(spark_of(vectors).read.schema(parts[0].schema).parquet(scanned))
    return _ranked(functools.reduce(DataFrame.unionByName, parts), k)
