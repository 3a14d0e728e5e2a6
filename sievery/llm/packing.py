"""Packing of documents into training sequences (operator 4).

A document is its token ids and an end id.  It is cut into pieces of at most
``LENGTH`` ids.  Pieces are dealt into random groups by a hash of document, start
and a number of their own (so rows that share an id, or lack one, spread like
others), of a size set by the bytes and rows of the whole input; every group is
packed on its own by first-fit decreasing: the pieces in falling order of length
(ties by document and start) each go to the first sequence with room, found in a
tournament tree of the sequences' remaining capacities.  A long document's
pieces spread over many groups, so no group grows with one document.

Defined results: a null or empty text is the end id alone; rows without an id and
repeated rows are packed like any other; other columns are never read; an empty
table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievery.llm import tokens
from sievery.llm.common import bounded_batches, input_bytes, spark_of, text_or_empty

LENGTH = 2048
END_ID = 1
GROUP_ROWS, GROUP_BYTES = 1024, 4 << 20
OUT_BYTES = 8 << 20           # of ids in one Arrow batch

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long"
PACKED = PIECES + ", sequence_id long, offset long"


def _pieces(path: str | None, name: str, end_id: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(tokens.tokenizer_path(path, name))
        end, step = tokens.packed([end_id]), 4 * length
        rows, size = [], 0
        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), encode(b.column(1).to_pylist()), strict=True):
                ids += end
                for at in range(0, len(ids), step):
                    part = ids[at:at + step]
                    rows.append((doc, at // 4, len(part) // 4, part, len(ids) // 4))
                    size += len(part)
                if size > OUT_BYTES:
                    yield _batch(rows)
                    rows, size = [], 0
        if rows:
            yield _batch(rows)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    doc, start, length, ids, total = zip(*rows, strict=True)
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(doc, pa.int64()), "start": pa.array(start, pa.int64()),
        "length": pa.array(length, pa.int64()), "ids": pa.array(ids, pa.binary()),
        "doc_tokens": pa.array(total, pa.int64())})


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
           name: str = tokens.BYTE_BPE, end_id: int = END_ID, length: int = LENGTH) -> DataFrame:
    """Pieces of every document: doc_id, start, length, ids (unsigned 32-bit, little-endian),
    doc_tokens (with the end id)."""
    bounded_batches(spark_of(docs))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("t")
                       ).mapInArrow(_pieces(tokenizer, name, end_id, length), PIECES)


def first_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """(bin, offset) of each item; ``lengths`` must fall.

    The tree's node holds the largest remaining capacity below it; going to the
    left child whenever it has room leads to the first bin that fits.
    """
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    bins, offsets = [], []
    for n in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < n:
                node += 1
        bins.append(node - leaves)
        offsets.append(capacity - tree[node])
        tree[node] -= n
        node //= 2
        while node:
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
            node //= 2
    return bins, offsets


def _pack(length: int):
    def run(key, table):
        order = table.drop_columns(["ids"]).append_column(
            "row", pa.array(np.arange(table.num_rows))).sort_by(
            [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        table = table.take(order.column("row"))
        bins, offsets = first_fit_decreasing(table.column("length").to_pylist(), length)
        first = key[0].as_py() << 32
        return (table.drop_columns(["grp"])
                .append_column("sequence_id", pa.array([first + k for k in bins], pa.int64()))
                .append_column("offset", pa.array(offsets, pa.int64())))
    return run


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
         name: str = tokens.BYTE_BPE, end_id: int = END_ID, length: int = LENGTH) -> DataFrame:
    """The pieces of all documents with the sequence and the offset that each one got."""
    n, size = input_bytes(docs, text)
    groups = max(1, -(-n // GROUP_ROWS), -(-size // GROUP_BYTES))
    cut = pieces(docs, doc_id, text, tokenizer, name, end_id, length)
    own = F.xxhash64("doc_id", "start", F.monotonically_increasing_id())
    return (cut.withColumn("grp", F.pmod(own, F.lit(groups)))
            .groupBy("grp").applyInArrow(_pack(length), PACKED))
