"""SentencePiece encoding with source spans, and decoding (operator 10).

Ids are exactly the library's.  Every piece is projected to the bytes of the
original text it stands for: normalisation goes through the model's compiled
character map by longest prefix and records, for every byte it writes, where in
the source that byte came from; the pieces' lengths in the normalised text then
give each piece's span.  The map is a double-array trie whose leaves point to
the replacement strings.  A model without a map and without white-space removal
(identity) needs no walk: only the written prefix and the escaped spaces differ
from the source.

Spans of a document are in order, touch or overlap only where one source
character became several pieces, and end at the text's last byte unless
trailing spaces were removed.

Defined results: a null or empty text has no ids and decodes to the empty text;
rows without an id and repeated rows are encoded like any other; other columns
are never read; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievery.llm import tokens
from sievery.llm.common import bounded_batches, spark_of, text_or_empty

SPACE = "▁".encode()
SCHEMA = "doc_id long, ids array<int>, starts array<int>, ends array<int>, decoded string"


class CharMap:
    """Longest-prefix replacement through a compiled character map.

    Fixed values: the layout of a unit of the trie (label, leaf flag, offset).
    """

    def __init__(self, data: bytes) -> None:
        size = int.from_bytes(data[:4], "little")
        self.units = np.frombuffer(data[4:4 + size], "<u4").tolist()
        self.strings = data[4 + size:]

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes read, replacement) of the longest key that starts at ``at``."""
        units, node, found = self.units, 0, None
        node ^= self._offset(units[0])
        for i in range(at, len(text)):
            byte = text[i]
            node ^= byte
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                found = i + 1 - at, units[node] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.strings[start:self.strings.index(b"\0", start)]


def _char_bytes(first: int) -> int:
    return 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


def normalized(text: bytes, charmap: CharMap | None, dummy_prefix: bool, remove_extra: bool,
               escape: bool) -> tuple[bytes, list[int]]:
    """The normalised text and the source offset of each of its bytes, with the end's last."""
    out, source = bytearray(), []

    def write(data: bytes, at: int) -> None:
        out.extend(data)
        source.extend([at] * len(data))

    parts: list[tuple[bytes, int, int]] = []          # replacement, from, to
    at = 0
    while at < len(text):
        hit = charmap.longest(text, at) if charmap else None
        size, data = hit if hit else (_char_bytes(text[at]), text[at:at + _char_bytes(text[at])])
        parts.append((data, at, at + size))
        at += size
    end = len(text)
    if remove_extra:
        while parts and parts[0][0] == b" ":
            parts.pop(0)
    if not parts:
        return b"", [0 if not remove_extra else end]
    space = SPACE if escape else b" "
    start = parts[0][1]
    if dummy_prefix:
        write(space, start)
    after_space = remove_extra
    for data, at, _ in parts:
        if after_space:
            data = data.lstrip(b" ")
        if not data:
            continue
        for k, byte in enumerate(data):
            if byte == 0x20:
                write(space, at)
            else:
                # a character copied as it stands keeps byte positions
                write(data[k:k + 1], at + k if data == text[at:at + len(data)] else at)
        after_space = remove_extra and data.endswith(b" ")
    if remove_extra:
        while out.endswith(space):
            end = source[-1]
            del out[-len(space):], source[-len(space):]
    return bytes(out), [*source, end]


class Aligner:
    """Source spans of the ids of a text."""

    def __init__(self, model: tokens.PieceModel) -> None:
        self.model = model
        self.identity = not model.charsmap and not model.remove_extra
        self.charmap = CharMap(model.charsmap) if model.charsmap else None
        kinds = np.array(model.kinds)
        self.unknown = set(np.flatnonzero(kinds == model.UNKNOWN).tolist())
        one = kinds == model.BYTE
        self.written = np.array([len(p) for p in model.pieces])     # bytes in the normalised text
        self.read = np.array([len(p.replace(SPACE, b" ")) for p in model.pieces])
        self.written[one] = self.read[one] = 1

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends in bytes of the UTF-8 text."""
        if not len(ids):
            return np.empty(0, np.int32), np.empty(0, np.int32)
        odd = self.unknown.intersection(ids.tolist()) if self.unknown else ()
        if self.identity and not odd and "▁" not in text:
            ends = np.cumsum(self.read[ids]) - int(self.model.dummy_prefix)
            ends = np.maximum(ends, 0)
            return (np.concatenate([[0], ends[:-1]]).astype(np.int32), ends.astype(np.int32))
        size = self.written[ids]
        if odd:                                       # an unknown piece stands for its own text
            own = self.model.processor.encode(text, out_type=str)
            size = np.array([len(p.encode()) if i in self.unknown else n
                             for i, p, n in zip(ids.tolist(), own, size.tolist(), strict=True)])
        _, source = normalized(text.encode(), self.charmap, self.model.dummy_prefix,
                               self.model.remove_extra, self.model.escape)
        at = np.minimum(np.concatenate([[0], np.cumsum(size)]), len(source) - 1)
        source = np.array(source)
        starts, ends = source[at[:-1]], source[at[1:]]
        return starts.astype(np.int32), np.maximum(starts, ends).astype(np.int32)


def _encode(path: str | None, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, units = tokens.piece_model(tokens.tokenizer_path(path, name))
        aligner = Aligner(model)
        for b in batches:
            texts = b.column(1).to_pylist()
            ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in units(texts)]
            spans = [aligner.spans(t, i) for t, i in zip(texts, ids, strict=True)]
            decoded = [model.processor.decode(i.tolist()) for i in ids]
            at = pa.array(np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32))

            def column(parts: list[np.ndarray], at: pa.Array = at) -> pa.Array:
                return pa.ListArray.from_arrays(at, pa.array(np.concatenate(parts), pa.int32()))
            if texts:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), column(ids), column([s for s, _ in spans]),
                     column([e for _, e in spans]), pa.array(decoded, pa.string())],
                    ["doc_id", "ids", "starts", "ends", "decoded"])
    return run


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str | None = None,
           name: str = tokens.PIECES) -> DataFrame:
    """doc_id, ids, starts and ends (bytes of the original text, end exclusive) of every piece,
    and the library's decoding of the ids."""
    bounded_batches(spark_of(docs))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("t")
                       ).mapInArrow(_encode(model, name), SCHEMA)
