"""Secret scans (operator 8).

Three base kinds are found by pattern (``assign``, ``access``, ``hex``).  The
method adds ``entropy`` spans: candidate strings are runs of token characters;
for each character class a window slides over the stretch of the candidate that
the class covers, with Shannon entropy kept by incremental counts (one character
enters, one leaves, two terms of the sum change).  Windows at or above the
class's limit are merged into spans.  The allow list suppresses candidates that
are known not to be secrets: words without a digit or without a letter, paths
and addresses, dates, UUIDs and marked examples.  It never suppresses a base span.

Offsets are code points, the end exclusive.  Defined results: a null or empty
text has no spans; rows are scanned one by one, so repeated rows, ties and rows
without an id get equal results; other columns are kept as they are (``redact``)
or never read (``find``); an empty table gives an empty one.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievery.llm.common import bounded_batches, free_name, spark_of, text_or_empty

# The base patterns.  A run that is long enough as a whole is found
# by its least length at once; an assignment is judged by its value, after matching.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_VALUE = 12
KINDS = ("assign", "access", "hex", "entropy")
WORDS = re.compile("password|passwd|secret|token|api_?key", re.IGNORECASE | re.ASCII)

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
# Class: its characters, the window and the least entropy in bits per character.
CLASSES = {
    "hex": (re.compile(r"[0-9A-Fa-f]{20,}"), 20, 3.0),
    "upper": (re.compile(r"[A-Z0-9]{20,}"), 20, 3.5),
    "base64": (re.compile(r"[A-Za-z0-9+/_=-]{20,}"), 20, 3.75),
}
ALLOWED = [
    re.compile(r"[^0-9]*|[^A-Za-z]*"),                                     # no digit or no letter
    re.compile(r"(?i).*(example|sample|dummy|placeholder|xxxx|0000000|1234567).*"),
    re.compile(r"(?i)[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}"),          # UUID
    re.compile(r"([A-Za-z]+[0-9]{0,4}[/_=-]+)*[A-Za-z]*[0-9]{0,4}"),       # path of words
]
MASK = "[SECRET]"


def windows(text: str, size: int, least: float) -> list[tuple[int, int]]:
    """Merged windows of ``size`` characters whose Shannon entropy is at least ``least``.

    With counts c of a window of n characters the entropy is log2 n less the sum
    of c log2 c over n; sliding by one changes two counts.
    """
    if len(text) < size:
        return []
    terms = [0.0] + [c * math.log2(c) for c in range(1, size + 1)]
    most = size * (math.log2(size) - least) + 1e-9
    counts: dict[str, int] = {}
    total = 0.0
    found: list[tuple[int, int]] = []
    for i, ch in enumerate(text):
        c = counts.get(ch, 0)
        counts[ch] = c + 1
        total += terms[c + 1] - terms[c]
        if i >= size:
            old = text[i - size]
            c = counts[old]
            counts[old] = c - 1
            total += terms[c - 1] - terms[c]
        if i >= size - 1 and total <= most:
            start = i - size + 1
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], i + 1)
            else:
                found.append((start, i + 1))
    return found


def entropy_spans(text: str) -> list[tuple[int, int]]:
    spans: list[tuple[int, int]] = []
    for m in CANDIDATE.finditer(text):
        word = m[0]
        if any(a.fullmatch(word) for a in ALLOWED):
            continue
        for run, size, least in CLASSES.values():
            for r in run.finditer(word):
                if any(a.fullmatch(r[0]) for a in ALLOWED):
                    continue
                spans += [(m.start() + r.start() + a, m.start() + r.start() + b)
                          for a, b in windows(r[0], size, least)]
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans by start, then kind as listed."""
    out = []
    if WORDS.search(text):
        out += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text)
                if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def scan(text: str) -> list[tuple[str, int, int]]:
    """All spans by start, then kind as listed."""
    return sorted(base_spans(text) + [("entropy", a, b) for a, b in entropy_spans(text)],
                  key=lambda s: (s[1], KINDS.index(s[0])))


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span, overlapping ones as one, replaced by ``MASK``."""
    out, at = [], 0
    for _, a, b in spans:
        if a >= at:
            out += [text[at:a], MASK]
        at = max(at, b)
    return "".join([*out, text[at:]])


SPANS = "array<struct<kind:string,start:long,end:long>>"


def _find():
    def find(text: pa.Array) -> pa.Array:
        return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in scan(t)]
                         for t in text.to_pylist()],
                        pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()),
                                            ("end", pa.int64())])))
    return find


def _redact():
    def redact(text: pa.Array) -> pa.Array:
        return pa.array([masked(t, s) if (s := scan(t)) else t for t in text.to_pylist()], pa.string())
    return redact


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, spans) of every row; spans: kind, start, end by start, then kind."""
    bounded_batches(spark_of(docs))
    spans = F.arrow_udf(_find(), SPANS)
    return docs.select(F.col(doc_id).alias("doc_id"), spans(text_or_empty(text)).alias("spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns, with the secrets in the text replaced by ``MASK`` (null stays null)."""
    bounded_batches(spark_of(docs))
    own = free_name(docs, "redacted")
    clean = F.when(F.col(text).isNotNull(), F.arrow_udf(_redact(), "string")(text_or_empty(text)))
    return docs.withColumn(own, clean).select(
        *[F.col(own).alias(c) if c == text else F.col(c) for c in docs.columns])
