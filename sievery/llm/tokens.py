"""Token ids of whole texts, exactly as the tokenizer library gives them.

Byte-pair merges never cross the borders that a tokenizer's own splitting sets,
so a text is cut at borders that hold in any context and the ids of each unit
are kept in a bounded per-process cache:

* byte-level BPE with the usual splitting pattern: an optional space with a run
  of non-space, the white space before it, or single white space;
* word BPE: runs between ASCII white space, which the tokenizer drops;
* sentence pieces: spaces with the run that follows them, or a line feed (only
  where no piece of the vocabulary reaches across such a border).

Texts of printable ASCII, Latin letters and plain white space, which every Unicode
version classes and composes alike, need no units: the whole text goes through a
second merge engine built from the tokenizer file's own vocabulary and merges
(``MergeEngine``; same ids, several times as fast).  Where words are merged on their own
(word BPE), the plain texts of a batch are cut together and a word that repeats is merged once.  Of other texts the missing units of a
batch are encoded together, such units by that engine and others by the library.
Where a tokenizer is of another kind or a text holds characters that Python and the
library class differently, the whole text goes through the library.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa

from sievery.llm.common import env_single_thread

BYTE_BPE, WORD_BPE, PIECES = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"
CACHED_UNITS = 600_000        # about 150 MB in a Python worker

# The splitting patterns of the two tokenizer kinds that are cut into units.
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

_ASCII_SPACE = re.compile(r"[ \t\n\r\x0b\x0c]+")
_ODD_SPACE = re.compile(r"[\x00\x01\x1c-\x1f]")
# Text that every Unicode version classes, composes and lower-cases alike: printable ASCII and
# Latin letters, one to one.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0233"
_SIMPLE = re.compile(f"[ -~{_LETTERS}]+")
# The two kinds' splitting patterns within such text.
_SHORT = "'s|'t|'re|'ve|'m|'ll|'d"
_BYTE_SPLIT = re.compile(f"{_SHORT}| ?[{_LETTERS}]+| ?[0-9]+| ?[^\\s{_LETTERS}0-9]+|\\s+(?!\\S)|\\s+")
# the same for a whole text: as it is, and where no white space follows white space or ends it
_BYTE_TEXT = f"{_SHORT}| ?[{_LETTERS}]+| ?[0-9]+| ?[^\\s{_LETTERS}0-9]+|\\s+(?!\\S)|\\s+"
_BYTE_PLAIN = f"{_SHORT}| ?[{_LETTERS}]+| ?[0-9]+| ?[^\\s{_LETTERS}0-9]+|\\s"
_PLAIN_TEXT = re.compile(f"[\t\n\r -~{_LETTERS}]*")
_WORD_SPLIT = re.compile(f"{_SHORT}|[{_LETTERS}]+|[0-9]|[^\\s{_LETTERS}0-9]+")
# Classes of the UTF-8 bytes of such text, as _WORD_SPLIT tells them apart, and of the mark between texts.
SPACE, LETTER, OTHER, DIGIT, BETWEEN = range(5)     # from DIGIT on each byte is a word
TEXT_END = 0x0B               # white space, so never in a word, and not in plain text
CLASS = np.full(256, OTHER, np.uint8)
CLASS[0x80:] = CLASS[0x41:0x5B] = CLASS[0x61:0x7B] = LETTER
CLASS[0x30:0x3A] = DIGIT
CLASS[list(b"\t\n\r ")], CLASS[TEXT_END] = SPACE, BETWEEN


def tokenizer_path(path: str | None, name: str) -> str:
    """The given path, or the public file of that name on this machine."""
    if path:
        return path
    import public_tokenizers

    return public_tokenizers.path(name)


def packed(ids: Iterable[int]) -> bytes:
    return np.asarray(list(ids), "<u4").tobytes()


# Keys of units: a word after a space is the word itself; FIRST and LINE stand before text that
# follows no space, LINE for a line feed.
FIRST, LINE = "\0", "\x01"
_ROUGH = re.compile(r"\s\s|[^\S \n]|[\x00\x01\x1c-\x1f]")


def spaced_keys(text: str) -> list[str]:
    """Keys of a text whose white space is single spaces and line feeds."""
    keys = text.replace("\n", " " + LINE).split(" ")
    keys[0] = keys[0] if keys[0][:1] == LINE else FIRST + keys[0]
    return keys


def as_keys(units: list[str]) -> list[str]:
    """Keys of units cut by a pattern."""
    return [u[1:] if u[0] == " " and len(u) > 1 else FIRST + u for u in units]


def by_key(keys: list[str], units: Callable[[list[str]], dict[str, bytes]], line: bytes
           ) -> dict[str, bytes]:
    """Ids of keys, from the ids of units and of a line feed."""
    unit = {k: k[1:] if k[:1] in (FIRST, LINE) else " " + k for k in keys}
    ids = units(list(set(unit.values()) - {""}))
    ids[""] = b""
    return {k: line + ids[u] if k[:1] == LINE else ids[u] for k, u in unit.items()}


class Units:
    """Ids of texts (little-endian unsigned 32-bit): by ``fast`` where it takes a text (by
    ``together`` for many at once, where there is one), else by way of cached units."""

    def __init__(self, split: Callable[[str], list], whole: Callable[[str], list[int]],
                 many: Callable[[list], dict], odd: re.Pattern | None = None,
                 fast: Callable[[str], bytes | None] | None = None,
                 together: Callable[[list[str]], list[bytes | None]] | None = None) -> None:
        self.split, self.whole, self.many, self.odd, self.known = split, whole, many, odd, {}
        self.fast, self.together = fast, together

    def __call__(self, texts: list[str]) -> list[bytes]:
        if self.fast is None:
            return self.by_units(texts)
        found = self.together(texts) if self.together else [self.fast(t) for t in texts]
        rest = iter(self.by_units([t for t, ids in zip(texts, found, strict=True) if ids is None]))
        return [next(rest) if ids is None else ids for ids in found]

    def by_units(self, texts: list[str]) -> list[bytes]:
        units = [None if self.odd and self.odd.search(t) else self.split(t) for t in texts]
        wanted = set().union(*[u for u in units if u is not None])
        missing = {u for u in wanted if u not in self.known}
        if len(self.known) + len(missing) > CACHED_UNITS:
            self.known.clear()
            missing = wanted
        if missing:
            self.known.update(self.many(list(missing)))
        get = self.known.__getitem__
        return [packed(self.whole(t)) if u is None else b"".join(map(get, u))
                for t, u in zip(texts, units, strict=True)]


def cut(ids: np.ndarray, at: int, units: list[str]) -> dict[str, bytes] | None:
    """Ids between separators, by unit; None if the separator's count is off."""
    ends = np.flatnonzero(ids == at)
    if len(ends) != len(units):
        return None
    starts = np.concatenate([[0], ends[:-1] + 1])
    raw = ids.astype("<u4").tobytes()
    return {u: raw[4 * a:4 * b] for u, a, b in zip(units, starts.tolist(), ends.tolist(), strict=True)}


def byte_characters() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself where it is
    printable, else the next one from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(0x100 + hidden.index(b)) for b in range(256)]


class MergeEngine:
    """Byte-pair merges of a tokenizer file by ``tiktoken``.

    That engine merges by rank, so ranks are given in merge order and turned back
    into ids.  A word-end suffix becomes the byte 0, and its merges with the last
    byte come first of all.  ``ValueError`` where merges do not give unique byte
    strings.
    """

    END = b"\0"

    def __init__(self, model: dict) -> None:
        import tiktoken

        suffix, vocab = model.get("end_of_word_suffix") or "", model["vocab"]
        chars = byte_characters()
        byte = {c: bytes([b]) for b, c in enumerate(chars)}

        def raw(token: str) -> bytes:
            if suffix and token.endswith(suffix):
                return b"".join(byte[c] for c in token[:-len(suffix)]) + self.END
            return b"".join(byte[c] for c in token)
        ranks: dict[bytes, int] = {}
        ids: list[int] = []

        def add(data: bytes, token: str) -> None:
            if data in ranks:
                raise ValueError(f"two merges make {data!r}")
            ranks[data] = len(ids)
            ids.append(vocab[token])
        for b, c in enumerate(chars):
            add(bytes([b]), c)
        if suffix:
            for b, c in enumerate(chars):
                add(bytes([b]) + self.END, c + suffix)
        for merge in model["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            add(raw(a) + raw(b), a + b)
        self.ids, self.suffix = np.array(ids, np.int64), bool(suffix)
        # ranks that end a word: with a suffix those it is part of, else the separator itself
        self.ends = np.zeros(len(ids), bool)
        self.ends[[r for data, r in ranks.items() if data.endswith(self.END)
                   and (len(data) > 1) == self.suffix]] = True
        def splitting(pattern: str) -> tiktoken.Encoding:
            return tiktoken.Encoding("merges", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.engine = splitting("[^\\x00]+\\x00" if suffix else "[^\\x00]+|\\x00")
        self.small, self.mark = self.ids.astype("<u4"), ranks.get(bytes([TEXT_END]) + self.END)
        if not suffix:
            self.rough, self.plain = splitting(_BYTE_TEXT), splitting(_BYTE_PLAIN)

    def encode(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word, merged on its own."""
        end = self.END.decode()
        ranks = np.array(self.engine.encode_ordinary(end.join(words) + end), np.int64)
        stops = np.flatnonzero(self.ends[ranks]) + 1
        starts = [0, *stops[:-1].tolist()]
        raw = self.ids[ranks].astype("<u4").tobytes()
        return {w: raw[4 * a:4 * b] for w, a, b in zip(
            words, starts, (stops - (not self.suffix)).tolist(), strict=True)}


    def byte_text(self, text: str) -> bytes | None:
        """Ids of a whole text for byte-level merges; None where it is not plain."""
        if not _PLAIN_TEXT.fullmatch(text):
            return None
        rough = ("  " in text or "\n\n" in text or " \n" in text or "\n " in text or "\t" in text
                 or "\r" in text or text[-1:] in (" ", "\n"))
        ranks = (self.rough if rough else self.plain).encode_ordinary(text)
        return self.small[np.array(ranks, np.int64)].tobytes()

    def word_text(self, text: str) -> bytes | None:
        """As ``word_texts``, of one text."""
        return self.word_texts([text])[0]

    def word_texts(self, texts: list[str]) -> list[bytes | None]:
        """Ids of whole texts for merges of lower-cased words; None where one is not plain.

        The texts are cut as one, with a mark of its own word behind each; each distinct word is
        merged once."""
        plain = [_PLAIN_TEXT.fullmatch(t) is not None for t in texts]
        marked = "".join([t + chr(TEXT_END) for t, p in zip(texts, plain, strict=True) if p])
        if not marked:
            return [None] * len(texts)
        raw = cut_words(marked.lower().encode())
        stops = np.concatenate([[0], np.flatnonzero(raw == 0) + 1])
        words = pa.Array.from_buffers(pa.large_binary(), len(stops) - 1,
                                      [None, pa.py_buffer(stops), pa.py_buffer(raw)]).dictionary_encode()
        _, at, data = words.dictionary.buffers()
        size = int(np.frombuffer(at, np.int64)[len(words.dictionary)])
        ranks = self.engine.encode_to_numpy(data[:size].to_pybytes().decode())
        ends = np.flatnonzero(self.ends[ranks]) + 1
        starts = np.concatenate([[0], ends[:-1]])
        own = words.indices.to_numpy()
        found = ranks[pieces_of((ends - starts)[own], starts[own])]
        ids, ends = self.small[found].tobytes(), np.flatnonzero(found == self.mark).tolist()
        one = iter([ids[4 * a + 4:4 * z] for a, z in zip([-1, *ends[:-1]], ends, strict=True)])
        return [next(one) if p else None for p in plain]


def pieces_of(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places of runs that begin at ``starts``, one run after the other."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def cut_words(text: bytes) -> np.ndarray:
    """The bytes of the words that _WORD_SPLIT finds in lower-cased plain text, with a 0 behind each."""
    raw = np.frombuffer(text, np.uint8)
    kind = CLASS[raw]
    here, after = kind[:-1], kind[1:]
    cut = (here != after) | (here >= DIGIT)           # between this byte and the next
    cut &= (here != SPACE) & (after != SPACE)
    if b"'" in text:
        first = np.flatnonzero((raw[1:] == 0x27) & (here != OTHER)) + 1
        if raw[0] == 0x27:
            first = np.concatenate([[0], first])
        for short in (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"):
            at = first[first + len(short) < len(raw)]
            for k, c in enumerate(short, 1):
                at = at[raw[at + k] == c]
            last = at + len(short)
            cut[at] = False
            last = last[last < len(cut)]
            cut[last] = after[last] != SPACE
    out, cut, blank = raw.copy(), np.flatnonzero(cut) + 1, kind == SPACE
    out[blank] = 0                                    # the 0 of the word before it
    spare = np.flatnonzero(blank & np.concatenate([[True], blank[:-1]]))
    if len(spare):
        cut, out = cut - np.searchsorted(spare, cut), np.delete(out, spare)
    return np.insert(out, np.append(cut, len(out)) if len(out) and out[-1] else cut, 0)


def _json_tokenizer(path: str) -> Units:
    env_single_thread()
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    tok = Tokenizer.from_file(path)
    tok.encode_special_tokens = True

    def whole(text: str) -> list[int]:
        return tok.encode(text, add_special_tokens=False).ids

    pre = spec.get("pre_tokenizer") or {}
    byte = (pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
            and not spec.get("normalizer"))
    first = (pre.get("pretokenizers") or [{}])[0]
    word = (pre.get("type") == "Sequence" and first.get("type") == "Split" and first.get("invert")
            and first.get("behavior") == "Removed"
            and first.get("pattern", {}).get("Regex") == WORD_PATTERN)
    if not (byte or word):
        return Units(lambda t: [t], whole, lambda units: {u: packed(whole(u)) for u in units},
                     re.compile(""))
    try:
        engine = MergeEngine(spec["model"])
    except (KeyError, ValueError):
        engine = None

    def many(units: list[str]) -> dict[str, bytes]:
        parts: dict[str, list[str]] = {}
        for u in units if engine else ():
            if u.isascii() and u.isprintable() or _SIMPLE.fullmatch(u):
                if byte:
                    parts[u] = [u] if u.removeprefix(" ").isalpha() else _BYTE_SPLIT.findall(u)
                else:
                    v = u.lower()
                    parts[u] = [v] if v.isalpha() else _WORD_SPLIT.findall(v)
        words = list(set().union(*parts.values()))
        ids = engine.encode(words) if words else {}
        out = {u: b"".join([ids[w] for w in p]) for u, p in parts.items()}
        out.update((u, packed(whole(u))) for u in units if u not in out)
        return out

    if byte:
        cutter, line = re.compile(r" ?\S+|\s+(?!\S)|\s").findall, packed(whole("\n"))
        return Units(lambda t: as_keys(cutter(t)) if _ROUGH.search(t) else spaced_keys(t), whole,
                     lambda keys: by_key(keys, many, line), _ODD_SPACE, engine and engine.byte_text)

    def dropped(words: list[bytes]) -> dict[bytes, bytes]:
        text = {w: w.decode() for w in words}
        ids = many(list(text.values()))
        return {w: ids[u] for w, u in text.items()}

    fast, together = (engine.word_text, engine.word_texts) if engine and engine.suffix else (None, None)
    return Units(lambda t: t.encode().split(), whole, dropped, None, fast, together)


@functools.lru_cache(2)
def encoder(path: str) -> Units:
    """Encoder of a ``tokenizers`` file, kept for the life of the worker process."""
    return _json_tokenizer(path)


# ------------------------------------------------------------------ sentence pieces

def wire(data: bytes) -> Iterable[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message."""
    def number(i: int) -> tuple[int, int]:
        out = shift = 0
        while True:
            byte = data[i]
            out |= (byte & 127) << shift
            i, shift = i + 1, shift + 7
            if byte < 128:
                return out, i
    i = 0
    while i < len(data):
        tag, i = number(i)
        kind = tag & 7
        if kind == 0:
            value, i = number(i)
        elif kind == 2:
            size, i = number(i)
            value, i = data[i:i + size], i + size
        else:
            size = 4 if kind == 5 else 8
            value, i = data[i:i + size], i + size
        yield tag >> 3, value


class PieceModel:
    """What encoding needs to know of a sentence-piece model file."""

    BYTE, UNKNOWN, CONTROL = 6, 2, 3

    def __init__(self, path: str) -> None:
        import sentencepiece

        with open(path, "rb") as f:
            data = f.read()
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.pieces: list[bytes] = []
        self.kinds: list[int] = []
        self.charsmap, self.dummy_prefix, self.remove_extra, self.escape = b"", True, True, True
        for field, value in wire(data):
            if field == 1:
                own = dict(wire(value))
                self.pieces.append(own.get(1, b""))
                self.kinds.append(own.get(3, 1))
            elif field == 3:
                for k, v in wire(value):
                    if k == 2:
                        self.charsmap = v
                    elif k == 3:
                        self.dummy_prefix = bool(v)
                    elif k == 4:
                        self.remove_extra = bool(v)
                    elif k == 5:
                        self.escape = bool(v)
        space = "▁".encode()
        plain = [p for p, k in zip(self.pieces, self.kinds, strict=True) if k == 1]
        line = self.processor.encode("\n")
        self.line_feed = line[-1] if len(line) == 2 else None
        self.separable = (not self.charsmap and not self.remove_extra and self.dummy_prefix
                          and self.escape and self.line_feed is not None
                          and self.kinds[self.line_feed] == self.BYTE
                          and not any(b"\n" in p or space in p.lstrip(space) for p in plain)
                          and not any(k == 4 for k in self.kinds))

    def whole(self, text: str) -> list[int]:
        return self.processor.encode(text)

    def units(self) -> Units:
        if not self.separable:
            return Units(lambda t: [t], self.whole,
                         lambda units: {u: packed(self.whole(u)) for u in units}, re.compile(""))
        cutter = re.compile(r" *[^ \n]+| +|\n").findall
        line = packed([self.line_feed])

        def many(units: list[str]) -> dict[str, bytes]:
            own = [u for u in units if u != "\n"]
            ids = np.array(self.whole("\n" + "\n".join(own) + "\n"), np.int64)
            found = cut(ids[2:], self.line_feed, own) if own else {}
            if found is None:
                found = {u: packed(self.whole("\n" + u)[2:]) for u in own}
            return {**found, "\n": line}

        def split(text: str) -> list[str]:
            if not text:
                return []
            if _ROUGH.search(text):
                return as_keys(cutter(" " + text))
            keys = text.replace("\n", " " + LINE).split(" ")
            if not keys[0] and keys[1][:1] == LINE:   # the written prefix stands alone
                keys[0] = FIRST + " "
            elif not keys[0]:                         # a space follows the written prefix
                keys[:2] = [FIRST + "  " + keys[1]]
            return keys

        return Units(split, self.whole, lambda keys: by_key(keys, many, line), re.compile("[▁\x00\x01]"))


@functools.lru_cache(2)
def piece_model(path: str) -> tuple[PieceModel, Units]:
    model = PieceModel(path)
    return model, model.units()
