import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sievery.llm import tokens

ODD = ["a", "The", " ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "é", "ß", "'s", "don't", "123", "!", ".",
       "<|endoftext|>", "▁", "日本", "🙂", "\xa0", "\x1c", "İ", "Σ", "word", "Word,", "x_y", "|", " | ",
       "\r\n", "é", "ﬁ", "\x00", "\x01", "​", "ǅ", "http://a.b/c?d=1"]


def texts():
    rng = random.Random(11)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(3000)]


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_ids_are_the_librarys(name):
    tok = Tokenizer.from_file(P.path(name))
    tok.encode_special_tokens = True
    encode = tokens.encoder(P.path(name))
    for t, got in zip(texts(), encode(texts()), strict=True):
        assert got == tokens.packed(tok.encode(t, add_special_tokens=False).ids), repr(t)


def test_piece_ids_are_the_librarys():
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path(tokens.PIECES))
    model, units = tokens.piece_model(P.path(tokens.PIECES))
    assert model.separable
    for t, got in zip(texts(), units(texts()), strict=True):
        assert got == tokens.packed(sp.encode(t)), repr(t)


def test_a_full_cache_changes_nothing(monkeypatch):
    encode = tokens.encoder(P.path(tokens.BYTE_BPE))
    expected = encode(texts()[:300])
    monkeypatch.setattr(tokens, "CACHED_UNITS", 50)
    assert [encode([t])[0] for t in texts()[:300]] == expected


def test_cut_needs_every_separator():
    assert tokens.cut(np.array([1, 9, 2, 2, 9]), 9, ["a", "b"]) == {
        "a": tokens.packed([1]), "b": tokens.packed([2, 2])}
    assert tokens.cut(np.array([1, 9, 9, 2, 9]), 9, ["a", "b"]) is None


PLAIN = ["a", "The", " ", "  ", "\n", "\n\n", " \n", "\t", "é", "ß", "'s", "don't", "DON'T", "123", "!", "...", "Ÿ",
         "<|endoftext|>", "word", "Word,", "x_y", "|", " | ", "\r\n", "http://a.b/c?d=1", "ĳ", "Å", "''ll", "9a"]


@pytest.mark.parametrize("name", [tokens.BYTE_BPE, tokens.WORD_BPE])
def test_whole_plain_texts_have_the_librarys_ids(name):
    """By the second engine, without units."""
    tok = Tokenizer.from_file(P.path(name))
    tok.encode_special_tokens = True
    encode, rng = tokens.encoder(P.path(name)), random.Random(7)
    own = ["".join(rng.choices(PLAIN, k=rng.randint(0, 20))) for _ in range(4000)]
    own += ["x" * 3000, " " * 500, "\n" * 300, "ab " * 2000, ""]
    for sep in ("\n", " "):
        own += [sep.join(own[k:k + 20]) for k in range(0, 400, 20)]
    for t in own:
        got = encode.fast(t)
        assert got == tokens.packed(tok.encode(t, add_special_tokens=False).ids), repr(t)
    for t in ("日本", "a\xa0b", "x\x00", "İ", "e\u0301", "a\x0bb", "½"):
        assert encode.fast(t) is None and encode([t])[0] == tokens.packed(tok.encode(t, add_special_tokens=False).ids)


def test_plain_texts_are_encoded_together(monkeypatch):
    """Many texts at once have the ids of each, and a word is merged once however often it comes."""
    path = P.path(tokens.WORD_BPE)
    tok, encode, rng = Tokenizer.from_file(path), tokens.encoder(path), random.Random(3)
    tok.encode_special_tokens = True
    own = ["".join(rng.choices([*PLAIN, "'", "'re", "'Ve", "\r", "日", "\x0b"], k=rng.randint(0, 9))) for _ in range(3000)]
    own = [*own, "", " ", " \n", "", "'", "'s", "''s", "a's's", "'llama", "12's", "'", *["Mostly harmless, mostly."] * 900]
    got = encode.together(own)
    assert sum(g is None for g in got) > 100 and encode.together([]) == [] and encode.together(["日"]) == [None]
    for t, g, whole in zip(own, got, encode(own), strict=True):
        ids = tokens.packed(tok.encode(t, add_special_tokens=False).ids)
        assert whole == ids and g in (ids, None), repr(t)
    engine, merged = encode.together.__self__.engine, []

    class Noting:
        def encode_to_numpy(self, text):
            merged.append(text)
            return engine.encode_to_numpy(text)
    monkeypatch.setattr(encode.together.__self__, "engine", Noting())
    assert encode(["Mostly harmless, mostly."] * 900) == got[-900:]
    assert sorted(merged[0].strip("\0").split("\0")) == ["\x0b", ",", ".", "harmless", "mostly"]
