import public_tokenizers as P
import pytest
import sentencepiece

from sievery.llm import pieces, tokens
from tests.llm.fixtures import TEXTS, documents


def test_equals_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=P.path(tokens.PIECES))
    got = sorted(((str(r.doc_id), list(r.ids), r.decoded) for r in pieces.encode(documents(spark)).collect()))
    expected = [(str(i), sp.encode(t or "")) for i, t in TEXTS]
    assert got == sorted((i, ids, sp.decode(ids)) for i, ids in expected)
    assert pieces.encode(documents(spark).limit(0)).count() == 0


def test_spans_cover_the_text_in_order():
    model, units = tokens.piece_model(P.path(tokens.PIECES))
    aligner = pieces.Aligner(model)
    sp = model.processor
    for t in [t or "" for _, t in TEXTS] + ["  two  spaces ", "a▁b", "▁", "\n", "日本🙂 x", "é"]:
        ids = sp.encode(t)
        starts, ends = aligner.spans(t, pieces.np.array(ids, int))
        data = t.encode()
        assert (starts[1:] == ends[:-1]).all() and (starts <= ends).all()
        assert (ends[-1] if len(ids) else 0) == len(data)
        for i, a, b in zip(ids, starts.tolist(), ends.tolist(), strict=True):
            piece = model.pieces[i]
            if model.kinds[i] == model.BYTE:
                assert data[a:b] == bytes([int(piece[3:5], 16)])
            else:
                own = piece.replace(pieces.SPACE, b" ")
                assert data[a:b] in (own, piece) or a == 0 and data[a:b] in (own[1:], piece[3:])


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc", "nmt_nfkc_cf"])
def test_character_map_normalises_as_the_library(rule):
    normalizer = sentencepiece.SentencePieceNormalizer(
        rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True)
    spec = dict(tokens.wire(normalizer.serialized_model_proto()))[3]
    charmap = pieces.CharMap(dict(tokens.wire(spec))[2])
    for t in ["Ｈｅｌｌｏ　Ｗｏｒｌｄ", "ﬁne ﬀ", "①②", " a  b ", "", "   ", "Å Å Ａ", "㌔ ㍿", "x\ty\nz", "ＡＢ　c", "ÀÉ", "가"]:
        out, source = pieces.normalized(t.encode(), charmap, True, True, True)
        assert out.decode() == normalizer.normalize(t)
        assert len(source) == len(out) + 1 and source == sorted(source)
        assert source[-1] <= len(t.encode())


def test_alignment_of_replaced_characters():
    normalizer = sentencepiece.SentencePieceNormalizer(rule_name="nfkc")
    spec = dict(tokens.wire(normalizer.serialized_model_proto()))[3]
    charmap = pieces.CharMap(dict(tokens.wire(spec))[2])
    out, source = pieces.normalized("aﬁb".encode(), charmap, False, False, False)
    assert out == b"afib" and source == [0, 1, 1, 4, 5]
