import hashlib
import random

import pytest

from lodestrata.llm import pieces as p

tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
PATH = tokenizers.path("piece_bpe_32k.model")

PARTS = [
    " ", "  ", "\n", "\t", "▁", "a", "e", "th", "ing", "é", "ß", "日本", "😀", "é", "<0x0A>", "<s>", "</s>", "<unk>",
    "0", "123", ".", "...", "'s", "\x00", "\r\n", "İ", "ﬁ", "the", "Hello", "ñ", "’", "==", "----", "aaaaaaa", "     ", ",", "x,y.",
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_random_texts_as_the_library(library):
    model, rng = p.model(PATH), random.Random(5)
    for _ in range(15000):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12)))
        want = library.encode(text)
        ids, decoded = model.digest(text)
        assert ids == ",".join(map(str, want)).encode(), repr(text)
        assert decoded == library.decode(want) == model.decode(want), repr(text)
        assert model.encode(text) == want


def test_signs_after_superscripts_and_fractions(library):
    model, rng = p.model(PATH), random.Random(6)
    odd = [*PARTS, "²", "½", "³", "¹", "Ⅷ", "km²", " km².", "x³)", "m².", ".", ")", ";"]
    texts = [" km².", "km².", "10 km², 3 m³. ½.", *("".join(rng.choice(odd) for _ in range(rng.randint(1, 10))) for _ in range(5000))]
    for text in texts:
        want = library.encode(text)
        ids, decoded = model.digest(text)
        assert ids == ",".join(map(str, want)).encode(), repr(text)
        assert decoded == library.decode(want), repr(text)


def test_every_pair_cut_apart_is_in_no_piece():
    model = p.model(PATH)
    pairs = {(a, b) for piece in model.ids for a, b in zip(piece, piece[1:])}
    for a in map(chr, [*range(33, 0xD800), *range(0xE000, 0x20000)]):
        for b in p._SIGNS:
            if len(model.split(a + b)) == 2:
                assert (a, b) not in pairs, a + b


def test_long_runs(library):
    model = p.model(PATH)
    for text in (" " * 5000 + "x", "a" * 3000, "ab " * 4000, "\n" * 3000, "thhe" * 2000, "日" * 2000):
        assert model.encode(text) == library.encode(text)


def test_bounded_tables_change_nothing(library, monkeypatch, prose):
    monkeypatch.setattr(p, "KEPT_UNITS", 3)
    monkeypatch.setattr(p, "KEPT_PAIRS", 3)
    model = p.PieceModel(PATH)
    for i in range(20):
        text = prose(100, i)
        assert model.digest(text)[0] == ",".join(map(str, library.encode(text))).encode()
    assert all(len(g) <= 3 for t in (model.units, model.pairs) for g in (t.young, t.old))


def test_frames(spark, documents, library, prose):
    rows = [(i, prose(50 * i + 1, i)) for i in range(12)] + [(90, None), (91, ""), (92, " "), (None, "x"), (3, prose(151, 3))]
    found = p.digests(documents(rows), PATH, keep=["doc_id"], with_ids=True).collect()
    assert len(found) == len(rows)
    for (doc_id, text), r in zip(rows, found):
        ids = library.encode(text or "")
        assert (r.doc_id, r.n_tokens, r.ids) == (doc_id, len(ids), ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
    back = p.decode(p.encode(documents(rows), lambda: PATH, keep=["doc_id", "text"]), PATH).collect()
    assert all(r.decoded == library.decode(library.encode(r.text or "")) for r in back)
    assert p.digests(documents([]), PATH, keep=["doc_id"]).count() == 0
