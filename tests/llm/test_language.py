import zlib

import numpy as np

from lodestrata.llm import language as g

SYLLABLES = {"aa": "ba ko lu mi", "bb": "sch ung ein tz", "cc": "ción ar ñe que", "dd": "éau oi ç ent"}


def corpus(n):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(n):
        lang = list(SYLLABLES)[i % 4]
        parts = SYLLABLES[lang].split()
        words = ["".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(rng.integers(3, 60))]
        rows.append((i, " ".join(words), lang))
    return rows


def test_held_out_accuracy(documents):
    rows = corpus(240)
    found = {r.doc_id: r for r in g.identify(documents(rows), per_lang=30, landmarks_per_lang=8).collect()}
    assert len(found) == 240
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    held = [(i, lang) for i, _, lang in rows if found[i].held_out]
    assert len(held) > 30
    assert np.mean([found[i].lang_pred == lang for i, lang in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values())


def test_texts_without_letters(documents):
    rows = corpus(80) + [(900, None, "aa"), (901, "", None), (902, "12 %% 3", "bb"), (903, "ein", None), (903, "ein", None)]
    found = g.identify(documents(rows), per_lang=20).collect()
    by = {r.doc_id: r for r in found}
    assert len(found) == len(rows)
    assert [by[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert [by[i].score for i in (900, 901, 902)] == [0.0] * 3
    assert by[903].lang_pred in SYLLABLES
    kept = g.known_language(documents(rows), per_lang=20)
    assert kept.columns == documents(rows).columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {900, 901, 902}


def test_nothing_to_learn_from(documents):
    rows = documents([(1, "words here", None), (2, None, "en")])
    assert {r.lang_pred for r in g.identify(rows).collect()} == {"und"}
    assert g.known_language(rows).count() == 2
    assert g.identify(documents([])).count() == 0


def test_long_texts_are_read_whole(monkeypatch):
    text = "ab" * 500 + "xyz" + "cd" * 500
    whole, pieces = np.zeros(g.BUCKETS), np.zeros(g.BUCKETS)
    g.mark(text, whole)
    monkeypatch.setattr(g, "_PIECE", 64)
    g.mark(text, pieces)
    assert (whole == pieces).all()
    start = np.zeros(g.BUCKETS)
    g.mark(text[:900], start)
    assert (start != whole).any()


def packed_of(text):
    row = np.zeros(g.BUCKETS, np.uint8)
    g.mark(text, row)
    return np.packbits(row).tobytes(), set(np.flatnonzero(row).tolist())


def test_kernel_and_regression_as_written_out():
    """Presence kernel by sets; landmarks, regression and values by plain linear algebra."""
    rows = corpus(24)
    packed, sets = zip(*(packed_of(text) for _, text, _ in rows))
    langs = [lang for _, _, lang in rows]
    kernel = g.fit(list(packed), langs, 2, 1.0)

    def k(a, b):
        return len(a & b) / (len(a) * len(b)) ** 0.5

    chosen = [[i for i, x in enumerate(langs) if x == name][:2] for name in sorted(set(langs))]
    chosen = [i for own in chosen for i in own]
    inner = np.array([[k(sets[i], sets[j]) for j in chosen] for i in range(24)])
    assert np.allclose(kernel.inner(g.unpacked(list(packed))), inner, atol=1e-5)
    # Nystroem: features whose inner products are K_nm K_mm^-1 K_mn.
    values, vectors = np.linalg.eigh(inner[chosen])
    features = inner @ vectors @ np.diag(values**-0.5)
    assert np.allclose(features @ features.T, inner @ np.linalg.inv(inner[chosen]) @ inner.T, atol=1e-6)
    target = np.array([[1.0 if x == name else -1.0 for name in kernel.langs] for x in langs])
    centred = features - features.mean(0)
    # Ridge with a free constant, in the dual form.
    dual = np.linalg.solve(centred @ centred.T + np.eye(24), target - target.mean(0))
    want = centred @ centred.T @ dual + target.mean(0)
    assert np.allclose(kernel.values(g.unpacked(list(packed))), want, atol=1e-3)


def test_every_one_of_300_languages_is_learned(documents):
    """Each has letters of its own; texts and landmarks are fewer, none is left out."""
    rng = np.random.default_rng(5)
    rows = []
    for n in range(300):
        letters = [chr(0x4E00 + 6 * n + j) for j in range(6)]
        for i in range(8):
            words = ["".join(rng.choice(letters, 4)) for _ in range(12)]
            rows.append((1000 * i + n, " ".join(words), f"l{n:03}"))
    assert g.shares(4) == (250, 32) and g.shares(300) == (54, 3) and g.shares(5000) == (12, 2)
    found = g.identify(documents(rows)).collect()
    held = [(r.lang_pred, f"l{r.doc_id % 1000:03}") for r in found if r.held_out]
    assert len(held) > 400 and np.mean([a == b for a, b in held]) > 0.97
    assert len({r.lang_pred for r in found}) == 300
