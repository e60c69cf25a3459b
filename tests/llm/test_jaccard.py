import random
import re

import numpy as np
import pytest

from lodestrata.llm import jaccard as j

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    name = {i: i for i, _ in sets}

    def root(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, (i, s) in enumerate(sets):
        for k, t in sets[:a]:
            common = len(s & t)
            if common and 100 * common >= 80 * (len(s) + len(t) - common):
                x, y = root(i), root(k)
                name[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets}


def edited(text, n, seed):
    rng = random.Random(seed)
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def check(documents, rows):
    found = j.join(documents(rows)).collect()
    assert len(found) == len(rows)
    want = brute(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None}
    assert got == want
    return found


def test_against_brute_force(documents, prose):
    rows, i = [], 0
    for base in range(12):
        n = (6, 9, 14, 22, 40, 60, 90, 130, 200, 300, 500, 800)[base]
        text = prose(n, base)
        for copy in range(9):
            rows.append((i, edited(text, copy * n // 90, i)))
            i += 1
            rows.append((i, text[: len(text) - copy * len(text) // 40]))
            i += 1
    passage = prose(60, 999)
    for k in range(40):
        rows.append((i, prose(10 + 3 * k, 2000 + k) + " " + passage))
        i += 1
    rows += [(i + 1, rows[0][1].upper()), (i + 2, rows[50][1].replace(" ", "\n\t "))]
    check(documents, rows)


def test_short_texts_nulls_and_repeats(documents):
    rows = [
        (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "One"), (6, "one two three four"), (7, "one two three four"),
        (8, "a b c d e"), (9, "a b c d e f g h"), (10, "a b c d e f g h i"), (11, "one two"), (8, "a b c d e"),
        (None, "one"), (None, None),
    ]
    found = check(documents, rows)
    assert [r.component_id for r in found if r.doc_id is None] == [None, None]
    assert j.join(documents([])).count() == 0


def test_large_group_around_a_centre(documents, prose, monkeypatch):
    """Copies that are each near the centre and far from each other, in small squares."""
    monkeypatch.setattr(j, "CHUNK", 16)
    centre = prose(300, 5)
    rows = [(100 + k, edited(centre, 6, k)) for k in range(120)] + [(90, centre)]
    rows += [(500 + k, centre) for k in range(60)]
    found = check(documents, rows)
    assert {r.component_id for r in found} == {90}


def test_one_of_each(documents, prose):
    text = prose(100, 1)
    rows = [(5, text), (3, edited(text, 1, 2)), (9, prose(80, 3)), (9, prose(80, 3)), (11, None), (12, ""), (None, text)]
    own = documents(rows)
    kept = j.one_of_each(own)
    assert kept.columns == own.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["11", "12", "3", "9", "None"]


def test_lower_thresholds_are_refused(documents):
    with pytest.raises(ValueError):
        j.join(documents([]), percent=79)


def sent(own, classes):
    keys, counts = j.block_keys(own)
    return keys[j.rarest(keys, np.array(counts, np.int64), np.full(len(counts), len(own)), classes)]


def test_blocks_of_similar_sets_meet():
    """Sets at the bound always have a block in common, whatever their size and the order."""
    rng = np.random.default_rng(3)
    for _ in range(400):
        x = int(rng.integers(4, 400))
        classes = rng.integers(0, 30, j.COUNTERS).astype(np.uint8) * rng.integers(0, 2)
        a = np.unique(rng.integers(0, 1 << 63, x, dtype=np.uint64))
        b = np.unique(np.append(a, rng.integers(0, 1 << 63, len(a) // 4, dtype=np.uint64)))
        swap = len(a) // 9
        c = np.unique(np.append(a[swap:], rng.integers(0, 1 << 63, swap, dtype=np.uint64)))
        for other in (b, c):
            common = len(np.intersect1d(a, other))
            if 100 * common >= 80 * (len(a) + len(other) - common):
                assert len(np.intersect1d(sent(a, classes), sent(other, classes)))
                width = min(len(j.sketch_of(a)), len(j.sketch_of(other)))
                d = np.bitwise_count(j.folded(j.sketch_of(a), width) ^ j.folded(j.sketch_of(other), width)).sum()
                assert d <= len(a) + len(other) - 2 * common


def test_one_line_in_all_documents_brings_few_together(documents, prose):
    """Of 76 shingles 16 are the same in all: pairs that share a block sent stay few."""
    line = prose(20, 1)
    rows = [(i, f"{prose(56, 50 + i)} {line}") for i in range(300)]
    rows += [(1000 + i, edited(rows[i][1], 1, i)) for i in range(10)]
    check(documents, rows)
    sets = j.shingle_sets([t for _, t in rows])
    totals = np.zeros(j.COUNTERS, np.int64)
    for s in sets:
        totals += np.bincount(j.counter_of(j.block_keys(s)[0]), minlength=j.COUNTERS)
    classes = np.log2(np.maximum(totals, 1)).astype(np.uint8)
    largest = {}
    for name, order in (("rare", classes), ("any", np.zeros(j.COUNTERS, np.uint8))):
        keys = np.concatenate([sent(s, order) for s in sets])
        largest[name] = np.unique(keys, return_counts=True)[1].max()
    assert largest["rare"] <= 4 and largest["any"] > 20


def test_one_very_long_text(documents, prose):
    text = prose(60_000, 4)
    check(documents, [(1, text), (2, edited(text, 500, 3)), (3, prose(300, 5)), (4, edited(text, 5000, 6))])
