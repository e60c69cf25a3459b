import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from lodestrata.llm import alignment as al

public = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
pytest.importorskip("tiktoken")
A, B = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")

PARTS = [
    " ", "  ", "\n", "\t", "▁", "a", "e", "th", "ing", "é", "ß", "日本", "😀", "é", "<0x0A>", "<s>", "</s>", "<unk>", "<|endoftext|>",
    "0", "123", ".", "...", "'s", "'S", "\x00", "\r\n", "İ", "the", "Hello", "’", "\xa0", "　", "\x85", "\x1c", "½", "²", "_", "'ll",
]


@pytest.fixture(scope="module")
def both():
    return al.tokenizers(A, public.PATTERN, B)


@pytest.fixture(scope="module")
def libraries():
    own = tokenizers.Tokenizer.from_file(A)
    own.encode_special_tokens = True
    return own, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(libraries, text):
    """Tokens (id, bytes) of either kind, by the libraries."""
    signs = al.byte_signs()
    own, pieces = libraries
    a = own.encode(" " + text, add_special_tokens=False)
    first = [(i, bytes(signs[c] for c in t)) for i, t in zip(a.ids, a.tokens)]
    second = []
    for i in pieces.encode(text):
        p = pieces.id_to_piece(i)
        second.append((i, bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()))
    return first, second


def brute(libraries, rows):
    """Groups and links by plain loops."""
    out = []
    for doc_id, text in rows:
        groups = []
        if text:
            first, second = plain(libraries, text)
            data = (" " + text).encode()
            if b"".join(t for _, t in first) == data == b"".join(t for _, t in second):
                ends_a, ends_b = (
                    {end: n for n, end in enumerate(np.cumsum([len(t) for _, t in own]).tolist(), 1)} for own in (first, second)
                )
                a = b = 0
                for end in sorted(ends_a.keys() & ends_b.keys()):
                    x, y = ends_a[end], ends_b[end]
                    groups.append(([i for i, _ in first[a:x]], [i for i, _ in second[b:y]]))
                    a, b = x, y
        out.append((doc_id, groups))
    count = Counter((g[0][-1], g[1][-1]) for _, groups in out for g in groups)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    rows = []
    for doc_id, groups in out:
        links = [(g[0][-1], g[1][-1]) for g in groups]
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append(
            (
                doc_id, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
                sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links),
                hashlib.sha256(told.encode()).hexdigest() if told else "",
            )
        )
    return sorted(rows, key=str)


def test_random_texts_as_the_libraries(both, libraries):
    rng = random.Random(7)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))) for _ in range(6000)]
    for text, a, b in zip(texts, *both.encode(texts)):
        first, second = plain(libraries, text)
        kept = text and b"".join(t for _, t in second) == (" " + text).encode()
        assert a.tolist() == ([i for i, _ in first] if kept else []), repr(text)
        assert b.tolist() == ([i for i, _ in second] if kept else []), repr(text)


def test_gallop_as_bisection():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        target = np.unique(rng.integers(0, 200, n))
        values = rng.integers(0, target[-1] + 1, 40)
        ends = np.full(40, len(target) - 1)
        guess = rng.integers(0, len(target), 40)
        found = al.gallop(values, target, np.zeros(40, np.int64), ends, guess)
        assert found.tolist() == [bisect.bisect_left(target.tolist(), v) for v in values.tolist()]


def test_common_ends_of_many_documents():
    rng = np.random.default_rng(3)
    for _ in range(100):
        lists, base = ([], []), 0
        for _ in range(int(rng.integers(1, 8))):
            size = int(rng.integers(1, 50))
            for own in lists:
                ends = np.unique(rng.integers(1, size + 1, int(rng.integers(1, 40))))
                own.append(base + np.unique(np.append(ends, size)))
            base += size
        if rng.random() < 0.5:  # documents without tokens
            for own in lists:
                own.insert(1, np.zeros(0, np.int64))
        n = [np.array([len(e) for e in own]) for own in lists]
        flat = [np.concatenate(own) for own in lists]
        a, b = al.common_ends(flat[0], n[0], flat[1], n[1])
        want = sorted(set(flat[0].tolist()) & set(flat[1].tolist()))
        assert flat[0][a].tolist() == want == flat[1][b].tolist()


def test_overlaps_as_all_pairs():
    rng = np.random.default_rng(9)
    for _ in range(200):
        size = int(rng.integers(1, 30))
        ends = [np.unique(np.append(rng.integers(1, size + 1, 8), size)) for _ in range(2)]
        first, last = al.overlaps(*ends)
        spans = [list(zip([0, *e[:-1].tolist()], e.tolist())) for e in ends]
        for (start, stop), f, t in zip(spans[0], first, last):
            assert [j for j, (x, y) in enumerate(spans[1]) if x < stop and y > start] == list(range(f, t + 1))


def test_every_link_is_possible(both):
    a, b = both.link_a, both.link_b
    assert np.array_equal(both.links(a, b), np.arange(len(a)))
    assert len(a) < 10 * (len(both.a.bytes) + len(both.b.bytes))
    for i in range(0, len(a), 997):
        x, y = both.a.bytes[int(a[i])], both.b.bytes[int(b[i])]
        assert x.endswith(y) or y.endswith(x)


def test_whole_against_brute_force(spark, documents, libraries, scratch, prose):
    rng = random.Random(11)
    rows = [(i, prose(5 + 9 * i, i)) for i in range(25)]
    rows += [(100 + i, "".join(rng.choice(PARTS) for _ in range(60))) for i in range(40)]
    rows += [(200, None), (201, ""), (202, " "), (203, "▁"), (None, "no id"), (5, rows[5][1]), (5, "the the the"), (206, prose(20000, 3))]
    found = al.agreement(documents(rows).repartition(4), lambda: A, public.PATTERN, lambda: B)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == brute(libraries, rows)
    groups = al.align(documents(rows[:3]), A, public.PATTERN, B).orderBy("doc_id").collect()
    assert all(len(r.a_stops) == len(r.b_stops) and r.a_stops[-1] == len(r.a_ids) for r in groups)
    assert al.agreement(documents([]), A, public.PATTERN, B).count() == 0


def test_runs_of_blanks_past_the_pattern(both, libraries):
    text = " " * 400_000 + "x"
    (a,), _ = both.encode([text])
    assert a.tolist() == libraries[0].encode(" " + text, add_special_tokens=False).ids
