import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lodestrata.llm import packing as p

public = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public.path("word_bpe_49k.json")


def one_by_one(lengths, capacity):
    """Room left in each sequence, by best-fit decreasing of single pieces."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


def places_of(plan, counts):
    for length, n in counts.items():
        sequence, offset = plan.places(np.full(n, length), np.arange(n))
        yield from zip(sequence.tolist(), offset.tolist(), [length] * n)


def gapless(places, capacity):
    """Tokens in each sequence, none overlapping and none between."""
    by = defaultdict(list)
    for sequence, offset, length in places:
        by[sequence].append((offset, length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(by) == list(range(len(by)))
    return {s: sum(n for _, n in own) for s, own in by.items()}


@pytest.mark.parametrize("seed", range(8))
def test_runs_as_single_pieces(seed):
    rng = random.Random(seed)
    for _ in range(60):
        capacity = rng.choice([1, 5, 16, 100])
        top = rng.randint(1, capacity)
        lengths = [rng.randint(1, top) for _ in range(rng.randint(0, 120))]
        if rng.random() < 0.3:
            lengths += [rng.randint(1, capacity)] * 90
        counts = Counter(lengths)
        plan = p.best_fit(counts, capacity)
        filled = gapless(places_of(plan, counts), capacity)
        assert sorted(capacity - n for n in filled.values()) == one_by_one(lengths, capacity)
        assert plan.sequences == len(filled)


def test_blocks_do_not_grow_with_the_pieces():
    rng = random.Random(1)
    small = Counter(min(4096, int(rng.lognormvariate(6, 1.2)) + 1) for _ in range(20_000))
    a = p.best_fit(small)
    b = p.best_fit({n: 1000 * c for n, c in small.items()})
    assert len(b.length) < 2 * len(a.length) < 20 * 4096
    whole = sum(n * c for n, c in small.items())
    assert a.sequences <= -(-whole // 4096) * 1.01 + 1
    assert b.sequences <= -(-1000 * whole // 4096) * 1.001 + 1


def test_too_long_a_piece():
    with pytest.raises(ValueError):
        p.best_fit({5: 1}, 4)


@pytest.mark.parametrize("capacity", [16, 4096])
def test_whole_against_the_library(spark, documents, scratch, prose, capacity):
    rows = [(i, prose(1 + i % 45, i)) for i in range(150)]
    rows += [(500, None), (501, ""), (502, " \n"), (None, "no id"), (None, None), (7, "again"), (7, "again"), (503, prose(9000, 2))]
    found = p.pack(documents(rows).repartition(5), lambda: PATH, 1, capacity)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = found.collect()
    whole = tokenizers.Tokenizer.from_file(PATH)
    want = []
    for doc_id, text in rows:
        ids = np.array([*whole.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            want.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    assert sorted((tuple(r[:5]) for r in got), key=str) == sorted(want, key=str)
    filled = gapless([(r.sequence_id, r.offset, r.length) for r in got], capacity)
    assert sorted(capacity - n for n in filled.values()) == one_by_one([w[3] for w in want], capacity)


def test_empty_table_and_equal_rows(spark, documents, scratch):
    assert p.pack(documents([]), PATH, 1).count() == 0
    same = documents([(1, "the same")] * 3000).repartition(4)
    got = p.pack(same, PATH, 1, 64).collect()
    filled = gapless([(r.sequence_id, r.offset, r.length) for r in got], 64)
    assert len(filled) == -(-3000 // (64 // got[0].length))
