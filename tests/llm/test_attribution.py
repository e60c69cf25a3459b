import numpy as np
import pytest

from lodestrata.llm import attribution as a

public = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
RANKS = public.path("byte_bpe_50k.tiktoken")

TEXTS = [
    (1, "one line"), (2, "a\nb\n"), (3, "\n\n\n  x\n\n y"), (4, None), (5, ""), (6, "\n"), (7, "é日本\n😀😀\n\n\nend"),
    (8, "word " * 500 + "\n" + "x" * 300), (2, "a\nb\n"),
]


def brute(text, rule):
    own, lengths = a.encoding(RANKS, public.PATTERN)
    if not text:
        return [(0, 0, 0.0, 0)]
    lines = text.splitlines(True) if "\r" not in text else None
    bounds, at = [], 0
    for line in lines:
        bounds.append((at, at + len(line.encode())))
        at = bounds[-1][1]
    counts, crossing = [0.0] * len(lines), [0] * len(lines)
    begin = 0
    for token in own.encode_ordinary(text):
        end = begin + int(lengths[token])
        part = {k: min(e, end) - max(b, begin) for k, (b, e) in enumerate(bounds) if b < end and e > begin}
        if len(part) > 1:
            for k in part:
                crossing[k] += 1
        if rule == "start":
            counts[min(part)] += 1
        elif rule == "most":
            counts[max(part, key=lambda k: (part[k], -k))] += 1
        else:
            for k, n in part.items():
                counts[k] += n / (end - begin)
        begin = end
    out, at = [], 0
    for line, c, x in zip(lines, counts, crossing):
        out.append((at, at + len(line), c, x))
        at += len(line)
    return out


@pytest.mark.parametrize("rule", a.RULES)
def test_lines_against_brute_force(documents, rule):
    found = a.sections(documents(TEXTS), RANKS, public.PATTERN, rule).collect()
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append((r.section, r.start, r.stop, r.n_tokens, r.n_crossing))
    for doc_id, text in TEXTS[:-1]:
        want = [(k, *row) for k, row in enumerate(brute(text, rule))]
        got = sorted(by[doc_id])
        if doc_id == 2:
            assert got == sorted(want * 2)
        else:
            assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
            assert np.allclose([g[3] for g in got], [w[3] for w in want])
    assert any(r.n_crossing for r in found)


def test_counts_add_up(documents, prose):
    own, _ = a.encoding(RANKS, public.PATTERN)
    text = prose(200, 1).replace("0", "\n")
    for rule in a.RULES:
        rows = a.sections(documents([(1, text)]), lambda: RANKS, public.PATTERN, rule).collect()
        assert sum(r.n_tokens for r in rows) == pytest.approx(len(own.encode_ordinary(text)))
        assert rows[-1].stop == len(text)


def test_fields(spark):
    rows = spark.createDataFrame([(1, "user", "Hello there"), (2, None, "x"), (3, "", None)], "id long, role string, text string")
    found = {r.id: r.tokens for r in a.fields(rows, ["role", "text"], RANKS, public.PATTERN, keep=["id"]).collect()}
    own, _ = a.encoding(RANKS, public.PATTERN)
    assert sum(found[1]) == len(own.encode_ordinary("user\nHello there"))
    assert len(found[2]) == 2 and sum(found[3]) == len(own.encode_ordinary("\n"))


def test_edges(documents):
    assert a.sections(documents([]), RANKS, public.PATTERN).count() == 0
    with pytest.raises(ValueError):
        a.sections(documents([]), RANKS, public.PATTERN, "last")
