import hashlib
import random
import re

from lodestrata.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, size=10):
    out = {}
    for doc_id, text in docs:
        words = WORD.findall((text or "").translate(UPPER))
        hit, names = set(), set()
        for item_id, item in items:
            own = WORD.findall((item or "").translate(UPPER)) if item_id is not None else []
            n = min(size, len(own))
            for i in range(len(own) - n + 1 if own else 0):
                for j in range(len(words) - n + 1):
                    if words[j : j + n] == own[i : i + n]:
                        hit |= set(range(j, j + n))
                        names.add(str(item_id))
        ids = ",".join(sorted(names))
        out[doc_id] = (len(words), len(hit), len(names), hashlib.sha256(ids.encode()).hexdigest(), bool(hit))
    return out


def cases(prose):
    items = [(i, prose(25, 100 + i)) for i in range(12)]
    items += [(20, "Tiny item"), (21, "solo"), (22, "..."), (23, None), (None, "never named"), (24, items[0][1]), (10, "Tiny item")]
    docs = [(i, prose(60, i)) for i in range(20)]
    docs += [
        (30, prose(9, 30) + " " + items[0][1] + " " + prose(9, 31)),
        (31, items[3][1].upper().replace(" ", " -- ")),
        (32, " ".join(items[4][1].split()[:9])),
        (33, " ".join(items[4][1].split()[5:15]) + "."),
        (34, None), (35, ""), (36, " ?! "), (37, "a TINY, item; solo"), (38, "é" + items[5][1] + "é"),
        (39, prose(3000, 7) + " " + items[6][1]), (40, items[7][1] + " " + items[7][1]),
        (41, "tiny-item tiny item itemtiny"),
    ]
    return docs, items


def run(spark, documents, docs, items, **options):
    rows = d.report(d.find_items(documents(docs), spark.createDataFrame(items, "item_id long, text string"), **options))
    return {r[0]: tuple(r[1:]) for r in rows.collect()}


def test_against_brute_force(spark, documents, prose):
    docs, items = cases(prose)
    want = brute(docs, items)
    assert run(spark, documents, docs, items) == want
    assert sum(v[4] for v in want.values()) >= 8


def test_shards_change_nothing(spark, documents, prose):
    docs, items = cases(prose)
    assert run(spark, documents, docs, items, shard_bytes=300) == brute(docs, items)


def test_clean_documents(spark, documents, prose):
    docs, items = cases(prose)
    hit = {k for k, v in brute(docs, items).items() if v[4]}
    own = documents(docs + [docs[0]])
    table = spark.createDataFrame(items, "item_id long, text string")
    for shard_bytes in (d.SHARD_BYTES, 300):
        kept = d.clean_documents(own, table, shard_bytes=shard_bytes)
        assert kept.columns == own.columns
        ids = [r.doc_id for r in kept.collect()]
        assert sorted(ids) == sorted([i for i, _ in docs if i not in hit] + [docs[0][0]])


def test_empty_tables(spark, documents, prose):
    none = spark.createDataFrame([], "item_id long, text string")
    assert not run(spark, documents, [(1, prose(20, 1))], [(1, None)])[1][4]
    assert d.report(d.find_items(documents([(1, "a b")]), none)).first().contaminated is False
    assert d.report(d.find_items(documents([]), none)).count() == 0


def test_search_of_many_small_items():
    voc = ["a", "ab", "b", "ba", "abab", "é", "Zoo"]
    for seed in range(60):
        r = random.Random(seed)
        items = [(str(i), " ".join(r.choices(voc, k=r.randint(0, 6)))) for i in range(r.randint(1, 12))]
        docs = [" ".join(r.choices(voc, k=r.randint(0, 60))) for _ in range(4)] + [None, ""]
        size = r.choice([1, 2, 3, 10])
        n_words, spans, names = d.Searcher(items, size).spans(docs)
        want = brute(enumerate(docs), items, size)
        for i in range(len(docs)):
            hit = sum(b - a for a, b in spans[i])
            ids = hashlib.sha256(",".join(names[i]).encode()).hexdigest()
            assert (n_words[i], hit, len(names[i]), ids, hit > 0) == want[i], (seed, i)


def test_windows_that_share_length_ends_and_middle():
    # Equal in the bytes that select a bucket, different between them.
    items = [(str(i), f"abcdefgh{c * 9}ijklmnop{e * 9}qrstuvwx") for i, (c, e) in enumerate(["yy", "yz", "zy", "yy"])]
    table = d.Searcher(items, 10).tables[0]
    assert len(set(table.keys.tolist())) == 1 and len(table.keys) == 3
    texts = [items[0][1] + " " + items[2][1], items[1][1], "abcdefgh" + "y" * 9 + "ijklmnop" + "x" * 9 + "qrstuvwx"]
    assert d.Searcher(items, 10).spans(texts)[2] == [["0", "2", "3"], ["1"], []]


def test_tables_of_a_shard_are_a_few_times_its_bytes():
    r = random.Random(1)
    voc = ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 9))) for _ in range(5000)]
    items = [(str(i), " ".join(r.choices(voc, k=60))) for i in range(3000)]
    table = d.Searcher(items, 10).tables[0]
    arrays = [table.shift, table.keys, table.at, table.size, table.begin, table.owners,
              table.text.bytes, table.text.blanks]
    assert sum(a.nbytes for a in arrays) < 16 * sum(len(t) for _, t in items)


def test_one_very_long_text(prose):
    item = prose(25, 5)
    text = prose(200_000, 8) + " " + item
    n_words, spans, names = d.Searcher([("x", item)], 10).spans([text, item])
    assert n_words == [200_025, 25] and spans == [[[200_000, 200_025]], [[0, 25]]] and names == [["x"], ["x"]]


def test_repeated_rows_and_shards(spark, documents, prose):
    docs, items = cases(prose)
    table = spark.createDataFrame(items, "item_id long, text string")
    twice = d.report(d.find_items(documents(docs + docs + [(None, docs[20][1])]), table, shard_bytes=300))
    rows = [tuple(r[:6]) for r in twice.collect()]
    want = [(k, *v) for k, v in brute(docs, items).items()]
    want += want + [(None, *brute(docs, items)[docs[20][0]])]
    assert sorted(rows, key=repr) == sorted(want, key=repr)
