"""Benchmark decontamination by Wu-Manber search for windows of test items.

A window is ten consecutive words of an item, or the whole of a shorter item.  Words
are runs of characters other than ASCII non-alphanumerics, after A-Z are lower-cased;
documents and windows are compared as words joined by single blanks, so a window
occurs exactly where its words do.

The search moves over the bytes of a document.  The last ``block`` bytes under the
search window select a shift; a block that ends at position q of some pattern's head
allows a shift of head - q, one that occurs in none allows head - block + 1.  Where the
shift is nought, the bucket of the block, split by the pattern's length and bytes at its
ends and middle, selects the patterns to compare in full.  Patterns of different lengths in
words go into tables of their own, so one short item does not shorten the shifts of all.

Items are one buffer of bytes and windows are places in it, so tables take a few times
the items' bytes.  A slice of texts is searched by many cursors that move in step, each over
a stretch of its own.

Items travel to the tasks in shards of at most ``shard_bytes``, a pass over the texts for
each, so a task holds the tables of one shard and a benchmark of any size is searched whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import map_texts, stored

#: Word characters after lower-casing; fixed values of the contract.
_DROP = bytes(
    c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20 for c in range(256)
)
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)).translate(_DROP)

WINDOW = 10
SHARD_BYTES = 16 << 20
#: Block positions entered into a shift table at a time.
_PART = 1 << 20
_U = np.uint64
_SPREAD = _U(0x9E3779B97F4A7C15)
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class Words:
    """Texts as bytes, each a blank, its words with blanks between, and a blank, and line
    breaks between texts."""

    def __init__(self, texts: list[str | None]):
        raw = b" \n ".join(t.encode().translate(_LOWER) if t else b"" for t in texts)
        raw = np.frombuffer(b" " + raw + b" ", np.uint8)
        blank = raw == 32
        kept = raw[~(blank & np.append(False, blank[:-1]))]
        self.length = len(kept)
        self.bytes = np.append(kept, np.zeros(8, np.uint8))
        #: The eight bytes from each place on.
        self.eight = np.ndarray((len(kept) + 1,), "<u8", self.bytes.data, strides=(1,))
        self.blanks = np.flatnonzero(kept == 32)
        begins = np.append(0, np.flatnonzero(kept == 10) + 1)
        self.first = np.searchsorted(self.blanks, begins)  # the blank before each text
        self.counts = np.diff(np.append(self.first, len(self.blanks))) - 1

    def word(self, at: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        """``size`` (at most eight) bytes from ``at`` on, as a number."""
        return self.eight[at] & _MASKS[size]


def same(a: Words, i: np.ndarray, b: Words, j: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ``size`` bytes from i and from j on are equal."""
    equal = np.ones(len(i), bool)
    live, step = np.arange(len(i)), 0
    while len(live):
        wide = np.minimum(size[live], 8)
        off = np.minimum(step, size[live] - wide)
        ok = a.word(i[live] + off, wide) == b.word(j[live] + off, wide)
        equal[live[~ok]] = False
        step += 8
        live = live[ok]
        live = live[size[live] > step]
    return equal


def ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each ``count``, one after another."""
    return np.repeat(begin - np.cumsum(count) + count, count) + np.arange(int(count.sum()))


class WuManber:
    """Patterns of ``n`` words: from the blanks ``k`` of ``text`` on, with their owners."""

    def __init__(self, text: Words, k: np.ndarray, owner: np.ndarray, n: int):
        self.n, self.text = n, text
        at = text.blanks[k]
        size = text.blanks[k + n] - at + 1
        self.head = head = int(size.min())
        # Blocks long enough that few of a text's blocks occur in some pattern.
        positions = min(text.length, len(at) * head)
        self.block = block = min(8, head, max(2, math.ceil(math.log(2 * positions, 8))))
        self.right = _U(64 - min(27, max(10, (4 * positions).bit_length())))
        # Shorter shifts than possible miss nothing.
        far = head - block + 1
        self.shift = np.full(1 << (64 - int(self.right)), min(far, 255), np.uint8)
        ends = np.unique(at) + head
        for low in range(int(ends[0]) - far + 1, int(ends[-1]) + 1, _PART):
            end = np.arange(low, min(low + _PART, int(ends[-1]) + 1))
            left = ends[np.searchsorted(ends, end)] - end
            inside = left < min(far, 255)
            np.minimum.at(
                self.shift, self.slot(text, end[inside] - block), left[inside].astype(np.uint8)
            )
        self._fill(at, size, owner)

    def slot(self, text: Words, at: np.ndarray) -> np.ndarray:
        return (text.word(at, self.block) * _SPREAD) >> self.right

    def bucket(self, text: Words, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Hash of the block at the head's end, of length, ends and middle."""
        key = text.word(at + (self.head - self.block), self.block)
        wide = np.minimum(size, 8)
        for off in (0, (size - wide) // 2, size - wide):
            key = (key ^ (key >> _U(29))) * _SPREAD + text.word(at + off, wide)
        return (key ^ (key >> _U(32)) ^ size.astype(np.uint64)) * _SPREAD

    def _fill(self, at: np.ndarray, size: np.ndarray, owner: np.ndarray) -> None:
        """Distinct patterns in order of their buckets, and the owners of each."""
        key = self.bucket(self.text, at, size)
        rest = np.argsort(key, kind="stable")
        firsts, pairs = [], []
        while len(rest):
            # Patterns equal to the first of their bucket; the others come again.
            opens = np.append(True, key[rest[1:]] != key[rest[:-1]])
            first = rest[opens][np.cumsum(opens) - 1]
            equal = size[first] == size[rest]
            equal[equal] = same(self.text, at[first[equal]], self.text, at[rest[equal]], size[rest[equal]])
            firsts.append(rest[opens])
            pairs.append((first[equal], owner[rest[equal]]))
            rest = rest[~equal]
        chosen = np.concatenate(firsts)
        chosen = chosen[np.argsort(key[chosen], kind="stable")]
        self.keys, self.at, self.size = key[chosen], at[chosen], size[chosen]
        number = np.empty(len(at), np.int64)
        number[chosen] = np.arange(len(chosen))
        pattern, owner = (np.concatenate(c) for c in zip(*pairs))
        order = np.lexsort((owner, number[pattern]))
        pattern, owner = number[pattern][order], owner[order]
        new = np.append(True, (pattern[1:] != pattern[:-1]) | (owner[1:] != owner[:-1]))
        self.owners = owner[new]
        self.begin = np.searchsorted(pattern[new], np.arange(len(chosen) + 1))

    def candidates(self, text: Words) -> np.ndarray:
        """Places where the shift is nought."""
        last = text.length - self.head + 1
        if last <= 0:
            return np.zeros(0, np.int64)
        stretch = max(256, last >> 11)
        at = np.arange(0, last, stretch)
        stop = np.minimum(at + stretch, last)
        found = []
        while len(at):
            step = self.shift[self.slot(text, at + (self.head - self.block))]
            hit = step == 0
            if hit.any():
                found.append(at[hit])
            at = at + np.maximum(step, 1)
            live = at < stop
            if not live.all():
                at, stop = at[live], stop[live]
        return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)

    def search(self, text: Words) -> tuple[np.ndarray, np.ndarray]:
        """Blanks that occurrences begin with, and their patterns."""
        at = self.candidates(text)
        at = at[text.bytes[at] == 32]
        k = np.searchsorted(text.blanks, at)
        inside = k + self.n < len(text.blanks)
        at, k = at[inside], k[inside]
        size = text.blanks[k + self.n] - at + 1
        able = size >= self.head
        at, k, size = at[able], k[able], size[able]
        key = self.bucket(text, at, size)
        low = np.searchsorted(self.keys, key)
        count = np.searchsorted(self.keys, key, "right") - low
        pattern, which = ranges(low, count), np.repeat(np.arange(len(k)), count)
        alike = self.size[pattern] == size[which]
        pattern, which = pattern[alike], which[alike]
        equal = same(text, at[which], self.text, self.at[pattern], size[which])
        return k[which[equal]], pattern[equal]


class Searcher:
    """One table for each number of words."""

    def __init__(self, items: list[tuple[str, str]], size: int):
        self.names = [name for name, _ in items]
        text = Words([t for _, t in items])
        wide = np.minimum(text.counts, size)
        count = np.where(wide > 0, text.counts - wide + 1, 0)
        k, owner = ranges(text.first, count), np.repeat(np.arange(len(count)), count)
        wide = np.repeat(wide, count)
        self.tables = [
            WuManber(text, k[wide == n], owner[wide == n], n) for n in np.unique(wide).tolist()
        ]

    def spans(self, texts: list[str | None]) -> tuple[list[int], list, list]:
        """Of each text the number of words, the hit spans [start, stop) united, and the
        items found, sorted."""
        text = Words(texts)
        spans: list[list] = [[] for _ in texts]
        items: list[set] = [set() for _ in texts]
        for table in self.tables:
            k, pattern = table.search(text)
            row = np.searchsorted(text.first, k, "right") - 1
            start = k - text.first[row]
            for r, a in zip(row.tolist(), start.tolist()):
                spans[r].append((a, a + table.n))
            # A pattern's owners once for each text.
            for r, p in np.unique(np.stack([row, pattern], 1), axis=0).tolist():
                items[r].update(table.owners[table.begin[p] : table.begin[p + 1]].tolist())
        names = [sorted({self.names[i] for i in found}) for found in items]
        return text.counts.tolist(), [united(s) if s else [] for s in spans], names


def united(spans: list) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted((s[0], s[1]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


_FOUND = [
    ("n_words", pa.int64()),
    ("spans", pa.list_(pa.list_(pa.int32()))),
    ("items", pa.list_(pa.string())),
]


def shards_of(items: DataFrame, item_id: str, text: str, shard_bytes: int) -> list[DataFrame]:
    """Items (id, text) in parts of about ``shard_bytes``."""
    kept = items.select(
        F.col(f"`{item_id}`").cast("string").alias("id"), F.col(f"`{text}`").alias("text")
    ).where("id IS NOT NULL AND text IS NOT NULL")
    size = kept.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / shard_bytes))
    if n == 1:
        return [kept]
    dealt = kept.withColumn("shard", F.pmod(F.xxhash64("id", "text"), F.lit(n)))
    return [dealt.where(F.col("shard") == i).select("id", "text") for i in range(n)]


def find_items(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Per row of ``docs``: doc_id, ``n_words``, ``spans`` of hit words [start, stop) in
    order and apart, and ``items`` (ids as strings, sorted, distinct) that occur.

    Null or empty texts, and texts without words, have no words and no spans.  Items
    without words or with a null id or text never occur.  Repeated document rows are
    searched each on its own; repeated items count once.  An empty benchmark gives
    rows without spans.  Other columns are left out, whatever their names.
    """
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    shards = shards_of(items, item_id, item_text, shard_bytes)
    if len(shards) == 1:
        return _search(source, "text", shards[0], window, ["doc_id"])
    # What the first shard finds in every row, and what the others find in texts.
    source = source.withColumn("text", F.col("text").cast("string"))
    digest = F.sha2("text", 256).alias("digest")
    first = _search(source.select("doc_id", "text", digest), "text", shards[0], window, ["doc_id", "digest"])
    more = _hits(source.select("text", digest), shards[1:], window).groupBy("digest").agg(
        F.flatten(F.collect_list("spans")).alias("more_spans"),
        F.flatten(F.collect_list("items")).alias("more_items"),
    )
    none = F.array()
    both = stored(first, "found").join(more, "digest", "left").select(
        "doc_id",
        "n_words",
        F.concat("spans", F.coalesce("more_spans", none.cast("array<array<int>>"))).alias("spans"),
        F.concat("items", F.coalesce("more_items", none.cast("array<string>"))).alias("items"),
    )
    return both.mapInArrow(_unite, both.schema)


def _hits(docs: DataFrame, shards: list[DataFrame], window: int) -> DataFrame:
    """(digest, spans, items) of the texts of ``docs`` (text, digest) in which a shard finds
    something, one row for each text and shard; a stored table for each shard, so that only
    one is at the driver and in a task at a time."""
    parts = []
    for shard in shards:
        found = _search(docs, "text", shard, window, ["digest"]).where(F.size("spans") > 0)
        parts.append(stored(found.select("digest", "spans", "items").dropDuplicates(["digest"]), "hits"))
    return reduce(DataFrame.unionByName, parts)


def _unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = [united(s) for s in batch.column(2).to_pylist()]
        items = [sorted(set(i)) for i in batch.column(3).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(spans, _FOUND[1][1]),
                pa.array(items, _FOUND[2][1]),
            ],
            names=batch.schema.names,
        )


def _search(
    docs: DataFrame,
    text: str,
    items: DataFrame,
    window: int,
    keep: list[str] | None = None,
    prefix: str = "",
) -> DataFrame:
    """``items`` is one shard: its size is bounded by ``shard_bytes`` and one item."""
    rows = [(r[0], r[1]) for r in items.distinct().collect()]
    shared = docs.sparkSession.sparkContext.broadcast(rows)

    def make():
        searcher = Searcher(shared.value, window)
        return lambda texts: list(searcher.spans(texts))

    return map_texts(docs, text, [(prefix + n, kind) for n, kind in _FOUND], make, keep)


def report(found: DataFrame) -> DataFrame:
    """Digest columns of ``find_items``."""
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s[1] - s[0]).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def clean_documents(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Rows of ``docs`` without any occurrence, columns unchanged, in one pass for each
    shard of items.  One shard takes no shuffle; with more, the texts that hold something are
    found first.  Nulls and empty texts stay."""
    shards = shards_of(items, item_id, item_text, shard_bytes)
    if len(shards) == 1:
        found = _search(docs, text, shards[0], window, None, "__found_")
        return found.where(F.size("__found_spans") == 0).select(*docs.columns)
    digest = F.sha2(F.col(f"`{text}`").cast("string"), 256)
    texts = docs.select(F.col(f"`{text}`").cast("string").alias("text"), digest.alias("digest"))
    hits = _hits(texts, shards, window).select(F.col("digest").alias("__digest")).distinct()
    marked = docs.withColumn("__key", digest)
    kept = marked.join(hits, F.col("__key") == F.col("__digest"), "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
