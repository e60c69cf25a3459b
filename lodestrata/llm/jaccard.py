"""N-gram Jaccard join by parity sketches: documents whose sets of word shingles have a
similarity of at least ``threshold``, as components of the links.

Sketch.  Every shingle toggles one bit of a sketch, so two sketches differ in at most as
many bits as the sets differ in shingles (their Hamming distance is a lower bound of the
symmetric difference).  At similarity 4/5, sets of x <= y shingles have y <= 5x/4 and
differ in at most (x + y)/9 <= x/4 shingles.

Pigeonhole.  A size band holds sets of 2^j up to 5/2 2^j shingles (a set at the bottom of
one is in the band below too, so two similar sets always share a band).  In a band the sketch is
cut into blocks, kept sparse: a block is the XOR of the codes of its toggled bits.  With
at most k = x/4 differing blocks, the first k + 1 non-empty blocks of two similar sets, in any
order that is the same for all sets, have one in common: the first that they share (prefix
filter).  The order is rare blocks first, by a table of how many sets hold a block, counted over
all of them in ``COUNTERS`` hashed counters and kept as powers of two; so a line that very
many documents hold brings few of them together.  Sets with no more than k non-empty blocks
send all their blocks, empty ones too.

Groups.  Equal sets are one node from the start.  Nodes that share a block are linked to the
group's smallest node, the one they share most blocks with first, and those pairs are verified
on the whole sets.  What remains are groups with several components: their nodes of different
components are compared by dense sketches, in squares of at most ``CHUNK`` by ``CHUNK``, and
pairs under the bound are verified too, first a forest of the nearest ones, again while that
brings links, then all that are still apart.  So of a group of copies about as many pairs
are verified as it has members, and no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import list_array, map_texts, stored

WORDS = 5
PERCENT = 80
CHUNK = 2048
#: Tables of links and nodes of up to so many rows (16 bytes each) are broadcast or handled
#: in one task; larger ones are shuffled.
SMALL = 200_000
#: Counters of blocks; a block stands out where it is in more sets than others fall on one.
COUNTERS = 1 << 20
_U = np.uint64
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)
_BASE = _U(0x9E3779B97F4A7C15)
_STEP = _U(0xD6E8FEB86659FD93)


# --- sets -------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64 bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    split = [t.encode("utf-8", "surrogatepass").lower().split() if t else [] for t in texts]
    flat = [w for s in split for w in s]
    if not flat:
        return [np.zeros(0, np.uint64)] * len(texts)
    codes = np.frombuffer(b"".join(flat), np.uint8)
    length = np.fromiter(map(len, flat), np.int64, len(flat))
    begin = np.cumsum(length) - length
    place = np.arange(len(codes)) - np.repeat(begin, length)
    powers = np.full(int(length.max()), _BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    hashed = mix(np.add.reduceat(_BYTE[codes] * powers[place], begin) + length.astype(np.uint64))
    rolled = hashed.copy()
    for j in range(1, words):
        rolled[: len(rolled) - j] = rolled[: len(rolled) - j] * _STEP + hashed[j:]
    out, at = [], 0
    for s in split:
        n = len(s)
        if n >= words:
            out.append(np.unique(mix(rolled[at : at + n - words + 1])))
        elif n:
            one = np.array([n], np.uint64)
            for i in range(at, at + n):
                one = one * _STEP + hashed[i : i + 1]
            out.append(mix(one ^ _BASE))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def node_of(own: np.ndarray) -> int:
    """One number for a set."""
    return int(mix(mix(own ^ _BASE).sum(keepdims=True) + _U(len(own))).view(np.int64)[0])


# --- block keys --------------------------------------------------------------------


def bands_of(n: int) -> list[int]:
    j = n.bit_length() - 1
    return [j, j - 1] if j and 4 * n < 5 << j else [j]


def blocks_in(band: int) -> int:
    top = 5 << band >> 1
    return 2 * top if top <= 20 else -(-35 * top // 100)


def block_keys(own: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Keys of a set's non-empty blocks, and how many each band has.  Where a band has no
    more than k of them, those of its empty blocks follow, and the number is negative.  Sets
    of up to three shingles have no similar set but themselves."""
    n = len(own)
    if n < 4:
        return np.zeros(0, np.uint64), []
    codes = mix(own + _BASE)
    keys, counts = [], []
    for band in bands_of(n):
        blocks = blocks_in(band)
        block = (own >> _U(17)) % _U(blocks)
        order = np.argsort(block, kind="stable")
        sorted_ = block[order]
        begin = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
        numbers, values = sorted_[begin], np.bitwise_xor.reduceat(codes[order], begin)
        counts.append(len(numbers))
        if len(numbers) <= n // 4:
            empty = np.setdiff1d(np.arange(blocks, dtype=np.uint64), numbers)
            numbers = np.append(numbers, empty)
            values = np.append(values, np.zeros(len(empty), np.uint64))
            counts[-1] = -blocks
        keys.append(mix(values ^ mix(numbers + _U(band << 40))))
    return np.concatenate(keys), counts


def counter_of(keys: np.ndarray) -> np.ndarray:
    return (keys.view(np.uint64) >> _U(11)).astype(np.int64) & (COUNTERS - 1)


def rarest(keys: np.ndarray, counts: np.ndarray, sizes: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Places of the keys to send: of every run of ``counts`` keys, of a set of ``sizes``
    shingles, the k + 1 of the lowest class, ties by key; of negative counts all."""
    run = np.repeat(np.arange(len(counts)), np.abs(counts))
    order = np.lexsort((keys, classes[counter_of(keys)], run))
    begin = np.cumsum(np.abs(counts)) - np.abs(counts)
    rank = np.arange(len(keys)) - np.repeat(begin, np.abs(counts))
    limit = np.where(counts < 0, -counts, sizes // 4 + 1)
    return order[rank < np.repeat(limit, np.abs(counts))]


# --- dense sketches ----------------------------------------------------------------


def sketch_of(own: np.ndarray) -> np.ndarray:
    """Parity bits as 64-bit words: a power of two, about two bits for a shingle."""
    words = 1 << max(0, min(10, (len(own) // 32).bit_length()))
    bit = own % _U(64 * words)
    counts = np.bincount(bit.astype(np.int64), minlength=64 * words) & 1
    return np.packbits(counts.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    while len(sketch) > words:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def near_pairs(left: tuple, right: tuple, same: bool, every: bool) -> tuple[np.ndarray, np.ndarray]:
    """Of rows of ``left`` and ``right`` (nodes, components, sizes, sketches), the pairs of
    different components whose sketches do not rule out a similarity of 4/5: every one,
    or the nearest that hold the same components together."""
    width = min(map(len, [*left[3], *right[3]]))
    a = np.array([folded(s, width) for s in left[3]])
    b = np.array([folded(s, width) for s in right[3]])
    found = []
    rows = max(1, (4 << 20) // max(1, b.size))
    for at in range(0, len(a), rows):
        part = slice(at, at + rows)
        x, y = left[2][part, None], right[2][None]
        able = (4 * x <= 5 * y) & (4 * y <= 5 * x) & (left[1][part, None] != right[1][None])
        if same:
            able &= np.arange(at, at + len(x))[:, None] < np.arange(len(b))[None]
        i, j = np.nonzero(able)
        distance = np.bitwise_count(a[part][i] ^ b[j]).sum(1, dtype=np.int64)
        near = 9 * distance <= left[2][part][i] + right[2][j]
        found.append((i[near] + at, j[near], distance[near]))
    i, j, distance = (np.concatenate(c) for c in zip(*found))
    if not every and len(i):
        keep = forest(left[1][i], right[1][j], distance)
        i, j = i[keep], j[keep]
    return left[0][i], right[0][j]


def forest(a: np.ndarray, b: np.ndarray, distance: np.ndarray) -> np.ndarray:
    """Places of pairs that join the same components as all pairs do, at most one for each
    component but one: in turns, every component takes its nearest pair."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = ends[: len(a)], ends[len(a) :]
    label = np.arange(len(names))
    rank = np.empty(len(a), np.int64)
    rank[np.argsort(distance, kind="stable")] = np.arange(len(a))
    open_, chosen = np.arange(len(a)), []
    while True:
        open_ = open_[label[u[open_]] != label[v[open_]]]
        if not len(open_):
            return np.unique(np.array(chosen, np.int64))
        best = np.full(len(names), len(a), np.int64)
        np.minimum.at(best, label[u[open_]], rank[open_])
        np.minimum.at(best, label[v[open_]], rank[open_])
        taken = open_[np.isin(rank[open_], best)]
        chosen += taken.tolist()
        for x, y in zip(label[u[taken]].tolist(), label[v[taken]].tolist()):
            x, y = label[x], label[y]
            while label[x] != x:
                x = label[x]
            while label[y] != y:
                y = label[y]
            label[max(x, y)] = min(x, y)
        while (label[label] != label).any():
            label = label[label]


# --- the join ----------------------------------------------------------------------


def _documents(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, n_shingles, node, block keys with their number in each band, and dense sketch
    of every row; null node for an empty set."""

    def make():
        def work(texts: list[str | None]) -> list:
            sets = shingle_sets(texts)
            return [
                [len(s) for s in sets],
                [node_of(s) if len(s) else None for s in sets],
                *_keys_once(sets),
                [sketch_of(s).tobytes() if len(s) else None for s in sets],
            ]

        seen: set[int] = set()

        def _keys_once(sets: list[np.ndarray]) -> tuple[pa.Array, list[list[int]]]:
            # A task sends the keys of equal sets once.
            keys, counts = [], []
            for s in sets:
                node = node_of(s) if len(s) else None
                own, bands = block_keys(s if node not in seen else s[:0])
                keys.append(own)
                counts.append(bands)
                seen.add(node)
            sizes = np.fromiter(map(len, keys), np.int64, len(keys))
            return list_array(np.concatenate(keys).view(np.int64), sizes), counts

        return work

    schema = [("n_shingles", pa.int64()), ("node", pa.int64()), ("keys", pa.list_(pa.int64())),
              ("bands", pa.list_(pa.int32())), ("sketch", pa.binary())]
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_texts(source, "text", schema, make, ["doc_id"])


def _classes(keyed: DataFrame) -> np.ndarray:
    """Of each counter, the power of two of how many sets it counts.  The driver takes
    one number of at most ``COUNTERS``, whatever the number of sets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            keys = batch.column(0).flatten().to_numpy()
            total += np.bincount(counter_of(keys), minlength=COUNTERS)
        used = np.flatnonzero(total)
        for at in range(0, len(used), 1 << 16):
            part = used[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["counter", "n"])

    counted = keyed.select("keys").mapInArrow(count, "counter bigint, n bigint")
    whole = counted.groupBy("counter").agg(F.sum("n").alias("n"))
    # A block of one set, as most are, is of class 0 like one that is not counted.
    power = F.floor(F.log2("n")).cast("int").alias("power")
    found = whole.select("counter", power).where("power > 0").toArrow()
    classes = np.zeros(COUNTERS, np.uint8)
    classes[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return classes


def _sent(keyed: DataFrame, classes: np.ndarray) -> DataFrame:
    """(key, node) of the rarest blocks of each set."""
    shared = keyed.sparkSession.sparkContext.broadcast(classes)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 500) for b in batches for at in range(0, len(b), 500)):
            keys, bands = batch.column(2).flatten().to_numpy(), batch.column(3)
            of = np.repeat(np.arange(len(bands)), np.diff(bands.offsets.to_numpy()))
            counts = bands.flatten().to_numpy().astype(np.int64)
            places = rarest(keys, counts, batch.column(1).to_numpy()[of], shared.value)
            node = np.repeat(batch.column(0).to_numpy()[of], np.abs(counts))
            yield pa.RecordBatch.from_arrays([pa.array(keys[places]), pa.array(node[places])], ["key", "node"])

    return keyed.select("node", "n_shingles", "keys", "bands").mapInArrow(pick, "key bigint, node bigint")


def _shared_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node) in order to (key, node, rep): nodes that share the key with a smaller
    node, the smallest of the key as ``rep``.  Holds one batch and one row."""
    last_key = last_node = rep = None
    for batch in batches:
        key = batch.column(0).to_numpy()
        node = batch.column(1).to_numpy()
        if not len(key):
            continue
        opens = np.append(key[0] != last_key, key[1:] != key[:-1])
        fresh = np.append(opens[0] or node[0] != last_node, (node[1:] != node[:-1]) | opens[1:])
        start = np.maximum.accumulate(np.where(opens, np.arange(len(key)), -1))
        reps = np.where(start >= 0, node[np.maximum(start, 0)], rep if rep is not None else 0)
        live = fresh & (node != reps)
        last_key, last_node, rep = key[-1], node[-1], reps[-1]
        if live.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[live]), pa.array(node[live]), pa.array(reps[live])],
                ["key", "node", "rep"],
            )


def _sets(docs: DataFrame, chosen: DataFrame, doc_id: str, text: str) -> DataFrame:
    """node, n and shingles of the documents in ``chosen`` (doc_id, node)."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    wanted = source.join(chosen, "doc_id")

    def make():
        def work(texts: list[str | None]) -> list:
            sets = shingle_sets(texts)
            sizes = np.fromiter(map(len, sets), np.int64, len(sets))
            return [
                pa.array(sizes),
                [node_of(s) if len(s) else None for s in sets],
                list_array(np.concatenate(sets).view(np.int64), sizes),
            ]

        return work

    schema = [("n", pa.int64()), ("own", pa.int64()), ("shingles", pa.list_(pa.int64()))]
    made = map_texts(wanted, "text", schema, make, ["node"])
    # An id that occurs twice may bring another text.
    return made.where("node = own").drop("own").dropDuplicates(["node"])


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, na, nb, sa, sb) whose sketches do not rule out a similarity of 4/5."""
    for batch in batches:
        keep = []
        columns = [batch.column(i).to_pylist() for i in range(2, 6)]
        for x, y, s, t in zip(*columns):
            near = 4 * x <= 5 * y and 4 * y <= 5 * x
            if near:
                s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                width = min(len(s), len(t))
                distance = np.bitwise_count(folded(s, width) ^ folded(t, width)).sum(dtype=np.int64)
                near = 9 * int(distance) <= x + y
            keep.append(near)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def allowed(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Of pairs (a, b), those whose sizes and sketches allow a link."""
    def side(c: str) -> DataFrame:
        return sketches.select(
            F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}")
        )

    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(_possible, "a bigint, b bigint")


def verified(
    pairs: DataFrame, docs: DataFrame, nodes: DataFrame, doc_id: str, text: str, percent: int
) -> DataFrame:
    """Pairs (a, b) with 100 * intersection >= percent * union; a stored table.

    Only the texts of the pairs' nodes are taken apart again."""
    few = 2 * pairs.count() <= SMALL
    used = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    chosen = nodes.join(F.broadcast(used) if few else used, "node")
    chosen = stored(chosen.select(F.col("first").alias("doc_id"), "node"), "chosen")
    sets = stored(_sets(docs, F.broadcast(chosen) if few else chosen, doc_id, text), "sets")

    def side(c: str) -> DataFrame:
        return sets.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("shingles").alias(f"s{c}"))

    common = F.size(F.array_intersect("sa", "sb")).cast("bigint")
    left = side("a").join(F.broadcast(pairs) if few else pairs, "a")
    both = left.join(side("b"), "b").select("a", "b", "na", "nb", common.alias("c"))
    return stored(both.where(F.expr(f"c * 100 >= (na + nb - c) * {int(percent)}")).select("a", "b"), "edges")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, of every node with an edge.

    Edges are turned into stars around smallest nodes, in rounds that grow with the
    logarithm of a component's width; every round is a written table."""
    links = stored(_oriented(edges), "links")
    before = None
    # Edges only get fewer.  In one task, grouping and joining them takes no exchange.
    few = links.count() <= SMALL
    while True:
        links = links.coalesce(1) if few else links
        state = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            ends = links.select(F.explode(F.array("a", "b")).alias("node"), F.col("b").alias("component"))
            return ends.distinct()
        before = state
        both = _both_ways(links)
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        wide = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        wide = _oriented(wide)
        least = wide.groupBy("a").agg(F.min("b").alias("m"))
        near = wide.join(least, "a")
        near = near.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        links = stored(_oriented(near), "links")


def _both_ways(links: DataFrame) -> DataFrame:
    """Every link from either end; a union would take an exchange where this takes none."""
    ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    return links.select(F.inline(ends))


def _oriented(edges: DataFrame) -> DataFrame:
    return (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _apart(members: DataFrame, found: DataFrame, sketches: DataFrame, every: bool) -> DataFrame:
    """(key, a, b): pairs of different components that share a block and that sketches
    allow, every one or those of a forest."""
    members = members.join(found, "node", "left").select(
        "key", "node", F.coalesce("component", "node").alias("component")
    )
    groups = members.groupBy("key").agg(
        F.count("*").alias("size"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("who"),
        F.sum(F.xxhash64("node", F.lit(1)).cast("decimal(38,0)")).alias("who_too"),
    )
    # Groups of one component are done; of groups with the same nodes one is enough.
    groups = groups.where("low <> high").groupBy("size", "who", "who_too").agg(F.min("key").alias("key"))
    chunks = F.ceil(F.col("size") / CHUNK).cast("int")
    dealt = (
        members.join(groups.select("key", chunks.alias("chunks")), "key")
        .join(sketches, "node")
        .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        # A chunk meets every chunk once: squares (i, j) with i <= j.
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .withColumn("i", F.least("chunk", "other"))
        .withColumn("j", F.greatest("chunk", "other"))
    )

    def compare(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        chunk = rows.column("chunk").to_numpy()
        i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
        parts = []
        for c in (i, j):
            at = np.flatnonzero(chunk == c)
            taken = rows.take(pa.array(at))
            parts.append(
                (
                    taken.column("node").to_numpy(),
                    taken.column("component").to_numpy(),
                    taken.column("n").to_numpy(),
                    [np.frombuffer(s, np.uint64) for s in taken.column("sketch").to_pylist()],
                )
            )
        if not len(parts[0][0]) or not len(parts[1][0]):
            a = b = np.zeros(0, np.int64)
        else:
            a, b = near_pairs(parts[0], parts[1], i == j, every)
        key = pa.array(np.full(len(a), rows.column("key")[0].as_py()), pa.int64())
        high, low = np.maximum(a, b), np.minimum(a, b)
        return pa.table({"key": key, "a": pa.array(high, pa.int64()), "b": pa.array(low, pa.int64())})

    return dealt.groupBy("key", "i", "j").applyInArrow(compare, "key bigint, a bigint, b bigint")


def join(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
) -> DataFrame:
    """Per row: doc_id, ``n_shingles`` and ``component_id``, the smallest doc_id
    reachable by links, its own included.

    Null and empty texts and texts without words have no shingles and no link; texts
    of fewer than five words have their whole sequence as the one shingle.  Equal sets link, so
    repeated rows do.  Rows with a null id link with nothing and have a null component.
    ``percent`` is 80 or more, as the bounds above are those of 80."""
    if percent < 80:
        raise ValueError("the bands and blocks hold for a similarity of 4/5 or more")
    rows = stored(_documents(docs.where(F.col(f"`{doc_id}`").isNotNull()), doc_id, text), "shingled")
    keyed = rows.where(F.size("keys") > 0)
    live = stored(
        _sent(keyed, _classes(keyed))
        .repartition("key")
        .sortWithinPartitions("key", "node")
        .mapInArrow(_shared_blocks, "key bigint, node bigint, rep bigint"),
        "blocks",
    )
    nodes = stored(
        rows.where("node IS NOT NULL").groupBy("node").agg(
            F.min("doc_id").alias("first"), F.count("*").alias("copies")
        ),
        "nodes",
    )
    members = live.select("key", "node").unionByName(live.select("key", F.col("rep").alias("node")))
    members = stored(members.distinct(), "members")
    alive = members.select("node").distinct()
    sketches = stored(
        rows.select("node", F.col("n_shingles").alias("n"), "sketch")
        .join(alive, "node", "left_semi")
        .dropDuplicates(["node"]),
        "sketches",
    )

    def links(pairs: DataFrame) -> DataFrame:
        return verified(pairs, docs, nodes, doc_id, text, percent)

    best = (
        live.groupBy("node", "rep").count()
        .groupBy("node").agg(F.max(F.struct("count", (-F.col("rep")).alias("order"), "rep")).alias("best"))
    )
    pairs = best.select(F.col("node").alias("a"), F.col("best.rep").alias("b"))
    tried = stored(_oriented(allowed(pairs, sketches)), "pairs")
    edges = links(tried)
    found = stored(components(edges), "components")
    # Forests as long as they bring links, then every pair that is still apart.  A group
    # without an allowed pair never gets one later and is left out from then on.
    every = False
    while True:
        near = stored(_apart(members, found, sketches, every), "near")
        pairs = stored(near.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
        more = False
        if not pairs.isEmpty():
            fresh = links(pairs)
            more = not fresh.isEmpty()
        if more:
            edges = edges.unionByName(fresh)
            found = stored(components(edges), "components")
        if every:
            break
        every = not more
        tried = tried.unionByName(pairs)
        members = stored(members.join(near.select("key").distinct(), "key", "left_semi"), "members")
    nameless = _documents(docs.where(F.col(f"`{doc_id}`").isNull()), doc_id, text)
    return _named(rows, nodes, found).unionByName(
        nameless.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    )


def _named(rows: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
    """Components named by their smallest document."""
    known = nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    name = known.groupBy("component").agg(F.min("first").alias("component_id"))
    named = known.join(name, "component").select("node", "component_id", "copies")
    plain = rows.select("doc_id", "n_shingles", "node")
    # Nodes with a thousandth of all rows, at most a thousand, are broadcast: their rows
    # stay where they are.
    marked = stored(named.withColumn("hot", F.col("copies") * 1000 > rows.count()), "names")
    hot = F.broadcast(marked.where("hot").select("node", "component_id"))
    cold = marked.where("NOT hot").select("node", "component_id")
    last = F.coalesce("component_id", "doc_id").alias("component_id")
    warm = plain.join(hot, "node").select("doc_id", "n_shingles", last)
    rest = plain.join(hot, "node", "left_anti").join(cold, "node", "left").select("doc_id", "n_shingles", last)
    return warm.unionByName(rest)


def one_of_each(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs`` without near copies: of each component the document with the
    smallest id stays, and of repeated rows of that id one.  Rows with a null id stay.
    Columns unchanged."""
    found = join(docs, percent=percent)
    kept = found.where("doc_id = component_id").select("doc_id").distinct()
    first = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return first.unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)
