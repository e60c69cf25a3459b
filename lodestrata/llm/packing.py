"""Best-fit packing of tokenized documents into sequences of bounded length.

Documents are encoded where they lie, and cut only where they are longer than a sequence.
The pieces are sorted by length, by ranges, over the cluster.  Pieces of one length are
interchangeable, so the sorted pieces are at most ``capacity`` runs, and so are the
gaps, sequences with the same room left: a run of gaps is a first sequence and a number.

Supersteps go through the lengths, the longest first.  In each, every piece of the run looks for
its successor among the gaps, the smallest that is long enough.  They all find the same, so
their ranks decide: the first ones get the gap that the successor sweep comes to first, as many as
fit into it, the next ones the next larger gap, and those whom no gap takes open sequences.
Then gaps are updated, and the next length follows.  This is best-fit decreasing over all pieces.

What is planned is runs, not pieces: a gap that is filled has less than half its room left, so
the runs of gaps and the blocks (a range of ranks to a range of sequences) are bounded by
the capacity, however many documents there are.  Every piece then sweeps the sorted blocks for its
own rank, in the tasks that hold the pieces; only slim rows are ever shuffled, never texts or ids.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from lodestrata.llm.common import list_array, map_texts, stored
from lodestrata.llm.tokenfiles import encoder

CAPACITY = 4096
_ROW_BITS = 33  # of monotonically_increasing_id, below the partition


@dataclass
class Plan:
    """Blocks in the order of length, then rank.  Pieces of ``length`` with ranks from ``rank`` on lie
    ``each`` to a sequence, from sequence ``first`` on, at ``offset`` and after."""

    length: np.ndarray
    rank: np.ndarray
    first: np.ndarray
    each: np.ndarray
    offset: np.ndarray
    sequences: int

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these ranks among those of their length."""
        # Blocks of each length are swept by rank: one ascending key for both.
        bits = int(max(self.rank.max(initial=0), rank.max(initial=0))).bit_length()
        block = np.searchsorted((self.length << bits) | self.rank, (length << bits) | rank, "right") - 1
        past, each = rank - self.rank[block], self.each[block]
        return self.first[block] + past // each, self.offset[block] + past % each * length


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Supersteps over the runs of pieces (``counts``: pieces of each length)."""
    gaps: dict[int, list[tuple[int, int]]] = {}  # room: runs (first sequence, sequences)
    rooms: list[int] = []  # those that have runs, in order
    blocks: list[tuple[int, int, int, int, int]] = []
    sequences = 0

    def leave(room: int, first: int, many: int) -> None:
        if room and many:
            if room not in gaps:
                gaps[room] = []
                insort(rooms, room)
            gaps[room].append((first, many))

    for length in sorted((n for n in counts if n > 0 and counts[n]), reverse=True):
        if length > capacity:
            raise ValueError(f"a piece of {length} is longer than {capacity}")
        rank, left = 0, counts[length]

        def fill(room: int, first: int, many: int) -> None:
            """The next pieces into ``many`` sequences with ``room``; ``many`` is not more than they need."""
            nonlocal rank, left
            each = room // length
            taken = min(left, each * many)
            blocks.append((length, rank, first, each, capacity - room))
            rank, left = rank + taken, left - taken
            full, some = divmod(taken, each)
            leave(room - each * length, first, full)
            if some:
                leave(room - some * length, first + full, 1)

        while left and (at := bisect_left(rooms, length)) < len(rooms):
            room = rooms.pop(at)
            runs = gaps.pop(room)
            while runs and left:
                first, many = runs.pop()
                used = min(many, -(-left // (room // length)))
                if used < many:
                    runs.append((first + used, many - used))
                fill(room, first, used)
            if runs:
                # What the last pieces leave is smaller than this room.
                gaps[room] = runs
                insort(rooms, room)
        if left:
            opened = -(-left // (capacity // length))
            fill(capacity, sequences, opened)
            sequences += opened
    order = sorted(blocks)
    columns = [np.array([b[i] for b in order], np.int64) for i in range(5)]
    return Plan(*columns, sequences)


def pieces(
    docs: DataFrame,
    tokenizer: str | Callable[[], str],
    end_id: int,
    capacity: int = CAPACITY,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length and ids_crc32 (of little-endian
    32-bit ids).  Null and empty texts have the end id alone."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    end = int(end_id).to_bytes(4, "little")

    def make():
        own = encoder(tokenizer() if callable(tokenizer) else tokenizer)

        def work(texts: list[str | None]) -> list:
            lengths, crc, many = [], [], []
            for t in texts:
                ids = memoryview(own.ids(t) + end)
                cuts = range(0, len(ids), 4 * capacity)
                parts = [ids[at : at + 4 * capacity] for at in cuts]
                lengths += [len(p) // 4 for p in parts]
                crc += [zlib.crc32(p) for p in parts]
                many.append(len(parts))
            counts = np.array(many, np.int64)
            return [list_array(np.array(v, np.int64), counts) for v in (lengths, crc)]

        return work

    whole = pa.list_(pa.int64())
    found = map_texts(source, "text", [("lengths", whole), ("crc", whole)], make, ["doc_id"])
    return found.select("doc_id", F.posexplode(F.arrays_zip("lengths", "crc")).alias("piece", "p")).select(
        "doc_id",
        "piece",
        (F.col("piece").cast("long") * capacity).alias("start"),
        F.col("p.lengths").alias("length"),
        F.col("p.crc").alias("ids_crc32"),
    )


def packed(rows: DataFrame, capacity: int = CAPACITY, length: str = "length") -> DataFrame:
    """``rows`` with ``sequence_id`` and ``offset``: best-fit decreasing by ``length``, 1 to ``capacity``.

    Sequences are numbered from 0 and have no holes.  Which of equally long rows comes first follows their
    order by the other columns.  An empty table stays empty."""
    spark = rows.sparkSession
    size = F.col(f"`{length}`")
    # The row's own number spreads what would be one range of equal rows.
    ranges = [size, F.monotonically_increasing_id()]
    ordered = rows.repartitionByRange(*ranges).sortWithinPartitions(size, *(F.col(f"`{c}`") for c in rows.columns if c != length))
    number = F.monotonically_increasing_id()
    ranked = stored(ordered.withColumn("__number", number), "ranked")
    part = F.shiftright("__number", _ROW_BITS)
    # Ranges of lengths: no more rows than partitions and lengths together.
    runs = ranked.groupBy(part.alias("part"), size.alias("length")).agg(F.count("*").alias("n")).collect()
    counts: dict[int, int] = {}
    parts: dict[int, int] = {}
    for r in runs:
        counts[r.length] = counts.get(r.length, 0) + r.n
        parts[r.part] = parts.get(r.part, 0) + r.n
    plan = best_fit(counts, capacity)
    own = np.array(sorted(parts), np.int64)
    before = np.cumsum([0, *(parts[p] for p in own.tolist())])[:-1]
    lengths = np.array(sorted(counts), np.int64)
    shorter = np.cumsum([0, *(counts[n] for n in lengths.tolist())])[:-1]
    shared = spark.sparkContext.broadcast((plan, own, before, lengths, shorter))
    at, numbers = rows.columns.index(length), len(rows.columns)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, own, before, lengths, shorter = shared.value
        for batch in batches:
            size = np.asarray(batch.column(at)).astype(np.int64)
            number = np.asarray(batch.column(numbers))
            # Place in the whole order, then among the rows of the same length.
            place = before[np.searchsorted(own, number >> _ROW_BITS)] + (number & ((1 << _ROW_BITS) - 1))
            sequence, offset = plan.places(size, place - shorter[np.searchsorted(lengths, size)])
            kept = [batch.column(i) for i in range(numbers)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names)

    out = StructType([*rows.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    names = out.names
    return ranked.mapInArrow(place, out)


def pack(
    docs: DataFrame,
    tokenizer: str | Callable[[], str],
    end_id: int,
    capacity: int = CAPACITY,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The pieces of all documents with their places: doc_id, piece, start, length, ids_crc32,
    sequence_id and offset.

    Null and empty texts have the end id alone, so every document has a piece.  Repeated rows and
    null ids are packed each; other columns are left out; an empty table gives no rows."""
    own = pieces(docs, tokenizer, end_id, capacity, doc_id, text)
    return packed(stored(own, "pieces"), capacity)
