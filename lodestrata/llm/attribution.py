"""Token counts of sections or fields, from one encoding of the whole.

A document is encoded once; every token has a span of bytes, the sum of the lengths
before it.  Sections are spans too, and tokens are joined to the sections they overlap by
searching their ends in the sections' sorted starts.  A token that crosses a boundary is
allocated by a rule: ``start``, the section of its first byte; ``most``, the section with most of
its bytes, the earlier one on a tie; ``share``, to each section the part of its bytes there.
Under each rule the counts of a document add up to its tokens.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import list_array, map_texts

RULES = ("start", "most", "share")

_LOADED: dict[str, tuple] = {}


def encoding(path: str, pattern: str):
    """Byte-level encoding of a rank file, and the byte length of each token; special
    tokens' strings are ordinary text.  One for each Python worker."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        own = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _LOADED[path] = (own, lengths)
    return _LOADED[path]


def allocate(ends: np.ndarray, starts: np.ndarray, size: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens allocated to each section, and tokens of each that cross a boundary of it.

    ``ends``: end of each token; ``starts``: ascending start of each section, the first
    0, all before ``size`` unless empty; a section ends where the next starts."""
    sections = len(starts)
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    first = np.searchsorted(starts, begins, "right") - 1
    last = np.searchsorted(starts, ends - 1, "right") - 1
    counts = np.bincount(first, minlength=sections).astype(np.float64)
    crossing = np.zeros(sections, np.int64)
    stops = np.append(starts[1:], size)
    for t in np.flatnonzero(first != last):
        touched = np.arange(first[t], last[t] + 1)
        part = np.minimum(ends[t], stops[touched]) - np.maximum(begins[t], starts[touched])
        touched, part = touched[part > 0], part[part > 0]
        crossing[touched] += 1
        if rule != "start":
            counts[first[t]] -= 1
            if rule == "most":
                counts[touched[part.argmax()]] += 1
            else:
                counts[touched] += part / part.sum()
    return counts, crossing


def line_starts(data: np.ndarray) -> np.ndarray:
    """Starts of the lines of a text; a line holds its line break."""
    starts = np.concatenate([[0], np.flatnonzero(data == 10) + 1])
    return starts[starts < len(data)] if len(data) else starts[:0]


def sections(
    docs: DataFrame,
    ranks: Callable[[], str] | str,
    pattern: str,
    rule: str = "start",
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """A row for each line of each text: doc_id, ``section`` from 0, ``start`` and ``stop`` in
    characters, ``n_tokens`` allocated and ``n_crossing``.

    Null and empty texts have one section of no characters.  Repeated rows are counted
    each.  Lines without characters but their break are sections too."""
    if rule not in RULES:
        raise ValueError(f"rule {rule!r}")
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def make():
        own, lengths = encoding(ranks() if callable(ranks) else ranks, pattern)

        def work(texts: list[str | None]) -> list:
            columns: list[list[np.ndarray]] = [[], [], [], []]
            many = []
            for t in texts:
                data = np.frombuffer((t or "").encode(), np.uint8)
                if not len(data):
                    for c, v in zip(columns, (0, 0, 0.0, 0)):
                        c.append(np.array([v]))
                    many.append(1)
                    continue
                starts = line_starts(data)
                ends = np.cumsum(lengths[own.encode_to_numpy(t, disallowed_special=()).astype(np.int64)])
                counts, crossing = allocate(ends, starts, len(data), rule)
                characters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                bounds = characters[np.append(starts, len(data))]
                for c, v in zip(columns, (bounds[:-1], bounds[1:], counts, crossing)):
                    c.append(v)
                many.append(len(starts))
            many = np.array(many, np.int64)
            kinds = (np.int64, np.int64, np.float64, np.int64)
            return [list_array(np.concatenate(c).astype(k), many) for c, k in zip(columns, kinds)]

        return work

    whole, real = pa.list_(pa.int64()), pa.list_(pa.float64())
    schema = [("start", whole), ("stop", whole), ("n_tokens", real), ("n_crossing", whole)]
    found = map_texts(source, "text", schema, make, ["doc_id"])
    rows = found.select("doc_id", F.posexplode(F.arrays_zip("start", "stop", "n_tokens", "n_crossing")).alias("section", "s"))
    counted = F.col("s.n_tokens") if rule == "share" else F.col("s.n_tokens").cast("bigint")
    return rows.select(
        "doc_id", "section", F.col("s.start"), F.col("s.stop"), counted.alias("n_tokens"), F.col("s.n_crossing")
    )


def fields(
    rows: DataFrame,
    columns: Sequence[str],
    ranks: Callable[[], str] | str,
    pattern: str,
    rule: str = "start",
    between: str = "\n",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``rows`` with ``tokens``, an array with the tokens of each of ``columns`` as parts of one
    text, joined by ``between``, which counts to the field before it.

    Null fields are empty and stay empty in the array (0 tokens, though their ``between``
    counts to them)."""
    if rule not in RULES:
        raise ValueError(f"rule {rule!r}")
    names = list(columns)
    kept = rows.select(*(F.col(f"`{c}`") for c in keep), F.array(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in names)).alias("__fields"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, lengths = encoding(ranks() if callable(ranks) else ranks, pattern)
        for batch in batches:
            out = []
            for parts in batch.column(len(keep)).to_pylist():
                texts = [p + between for p in parts[:-1]] + parts[-1:]
                sizes = [len(t.encode()) for t in texts]
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
                ends = np.cumsum(lengths[own.encode_to_numpy("".join(texts), disallowed_special=()).astype(np.int64)])
                out.append(allocate(ends, starts, sum(sizes), rule)[0] if sum(sizes) else np.zeros(len(texts)))
            own_columns = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [*own_columns, pa.array(out, pa.list_(pa.float64()))], [*keep, "tokens"]
            )

    types = "".join(f"`{c}` {kept.schema[c].dataType.simpleString()}, " for c in keep)
    return kept.mapInArrow(run, types + "tokens array<double>")
