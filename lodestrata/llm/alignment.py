"""Alignment of two tokenizations of one text by galloping intersection of token ends.

Tokens of either kind have ends, the running sums of their lengths in bytes.  The shorter of a
document's two end lists drives: each of its ends starts at the place in the longer list that
its own rank suggests, doubles its step until the end is passed, and halves the gap.  Ends found
in both lists cut the document into groups of tokens that cover the same bytes; the rank of
an end in the other list gives, by differences, the range of tokens that a token overlaps.

Two tokens that end together are linked.  As both are the bytes before that end, the shorter is
an end of the longer, so the pairs that can ever be linked follow from the two vocabularies
(some hundred thousand, whatever the corpus).  Links are numbers of such pairs: counts of
all pairs fit one small array on every machine, and no link is shuffled.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lodestrata.llm.common import list_array, map_texts, stored

SPACE = "▁"
SLICE_BYTES = 1 << 19
Path = str | Callable[[], str]


def _found(path: Path) -> str:
    return path() if callable(path) else path


# --- the two tokenizers ---------------------------------------------------------------


def byte_signs() -> dict[str, int]:
    """The byte of each sign of a byte-level vocabulary: printable Latin-1 signs stand for
    themselves, the other bytes follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteTokenizer:
    """A byte-level tokenizer from its file: space and text, strings of special tokens as text."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = spec["pre_tokenizer"]
        if spec["normalizer"] is not None or kind["type"] != "ByteLevel" or not kind["use_regex"] or kind["add_prefix_space"]:
            raise ValueError("a byte-level tokenizer that leaves the text as it is is wanted")
        signs = byte_signs()
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(signs[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        # Merges in the order of ids are what makes ids usable as ranks.
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        made = [spec["model"]["vocab"][a + b] for a, b in merges]
        if made != sorted(made):
            raise ValueError("merges are not in the order of ids")
        self.bytes = {i: t for t, i in ranks.items()}
        own = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._encode = own.encode_to_numpy
        self._path = path

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self._ids(" " + t) for t in texts]

    def _ids(self, text: str) -> np.ndarray:
        try:
            return self._encode(text, disallowed_special=()).astype(np.int32)
        except ValueError:  # the pattern's stack ends at some hundred thousand blanks in a row
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(self._path)
            whole.encode_special_tokens = True
            return np.array(whole.encode(text, add_special_tokens=False).ids, np.int32)


class PieceTokenizer:
    """A sentencepiece model that puts a space before the text."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self._model = m = SentencePieceProcessor(model_file=path)
        self.bytes = {}
        for i in range(m.get_piece_size()):
            piece = m.id_to_piece(i)
            self.bytes[i] = bytes([int(piece[3:5], 16)]) if m.is_byte(i) else piece.replace(SPACE, " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(i, np.int32) for i in self._model.encode(texts, num_threads=1)]


def possible_links(a: dict[int, bytes], b: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of ids of which one's bytes end the other's, in ascending order."""

    def by_bytes(tokens: dict[int, bytes]) -> dict[bytes, list[int]]:
        out: dict[bytes, list[int]] = {}
        for i, t in tokens.items():
            if t:
                out.setdefault(t, []).append(i)
        return out

    of_a, of_b = by_bytes(a), by_bytes(b)
    first, second = array("i"), array("i")
    for t, own in of_a.items():
        for at in range(len(t)):
            for y in of_b.get(t[at:], ()):
                first.extend(own)
                second.extend([y] * len(own))
    for t, own in of_b.items():
        for at in range(1, len(t)):
            for x in of_a.get(t[at:], ()):
                first.extend([x] * len(own))
                second.extend(own)
    keys = np.unique(np.array(first, np.int64) << 32 | np.array(second, np.int64))
    return keys >> 32, keys & 0xFFFFFFFF


class Tokenizers:
    """Both tokenizers, byte lengths of their tokens, and the numbers of possible links."""

    def __init__(self, byte_path: str, pattern: str, piece_path: str):
        self.a, self.b = ByteTokenizer(byte_path, pattern), PieceTokenizer(piece_path)
        self.lengths = []
        for own in (self.a.bytes, self.b.bytes):
            lengths = np.zeros(max(own) + 1, np.int64)
            lengths[list(own)] = [len(t) for t in own.values()]
            self.lengths.append(lengths)
        self.link_a, self.link_b = possible_links(self.a.bytes, self.b.bytes)
        self._width = len(self.lengths[1])
        self._keys = self.link_a * self._width + self.link_b

    def links(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Numbers of the links of ids that end together."""
        return np.searchsorted(self._keys, a.astype(np.int64) * self._width + b)

    def encode(self, text: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of each text; none where the text is null or empty or a tokenizer changes it."""
        none = np.zeros(0, np.int32)
        full = [t or "" for t in text]
        kept = ([], [])
        for t, a, b in zip(full, self.a.encode(full), self.b.encode(full)):
            data = (" " + t).encode()
            # The first kind's tokens are parts of the text itself, so their length tells.
            same = (
                bool(t)
                and int(self.lengths[0][a].sum()) == len(data)
                and b"".join(map(self.b.bytes.__getitem__, b.tolist())) == data
            )
            kept[0].append(a if same else none)
            kept[1].append(b if same else none)
        return kept


_LOADED: dict[tuple[str, str, str], Tokenizers] = {}


def tokenizers(byte_path: Path, pattern: str, piece_path: Path) -> Tokenizers:
    """One pair for each Python worker."""
    key = (_found(byte_path), pattern, _found(piece_path))
    if key not in _LOADED:
        _LOADED[key] = Tokenizers(*key)
    return _LOADED[key]


# --- intersection ---------------------------------------------------------------------


def gallop(values: np.ndarray, target: np.ndarray, first: np.ndarray, last: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each value the first place in ``target`` that is not below it, between ``first`` and
    ``last``, whose target must not be below it; the search doubles its steps from ``guess``."""
    low, high = guess - 1, guess.copy()  # target[low] < value <= target[high], once found
    right = target[guess] < values
    lanes = np.flatnonzero(right)
    low[lanes] = guess[lanes]
    step = 1
    while len(lanes):
        high[lanes] = np.minimum(low[lanes] + step, last[lanes])
        lanes = lanes[target[high[lanes]] < values[lanes]]
        low[lanes] = high[lanes]
        step *= 2
    lanes = np.flatnonzero(~right)
    step = 1
    while len(lanes):
        low[lanes] = np.maximum(high[lanes] - step, first[lanes] - 1)
        inside = low[lanes] >= first[lanes]
        lanes = lanes[inside]
        lanes = lanes[target[low[lanes]] >= values[lanes]]
        high[lanes] = low[lanes]
        step *= 2
    lanes = np.flatnonzero(high - low > 1)
    while len(lanes):
        middle = (low[lanes] + high[lanes]) >> 1
        below = target[middle] < values[lanes]
        low[lanes[below]] = middle[below]
        high[lanes[~below]] = middle[~below]
        lanes = lanes[high[lanes] - low[lanes] > 1]
    return high


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def ranks(ends: np.ndarray, counts: np.ndarray, other: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Place in ``other`` of the first end not below each of ``ends``.

    Both hold the ends of many documents, one after the other, each above those before;
    ``counts`` and ``others`` are the numbers of ends of each document, which end together."""
    first = np.repeat(_starts(others), counts)
    many = np.repeat(others, counts)
    own = np.arange(len(ends)) - np.repeat(_starts(counts), counts)
    guess = first + own * many // np.maximum(1, np.repeat(counts, counts))
    return gallop(ends, other, first, first + many - 1, guess)


def common_ends(ends_a: np.ndarray, n_a: np.ndarray, ends_b: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both lists of the ends they share; of each document the shorter list drives."""
    found_a, found_b = [], []
    for shorter in (True, False):
        docs = (n_a <= n_b) if shorter else (n_a > n_b)
        in_a, in_b = np.flatnonzero(np.repeat(docs, n_a)), np.flatnonzero(np.repeat(docs, n_b))
        a, b = ends_a[in_a], ends_b[in_b]
        if shorter:
            at = ranks(a, n_a[docs], b, n_b[docs])
            same = b[at] == a
            found_a.append(in_a[same])
            found_b.append(in_b[at[same]])
        else:
            at = ranks(b, n_b[docs], a, n_a[docs])
            same = a[at] == b
            found_a.append(in_a[at[same]])
            found_b.append(in_b[same])
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    order = np.argsort(a, kind="stable")
    return a[order], b[order]


def overlaps(ends: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last token of the other kind that each token of one document overlaps."""
    n, m = np.array([len(ends)]), np.array([len(other)])
    last = ranks(ends, n, other, m) if len(ends) else np.zeros(0, np.int64)
    # A token begins where the one before it ends: in the next token if one ends there too.
    first = np.concatenate([[0], last[:-1] + (other[last[:-1]] == ends[:-1])]) if len(ends) else last
    return first, last


# --- frames ---------------------------------------------------------------------------

_INTS = pa.list_(pa.int32())


@dataclass
class Aligned:
    """Tokens and groups of the documents of a slice, one after the other."""

    a: np.ndarray  # ids
    n_a: np.ndarray  # tokens of each document
    b: np.ndarray
    n_b: np.ndarray
    groups: np.ndarray  # of each document
    stops_a: np.ndarray  # of each group, the number of its document's tokens up to its end
    stops_b: np.ndarray

    def last(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the tokens that end each group."""
        return tuple(
            ids[np.repeat(_starts(n), self.groups) + stops - 1]
            for ids, n, stops in ((self.a, self.n_a, self.stops_a), (self.b, self.n_b, self.stops_b))
        )


def aligned(both: Tokenizers, texts: list[str | None]) -> Aligned:
    ids = both.encode(texts)
    n = [np.fromiter(map(len, i), np.int64, len(i)) for i in ids]
    flat = [np.concatenate(i) for i in ids]
    ends = [np.cumsum(lengths[f]) for lengths, f in zip(both.lengths, flat)]
    a, b = common_ends(ends[0], n[0], ends[1], n[1])
    starts = [_starts(c) for c in n]
    groups = np.searchsorted(a, starts[0] + n[0]) - np.searchsorted(a, starts[0])
    stops = [at + 1 - np.repeat(s, groups) for at, s in zip((a, b), starts)]
    return Aligned(flat[0], n[0], flat[1], n[1], groups, *stops)


def align(
    docs: DataFrame,
    byte_path: Path,
    pattern: str,
    piece_path: Path,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """A row for each document: doc_id, ``a_ids`` and ``b_ids``, and for each group ``a_stops`` and
    ``b_stops``, the number of tokens up to its end.

    Null and empty texts, and texts that a tokenizer changes, have empty lists.  Repeated rows are
    aligned each; other columns are left out.  Very long texts are taken one at a time."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def make():
        both = tokenizers(byte_path, pattern, piece_path)

        def work(texts: list[str | None]) -> list:
            f = aligned(both, texts)
            lists = ((f.a, f.n_a), (f.b, f.n_b), (f.stops_a, f.groups), (f.stops_b, f.groups))
            return [list_array(values.astype(np.int32), many) for values, many in lists]

        return work

    schema = [(name, pa.list_(pa.int32())) for name in ("a_ids", "b_ids", "a_stops", "b_stops")]
    return map_texts(source, "text", schema, make, ["doc_id"], SLICE_BYTES)


def _rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and numbers of values of a list column."""
    return np.asarray(column.flatten()), np.diff(np.asarray(column.offsets))


def group_texts(f: Aligned, signs: dict[str, np.ndarray]) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each document.

    Every token is its id and the sign after it; tokens are put in the order of groups."""
    total_a = np.repeat(_starts(f.n_a), f.groups) + f.stops_a  # stops in the flat lists
    total_b = np.repeat(_starts(f.n_b), f.groups) + f.stops_b
    size_a, size_b = np.diff(total_a, prepend=0), np.diff(total_b, prepend=0)
    out = np.empty(len(f.a) + len(f.b), object)
    at_a = np.arange(len(f.a)) + np.repeat(_starts(size_b), size_a)
    at_b = np.arange(len(f.b)) + np.repeat(np.cumsum(size_a), size_b)
    out[at_a] = signs[","][f.a]
    out[at_b] = signs[","][f.b]
    out[at_a[total_a - 1]] = signs["|"][f.a[total_a - 1]]
    out[at_b[total_b - 1]] = signs[";"][f.b[total_b - 1]]
    sizes = f.n_a + f.n_b
    parts = out.tolist()
    return ["".join(parts[stop - size : stop])[:-1] for stop, size in zip(np.cumsum(sizes).tolist(), sizes.tolist())]


def linked(
    docs: DataFrame, byte_path: Path, pattern: str, piece_path: Path, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups_sha256 and ``links``, the number of the pair of ids that
    ends each group, of the documents as ``align`` has them."""
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def make():
        both = tokenizers(byte_path, pattern, piece_path)
        most = max(map(len, both.lengths))
        signs = {s: np.array([f"{i}{s}" for i in range(most)], object) for s in ",|;"}

        def work(texts: list[str | None]) -> list:
            f = aligned(both, texts)
            sha = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in group_texts(f, signs)]
            links = both.links(*f.last()).astype(np.int32)
            return [*map(pa.array, (f.n_a, f.n_b, f.groups)), sha, list_array(links, f.groups)]

        return work

    schema = [(name, pa.int64()) for name in ("n_a", "n_b", "n_groups")]
    schema += [("groups_sha256", pa.string()), ("links", pa.list_(pa.int32()))]
    return map_texts(source, "text", schema, make, ["doc_id"], SLICE_BYTES)


def link_counts(rows: DataFrame) -> DataFrame:
    """Number of links of each pair, over all rows of ``linked``; at most as many rows as there are
    possible links."""
    return rows.select(F.explode("links").alias("link")).groupBy("link").agg(F.count("*").alias("n"))


def agreement(docs: DataFrame, byte_path: Path, pattern: str, piece_path: Path, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    ``n_best``: links whose pair is counted as often as any pair of its B id, over the whole
    table; ``count_sum``: the counts of the pairs of all links.  Null and empty texts, and texts that a
    tokenizer changes, have zeros and the empty text; repeated rows count each; an empty
    table gives none."""
    spark = docs.sparkSession
    rows = stored(linked(docs, byte_path, pattern, piece_path, doc_id, text), "links")
    # Both are bounded by the vocabularies, see above.
    counts = link_counts(rows).toArrow()
    _, b = possible_links(ByteTokenizer(_found(byte_path), pattern).bytes, PieceTokenizer(_found(piece_path)).bytes)
    count = np.zeros(len(b), np.int64)
    count[np.asarray(counts["link"])] = np.asarray(counts["n"])
    highest = np.zeros(b.max() + 1, np.int64)
    np.maximum.at(highest, b, count)
    shared = spark.sparkContext.broadcast((count, count == highest[b]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = shared.value
        for batch in batches:
            links, many = _rows(batch.column(5))
            bounds = np.concatenate([[0], np.cumsum(many)])

            def summed(values: np.ndarray) -> pa.Array:
                return pa.array(np.diff(np.concatenate([[0], np.cumsum(values[links], dtype=np.int64)])[bounds]))

            columns = [batch.column(i) for i in range(4)] + [pa.array(many.astype(np.int64)), summed(best), summed(count), batch.column(4)]
            yield pa.RecordBatch.from_arrays(columns, names)

    out = StructType([rows.schema["doc_id"]])
    for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"):
        out = out.add(name, "long")
    out = out.add("groups_sha256", "string")
    names = out.names
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links").mapInArrow(run, out)
