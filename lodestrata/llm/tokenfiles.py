"""Token ids in seekable zstandard files.

A file holds one independent zstandard frame for each document, then a skippable frame
with the document ids and token counts, then a skippable frame with the seek table of
the public seekable format: compressed size, size and checksum (low half of xxh64) of
every frame, and a footer.  A reader takes footer, table and index from the end and
reads and decompresses the frames it is asked for.

Files are written by Spark's text writer, one row a file: commit, retries after lost
executors, and any file system Spark can write to come with it.  The row is the file up
to the last four bytes; those, the magic number that ends the seek table, are the
writer's line separator.
"""

from __future__ import annotations

import io
import json
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestrata.llm.common import Kept, slices, stored

# Fixed values of the public seekable format.
SKIPPABLE = 0x184D2A50
SEEK_TABLE = 0x184D2A5E
FOOTER_MAGIC = 0x8F92EAB1
FOOTER_TEXT = "±ê\u0092\u008f"  # its bytes, as Latin-1
CHECKSUMS = 0x80

FILE_BYTES = 32 << 20
#: Text of a writing task; small tables are dealt to all cores.
TASK_BYTES, LEAST_BYTES = 128 << 20, 4 << 20
LEVEL = 3
#: Entries of one generation; there are two.
KEPT_RUNS, KEPT_WORDS = 300_000, 300_000
LONG_RUN = 64
PART_BYTES = 1 << 20
_BLANK = re.compile(rb"[ \t-\r]")
_INDEX = struct.Struct("<4sBI")  # name, bytes of an id, documents
_NAME = b"tok1"


# --- encoding -------------------------------------------------------------------------


class WordEncoder:
    """Ids of whole texts, as the tokenizers library gives them.

    Where the tokenizer's normalizer and splitter never look across white space (and
    its special tokens hold none), each distinct run between ASCII white space is
    encoded once and kept in a bounded table; other tokenizers get the whole text.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.width = 2 if self.whole.get_vocab_size() <= 1 << 16 else 4
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        last = split[-1]
        self.apart = (
            kinds == ["NFC", "Replace", "Lowercase"]
            and spec["normalizer"]["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
            and spec["normalizer"]["normalizers"][1]["content"] == " "
            and [s["type"] for s in split] == ["Split", "ByteLevel"]
            and split[0]["behavior"] == "Removed" and split[0]["invert"]
            and r"\s" in split[0]["pattern"]["Regex"]
            and not last["add_prefix_space"] and not last["use_regex"]
            and not any(t["lstrip"] or t["rstrip"] or len(t["content"].split()) != 1 for t in spec["added_tokens"])
            and spec["post_processor"] is None
        )
        if self.apart:
            self.pieces = regex.compile(split[0]["pattern"]["Regex"]).findall
            self.special = [t["content"][0] for t in spec["added_tokens"]]
            self.model = self.whole.model
            # Signs that end a run and never join the letters before them.
            self.ends = bytes(b for b in b"!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~" if chr(b) not in self.special)
        # Bytes as characters of a byte-level vocabulary: printable Latin-1 signs stand
        # for themselves, the others follow from 256 on.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(plain)]
        self.signs = {b: 256 + i for i, b in enumerate(rest)}
        self.runs, self.words = Kept(KEPT_RUNS), Kept(KEPT_WORDS)

    def ids(self, text: str | None) -> bytes:
        """Little-endian 32-bit ids."""
        if not text:
            return b""
        if not self.apart:
            return self._library(text)
        data = text.encode("utf-8", "surrogatepass")
        if len(data) <= PART_BYTES:
            return self._part(data)
        # A very long text in parts that end at white space.
        out, at = [], 0
        while at < len(data):
            blank = _BLANK.search(data, at + PART_BYTES)
            stop = blank.start() if blank else len(data)
            out.append(self._part(data[at:stop]))
            at = stop
        return b"".join(out)

    def _part(self, data: bytes) -> bytes:
        get = self.runs.young.get
        out = []
        for run in data.split():
            found = get(run)
            if found is None:
                found = self.runs.older(run)
                if found is None:
                    found = self._run(run)
                    if len(run) <= LONG_RUN:
                        self.runs.put(run, found)
                get = self.runs.young.get
            out.append(found)
        return b"".join(out)

    def _library(self, text: str) -> bytes:
        ids = self.whole.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _run(self, run: bytes) -> bytes:
        word = run.rstrip(self.ends)
        if word.isalpha() and len(word) <= LONG_RUN:  # ASCII letters
            found = self._word(word.lower())
            return found + self._word(run[len(word) :]) if len(word) < len(run) else found
        text = run.decode("utf-8", "surrogatepass")
        # Letters up to U+024F have one lower case and are composed already.
        if (
            len(text) > LONG_RUN
            or max(text) >= "ɐ"
            or any(c in text for c in self.special)
            or not text.isprintable()
            or "İ" in text
        ):
            return self._library(text)
        return b"".join([self._word(piece.encode()) for piece in self.pieces(text.lower())])

    def _word(self, word: bytes) -> bytes:
        """Ids of one piece of the splitter."""
        found = self.words.young.get(word)
        if found is None:
            found = self.words.older(word)
            if found is None:
                mapped = word.decode() if word.isascii() else word.decode("latin-1").translate(self.signs)
                found = array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()
                self.words.put(word, found)
        return found


_LOADED: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _LOADED:
        _LOADED[path] = WordEncoder(path)
    return _LOADED[path]


# --- files ----------------------------------------------------------------------------


class FileBuilder:
    """Frames of one file, in the order they are added."""

    def __init__(self, width: int, level: int = LEVEL):
        self.width = width
        self.pack = zstandard.ZstdCompressor(level=level).compress
        self.frames: list[bytes] = []
        self.table: list[tuple[int, int, int]] = []
        self.docs: list[int | None] = []
        self.counts: list[int] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        data = ids.astype(f"<u{self.width}").tobytes()
        frame = self.pack(data)
        self.frames.append(frame)
        self.table.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.docs.append(doc_id)
        self.counts.append(len(ids))
        self.size += len(frame) + 12

    def content(self) -> bytes:
        """The file without its last four bytes."""
        known = np.array([d is not None for d in self.docs], "u1")
        index = _INDEX.pack(_NAME, self.width, len(self.docs)) + self.pack(
            np.array([d or 0 for d in self.docs], "<i8").tobytes()
            + np.array(self.counts, "<u4").tobytes()
            + known.tobytes()
        )
        index = struct.pack("<II", SKIPPABLE, len(index)) + index
        table = [*self.table, (len(index), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF)]
        rows = np.array(table, "<u4").tobytes()
        head = struct.pack("<II", SEEK_TABLE, len(rows) + 9)
        foot = struct.pack("<IB", len(table), CHECKSUMS)
        return b"".join([*self.frames, index, head, rows, foot])


@dataclass
class TokenFile:
    """Reader over a seekable stream; frames are read one by one as asked for."""

    stream: BinaryIO

    def __post_init__(self):
        end = self.stream.seek(0, io.SEEK_END)
        frames, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != FOOTER_MAGIC or flags != CHECKSUMS:
            raise ValueError("not a seekable token file")
        rows = np.frombuffer(self._at(end - 9 - 12 * frames, 12 * frames), "<u4").reshape(-1, 3)
        kind, length = struct.unpack("<II", self._at(end - 17 - 12 * frames, 8))
        if kind != SEEK_TABLE or length != 12 * frames + 9:
            raise ValueError("the seek table is damaged")
        self.sizes = rows[:-1, 0].astype(np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.lengths, self.checksums = rows[:-1, 1], rows[:-1, 2]
        self.unpack = zstandard.ZstdDecompressor().decompress
        index = self._at(int(self.sizes.sum()), int(rows[-1, 0]))[8:]
        name, self.width, n = _INDEX.unpack_from(index)
        if name != _NAME:
            raise ValueError("the index is damaged")
        data = self.unpack(index[_INDEX.size :])
        self.known = np.frombuffer(data, "u1", n, 12 * n).astype(bool)
        self.doc_ids = np.frombuffer(data, "<i8", n)
        self.counts = np.frombuffer(data, "<u4", n, 8 * n)

    def _at(self, start: int, length: int) -> bytes:
        self.stream.seek(start)
        data = self.stream.read(length)
        if len(data) != length:
            raise ValueError("the file is cut short")
        return data

    def ids(self, place: int) -> np.ndarray:
        """Ids of the document at ``place``, its checksum compared."""
        data = self.unpack(self._at(int(self.starts[place]), int(self.sizes[place])))
        if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.checksums[place]:
            raise ValueError(f"document {place} is damaged")
        return np.frombuffer(data, f"<u{self.width}")

    def find(self, doc_id: int) -> np.ndarray | None:
        """Ids of the first document of that id; files are in ascending order."""
        own = self.doc_ids[self.known]
        at = int(np.searchsorted(own, doc_id))
        if at == len(own) or own[at] != doc_id:
            return None
        return self.ids(at + int((~self.known).sum()))


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str | Callable[[], str],
    end_id: int,
    doc_id: str = "doc_id",
    text: str = "text",
    file_bytes: int = FILE_BYTES,
    level: int = LEVEL,
) -> None:
    """Write files in ascending order of ``doc_id``, null ids first, repeated ids in the
    order of a hash of their texts.

    Null and empty texts have the end id alone.  A file holds about ``file_bytes`` and
    at least one document.  An empty table gives an empty folder.  Other columns are
    left out."""
    own = F.col(f"`{text}`").cast("string")
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), own.alias("text"), F.xxhash64(own).alias("tie")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    cores = docs.sparkSession.sparkContext.defaultParallelism
    parts = max(1, -(-size // TASK_BYTES), min(4 * cores, size // LEAST_BYTES))
    # The hash spreads an id that many rows have.
    ordered = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer() if callable(tokenizer) else tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        width = enc.width if end_id < 1 << (8 * enc.width) else 4
        file = FileBuilder(width, level)

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([file.content()], pa.binary())], ["content"])

        for batch in batches:
            for start, stop in slices(batch.column(1)):
                own = batch.slice(start, stop - start)
                for d, t in zip(own.column(0).to_pylist(), own.column(1).to_pylist()):
                    file.add(d, np.frombuffer(enc.ids(t) + end, "<u4"))
                    if file.size >= file_bytes:
                        yield done()
                        file = FileBuilder(width, level)
        if file.frames:
            yield done()

    files = ordered.mapInArrow(run, "content binary")
    (
        files.select(F.col("content").cast("string").alias("value"))
        .write.option("lineSep", FOOTER_TEXT)
        .option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", 1)
        .text(folder)
    )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of all files in ascending order of ids: doc_id, ``start`` (ids before
    it), ``n_tokens`` and ``ids_crc32`` (of little-endian 32-bit ids)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    source = files.select("path", "content")

    def documents(batches):
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                f = TokenFile(io.BytesIO(content))
                n = f.counts.astype(np.int64)
                crc = [zlib.crc32(f.ids(i).astype("<u4").tobytes()) for i in range(len(n))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(n)),
                        pa.array(f.doc_ids, mask=~f.known),
                        pa.array(np.cumsum(n) - n),
                        pa.array(n),
                        pa.array(crc, pa.int64()),
                    ],
                    ["path", "doc_id", "before", "n_tokens", "ids_crc32"],
                )

    # The files are read once; what is left of them are a few numbers for each document.
    rows = stored(
        source.mapInArrow(
            documents, "path string, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint"
        ),
        "token-rows",
    )
    # One row a file; names tell apart files that begin with the same id, where null ids come first.
    files = rows.groupBy("path").agg(
        F.sum("n_tokens").alias("total"), F.min("doc_id").alias("least"), F.min(F.col("doc_id").isNotNull()).alias("known")
    )
    order = Window.orderBy("known", "least", "path")
    starts = files.select("path", (F.sum("total").over(order) - F.col("total")).alias("offset"))
    return rows.join(starts, "path").select(
        "doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
