"""SentencePiece encoding and decoding of merge-type models, without replaying merges.

A sequence of pieces is the encoding of a text exactly when every two neighbours are
compatible: merging the characters of both together gives back the two.  So the text is
covered from the left by the longest piece that is compatible with the one before;
where none is, the last piece is taken back and a shorter one tried, and a bit for each
position keeps it from being entered again after it failed.  The longest piece that starts at a
position is the match of an Aho-Corasick automaton there, the next shorter ones follow from
the piece alone.

No piece has a blank mark inside or after other characters, so a text falls into units
(blanks, then other characters) that are encoded apart.  Each distinct unit is encoded
once and kept in a bounded table of the task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from lodestrata.llm.common import Kept, list_array, map_texts

SPACE = "▁"
#: Entries of one generation of the tables of units and pairs; there are two.
KEPT_UNITS = 300_000
KEPT_PAIRS = 200_000
LONG_UNIT = 64
_NONE = float("-inf")
_SIGNS = ".,;:!?)]}\"*%&#$|"


class PieceModel:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        normal = spec.normalizer_spec
        if spec.trainer_spec.model_type != 2 or normal.precompiled_charsmap:
            raise ValueError("a merge-type model without character maps is wanted")
        if normal.remove_extra_whitespaces or not normal.escape_whitespaces:
            raise ValueError("blanks must be kept")
        if not spec.trainer_spec.byte_fallback or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("byte fallback and blank marks before words are wanted")
        self.dummy = normal.add_dummy_prefix
        library = SentencePieceProcessor(model_file=path)
        n = library.get_piece_size()
        self.pieces = [library.id_to_piece(i) for i in range(n)]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if library.is_byte(i)}
        self.of_byte = {i: b for b, i in self.bytes.items()}
        plain = [
            i for i in range(n)
            if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i) or library.is_unused(i))
        ]
        self.ids = {self.pieces[i]: i for i in plain}
        self.scores = {self.pieces[i]: library.get_score(i) for i in plain}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces with a blank mark inside are not supported")
        if any("\n" in p for p in self.ids):
            raise ValueError("pieces with line breaks are not supported")
        self.pairs = Kept(KEPT_PAIRS)
        self.automaton = ahocorasick.Automaton()
        self.whole: dict[str, bytes] = {}  # units that are one piece
        for p, i in self.ids.items():
            # Pieces that merging never reaches do not occur in encodings.
            if len(p) > 1 and self.merged(p) == [p]:
                self.automaton.add_word(p, i)
                self.whole[p] = b"%d" % i
        self.longest = max(map(len, self.whole), default=1)
        # Of all that the automaton walks through, the longest piece it begins with, and
        # of each piece the next shorter one; a single character at last.
        self.within: dict[str, int] = {}
        for p in self.whole:
            size = 1
            for n in range(1, len(p) + 1):
                size = n if p[:n] in self.whole else size
                self.within[p[:n]] = size
        self.shorter = {p: p[: self.within[p[:-1]]] for p in self.whole}
        self.decimal = {p: str(i) for p, i in self.ids.items()}
        self.units = Kept(KEPT_UNITS)
        # A line break is a unit of its own, as it is in no piece; so is what follows a
        # word where no piece has that sign after a letter.
        joined = {b for p in self.ids for a, b in zip(p, p[1:]) if a.isalpha()}
        signs = [c for c in _SIGNS if c not in joined]
        # A word's part may hold more than letters, such as superscripts and fractions;
        # those with a sign after them in a piece end no word.
        before = {a for p in self.ids for a, b in zip(p, p[1:]) if b in signs and re.match(r"[^\W\d_]", a)}
        word = rf"[^\W\d_{''.join(map(re.escape, sorted(before)))}]"
        after = rf" *{word}+(?=[{''.join(map(re.escape, signs))}])|" if signs else ""
        self.split = re.compile(after + r" +[^ \n]*|[^ \n]+|\n").findall

    # --- encoding ------------------------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text by merging: best score first, then leftmost."""
        parts = list(text)
        get = self.scores.get
        scores = [get(a + b, _NONE) for a, b in zip(parts, parts[1:])]
        while scores:
            best = max(scores)
            if best == _NONE:
                break
            at = scores.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = get(parts[at - 1] + parts[at], _NONE)
            if at < len(scores):
                scores[at] = get(parts[at] + parts[at + 1], _NONE)
        return parts

    def compatible(self, left: str, right: str) -> bool:
        key = left + "\n" + right  # no piece holds a line break
        known = self.pairs.young.get(key)
        if known is None:
            known = self.pairs.older(key)
            if known is None:
                known = self.merged(left + right) == [left, right]
                self.pairs.put(key, known)
        return known

    def match(self, text: str) -> str:
        """The longest piece at the start of ``text``, else its first character."""
        return text[: self.within.get(text[: self.automaton.longest_prefix(text)], 1)]

    def cover(self, text: str) -> list[str]:
        """The pieces of ``text``, characters outside the vocabulary as they are."""
        n, longest = len(text), self.longest
        open_ = bytearray(b"\1") * (n + 1)
        taken: list[str] = []
        match, shorter, compatible = self.match, self.shorter, self.compatible
        at, last = 0, ""
        while at < n:
            piece = match(text[at : at + longest])
            while not (open_[at + len(piece)] and (not last or compatible(last, piece))):
                while len(piece) == 1:
                    # Nothing shorter: the piece before is taken back.
                    open_[at] = 0
                    piece = taken.pop()
                    at -= len(piece)
                    last = taken[-1] if taken else ""
                piece = shorter[piece]
            taken.append(piece)
            last = piece
            at += len(piece)
        return taken

    def unit(self, unit: str) -> tuple[bytes, str | None]:
        """Ids of a unit as decimal text; the text that decoding them gives, if it is another.
        Only units that decode to themselves are kept."""
        found = self.units.older(unit)
        if found is not None:
            return found, None
        text = None
        mapped = unit.replace(" ", SPACE)
        found = self.whole.get(mapped)
        if found is None:
            taken = self.cover(mapped)
            try:
                found = ",".join([self.decimal[p] for p in taken]).encode()
            except KeyError:  # characters outside the vocabulary
                ids = self.ids_of(taken)
                found = ",".join(map(str, ids)).encode()
                decoded = self.joined(ids)
                if decoded != unit:
                    text = decoded
        if text is None and len(unit) <= LONG_UNIT:
            self.units.put(unit, found)
        return found, text

    def encode_unit(self, unit: str) -> list[int]:
        return self.ids_of(self.cover(unit.replace(" ", SPACE)))

    def ids_of(self, taken: list[str]) -> list[int]:
        ids: list[int] = []
        for piece in taken:
            known = self.ids.get(piece)
            if known is not None:
                ids.append(known)
            else:
                ids.extend(self.bytes[b] for b in piece.encode("utf-8", "surrogatepass"))
        return ids

    def units_of(self, text: str) -> list[str]:
        if not text:
            return []
        text = text.replace(SPACE, " ")
        return self.split(" " + text if self.dummy else text)

    def encode(self, text: str | None) -> list[int]:
        return [i for u in self.units_of(text or "") for i in self.encode_unit(u)]

    # --- decoding ------------------------------------------------------------------

    def joined(self, ids: list[int]) -> str:
        """Text of the ids with blanks for marks; the first blank is still there."""
        out: list[str] = []
        run = bytearray()
        for i in ids:
            b = self.of_byte.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(self.pieces[i].replace(SPACE, " "))
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        text = self.joined(ids)
        return text[1:] if self.dummy and text.startswith(" ") else text

    def digest(self, text: str | None) -> tuple[bytes, str]:
        """Ids as decimal text, and the decoded text."""
        units = self.units_of(text or "")
        get = self.units.young.get
        found, other = [], {}
        for u in units:
            ids = get(u)
            if ids is None:
                ids, told = self.unit(u)
                if told is not None:
                    other[u] = told
                get = self.units.young.get
            found.append(ids)
        ids = b",".join(found)
        decoded = "".join([other.get(u, u) for u in units] if other else units)
        if self.dummy and decoded.startswith(" "):
            decoded = decoded[1:]
        return ids, decoded


_LOADED: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """One model for each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = PieceModel(path)
    return _LOADED[path]


def _numbers(ids: list[bytes]) -> pa.Array:
    """Lists of ids from their decimal text."""
    values = [np.fromstring(i, np.int32, sep=",") for i in ids]
    return list_array(np.concatenate(values), np.fromiter(map(len, values), np.int64, len(values)))


def encode(
    docs: DataFrame, path: str | Callable[[], str], text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` with ``ids``: the pieces of each text; null and empty texts have none.
    ``path`` is the model file, or a function that finds it on the executor."""

    def make():
        m = model(path() if callable(path) else path)

        def work(texts: list[str | None]) -> list:
            return [_numbers([m.digest(t)[0] for t in texts])]

        return work

    return map_texts(docs, text, [("ids", pa.list_(pa.int32()))], make, keep)


def decode(rows: DataFrame, path: str | Callable[[], str], ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``, the text of each list of ids; null for a null list.  A column of
    that name is replaced."""
    rows = rows.drop("decoded")

    def run(batches):
        m = model(path() if callable(path) else path)
        for batch in batches:
            texts = [None if i is None else m.decode(i) for i in batch.column(ids).to_pylist()]
            yield batch.append_column("decoded", pa.array(texts, pa.string()))

    schema = StructType([*rows.schema.fields, StructField("decoded", StringType())])
    return rows.mapInArrow(run, schema)


def digests(
    docs: DataFrame,
    path: str | Callable[[], str],
    text: str = "text",
    keep: list[str] | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 (of the decimal ids joined by commas) and
    decoded_sha256 (of what decoding the ids gives), and the ids themselves if asked for, in one pass.

    Null and empty texts have no ids and decode to the empty text; rows are encoded
    one by one, so repeated rows and ties change nothing."""

    def make():
        m = model(path() if callable(path) else path)

        def work(texts: list[str | None]) -> list:
            counts, ids_sha, text_sha, all_ids = [], [], [], []
            for t in texts:
                ids, decoded = m.digest(t)
                counts.append(ids.count(b",") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest())
                if with_ids:
                    all_ids.append(ids)
            return [counts, ids_sha, text_sha, *([_numbers(all_ids)] if with_ids else [])]

        return work

    schema = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    if with_ids:
        schema.append(("ids", pa.list_(pa.int32())))
    return map_texts(docs, text, schema, make, keep)
