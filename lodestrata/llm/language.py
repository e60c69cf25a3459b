"""Language identification by a string kernel.

The kernel of two texts counts the character n-grams of one to three characters that
occur in both, whatever their number (blended-spectrum presence kernel), over the
geometric mean of the numbers of n-grams of either.  N-grams are hashed to
``BUCKETS`` presence bits.  The kernel is approximated by Nystroem landmarks, a few
texts of each language; one-versus-rest ridge regression on the landmark features
gives each language a value near 1 for its own texts and near -1 for others.
Texts are scored in batches: presence bits times landmark bits, times coefficients.

Every language is learned, from at most ``per_lang`` labelled texts of each, those with the
smallest hash of the id.  Where there are many languages, each has fewer texts and landmarks, so
that all together are about ``TEXTS`` and ``LANDMARKS``; below some number of either a language does not
go.  One task solves the regression over the sample's packed presence bits, a batch at a
time; the driver sees the kernel, packed as well.  Every text is scored, and whole.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.llm.common import fold, map_texts, stored

BUCKETS = 1 << 15
LENGTHS = (1, 2, 3)
PER_LANG, LEAST_PER_LANG, TEXTS = 250, 12, 16_384
LANDMARKS_PER_LANG, LEAST_LANDMARKS, LANDMARKS = 32, 2, 1024
RIDGE = 1.0
UNKNOWN = "und"
BATCH = 64
_PIECE = 1 << 20  # characters handled at once
_MIX = np.uint32(2654435761)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def mark(text: str, row: np.ndarray) -> None:
    """Set the presence bits of a text's n-grams in ``row``."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    reach = max(LENGTHS) - 1
    for at in range(0, max(1, len(codes)), _PIECE):
        piece = codes[at : at + _PIECE + reach]
        rolling = None
        for n in range(1, max(LENGTHS) + 1):
            if len(piece) < n:
                break
            tail = piece[n - 1 :]
            rolling = tail.copy() if rolling is None else rolling[: len(tail)] * np.uint32(16777619) ^ tail
            if n in LENGTHS:
                mixed = (rolling + np.uint32(n)) * _MIX
                row[(mixed ^ (mixed >> np.uint32(15))) % np.uint32(BUCKETS)] = 1


def shares(langs: int, per_lang: int = PER_LANG, landmarks_per_lang: int = LANDMARKS_PER_LANG) -> tuple[int, int]:
    """Texts and landmarks of each of so many languages."""
    langs = max(1, langs)
    return (
        min(per_lang, max(LEAST_PER_LANG, TEXTS // langs)),
        min(landmarks_per_lang, max(LEAST_LANDMARKS, LANDMARKS // langs)),
    )


def unpacked(rows: list[bytes]) -> np.ndarray:
    packed = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), BUCKETS // 8)
    return np.unpackbits(packed, axis=1).astype(np.float32)


def unit(bits: np.ndarray) -> np.ndarray:
    return bits / np.sqrt(np.maximum(bits.sum(1, keepdims=True), 1))


@dataclass
class Kernel:
    langs: list[str]
    marks: list[bytes]  # packed bits of the landmarks
    weights: np.ndarray  # landmarks x languages
    bias: np.ndarray

    def __post_init__(self):
        self._columns = None

    def __getstate__(self):
        return {**self.__dict__, "_columns": None}

    def inner(self, bits: np.ndarray) -> np.ndarray:
        """Kernel of texts and landmarks."""
        if self._columns is None:
            self._columns = np.ascontiguousarray(unit(unpacked(self.marks)).T)
        return bits @ self._columns / np.sqrt(np.maximum(bits.sum(1, keepdims=True), 1))

    def values(self, bits: np.ndarray) -> np.ndarray:
        return self.inner(bits) @ self.weights + self.bias


def fit(packed: list[bytes], langs: list[str], landmarks_per_lang: int, ridge: float) -> Kernel:
    """``packed``: the presence bits of each text, in the order of preference."""
    names = sorted(set(langs))
    number = {name: i for i, name in enumerate(names)}
    target = np.full((len(langs), len(names)), -1.0)
    target[np.arange(len(langs)), [number[a] for a in langs]] = 1.0
    chosen: list[int] = []
    taken = dict.fromkeys(names, 0)
    for i, a in enumerate(langs):
        if taken[a] < landmarks_per_lang:
            taken[a] += 1
            chosen.append(i)
    chosen.sort(key=lambda i: (number[langs[i]], i))
    kernel = Kernel(names, [packed[i] for i in chosen], np.zeros((0, 0)), np.zeros(0))
    marks = unit(unpacked(kernel.marks))
    values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    features = np.empty((len(packed), root.shape[1]))
    for at in range(0, len(packed), BATCH):
        bits = unpacked(packed[at : at + BATCH])
        features[at : at + BATCH] = (unit(bits) @ marks.T).astype(np.float64) @ root
    centre, mean = features.mean(0), target.mean(0)
    features -= centre
    solved = np.linalg.solve(
        features.T @ features + ridge * np.eye(features.shape[1]), features.T @ (target - mean)
    )
    kernel.weights = (root @ solved).astype(np.float32)
    kernel.bias = (mean - centre @ solved).astype(np.float32)
    return kernel


def learn(
    docs: DataFrame,
    train: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_lang: int = PER_LANG,
    landmarks_per_lang: int = LANDMARKS_PER_LANG,
    ridge: float = RIDGE,
) -> Kernel | None:
    """None if there is no text to learn from: ``train`` true, language and text not
    null, a letter in the text."""
    rows = docs.where(train & F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").rlike(r"\p{L}"))
    ids = rows.select(
        F.col(f"`{doc_id}`").alias("id"),
        F.col(f"`{lang}`").alias("lang"),
        F.xxhash64(F.col(f"`{doc_id}`")).alias("order"),
        F.col(f"`{text}`").alias("text"),
    )
    langs = ids.select("lang").distinct().count()
    if not langs:
        return None
    per_lang, landmarks_per_lang = shares(langs, per_lang, landmarks_per_lang)
    first = Window.partitionBy("lang").orderBy("order", "id")
    picked = (
        ids.select("id", "lang", "order")
        .withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= per_lang)
        .select("id", "lang")
        .distinct()
    )
    # At most per_lang rows of an id and a language for each language.
    sample = ids.join(F.broadcast(picked), ["id", "lang"]).dropDuplicates(["id"])

    def make():
        def work(texts: list[str | None]) -> list:
            packed = []
            for t in texts:
                row = np.zeros(BUCKETS, np.uint8)
                mark(t, row)
                packed.append(np.packbits(row).tobytes())
            return [packed]

        return work

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [r for batch in batches for r in batch.to_pylist()]
        found.sort(key=lambda r: (r["order"], str(r["id"])))
        kernel = fit([r["bits"] for r in found], [r["lang"] for r in found], landmarks_per_lang, ridge) if found else None
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(kernel)])], ["kernel"])

    marked = stored(map_texts(sample, "text", [("bits", pa.binary())], make, ["lang", "order", "id"]), "marked")
    # One task has the sample, which is bounded by the languages.
    return pickle.loads(bytes(marked.coalesce(1).mapInArrow(solve, "kernel binary").first()[0]))


def classify(
    docs: DataFrame,
    kernel: Kernel | None,
    text: str = "text",
    keep: list[str] | None = None,
    prefix: str = "",
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1: half of one plus the winning
    language's value, 1/2 where no language claims the text).

    Null texts and texts without a letter are ``und`` with score 0; so is every text
    if nothing was learned.  Ties go to the language first in alphabetical order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(kernel)

    def make():
        k = shared.value
        bits = np.zeros((BATCH, BUCKETS), np.float32)

        def work(texts: list[str | None]) -> list:
            langs = [UNKNOWN] * len(texts)
            scores = np.zeros(len(texts))
            able = [i for i, t in enumerate(texts) if k is not None and has_letter(t)]
            for at in range(0, len(able), BATCH):
                group = able[at : at + BATCH]
                bits[: len(group)] = 0
                for r, i in enumerate(group):
                    mark(texts[i], bits[r])
                values = k.values(bits[: len(group)])
                best = values.argmax(1)
                for r, i in enumerate(group):
                    langs[i] = k.langs[best[r]]
                    scores[i] = min(1.0, max(0.0, (1 + float(values[r, best[r]])) / 2))
            return [langs, pa.array(scores)]

        return work

    schema = [(prefix + "lang_pred", pa.string()), (prefix + "score", pa.float64())]
    return map_texts(docs, text, schema, make, keep)


def train_fold(doc_id: str = "doc_id") -> Column:
    return fold(doc_id, 4) != 2


def identify(docs: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learned from the other rows."""
    kernel = learn(docs, train_fold(), **options)
    held = docs.select("doc_id", "text", (~train_fold()).alias("held_out"))
    return classify(held, kernel, keep=["doc_id", "held_out"])


def known_language(docs: DataFrame, min_score: float = 0.0, **options) -> DataFrame:
    """Rows whose text is in a learned language with at least ``min_score``; rows that
    are ``und`` go.  Columns unchanged.  With nothing to learn from, all rows stay."""
    kernel = learn(docs, train_fold(), **options)
    if kernel is None:
        return docs
    found = classify(docs, kernel, prefix="__found_")
    kept = (F.col("__found_lang_pred") != UNKNOWN) & (F.col("__found_score") >= min_score)
    return found.where(kept).select(*docs.columns)
