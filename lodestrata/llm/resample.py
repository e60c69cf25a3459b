"""Quality selection by importance resampling over hashed n-grams.

Two generative models give the probability of each bucket of hashed words and word
pairs: one of the target texts, one of the raw texts.  A document's importance is the mean
log ratio of the two over its n-grams, times ``SHARPNESS``; with Gumbel noise of its
own added, the documents with the largest sums are a sample without replacement in
proportion to importance (Gumbel top-k).

The raw model counts all documents; the target model counts a bounded sample of the
labelled good ones.  Counts are added up by task and bucket, so BUCKETS numbers reach the driver.
The k-th largest sum is found by counting in ever finer ranges, never by sorting all
documents in one place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import map_texts, stored
from lodestrata.llm.jaccard import mix

BUCKETS = 1 << 14
MAX_TARGET = 20_000
SHARPNESS = 32.0
SMOOTHING = 1.0
RANGES = 1024


def buckets_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and word pairs of all texts in turn, and their number for each."""
    split = [t.lower().encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    flat = [w for s in split for w in s]
    if not flat:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    codes = np.frombuffer(b"".join(flat), np.uint8).astype(np.uint64)
    length = np.fromiter(map(len, flat), np.int64, len(flat))
    begin = np.cumsum(length) - length
    place = np.arange(len(codes)) - np.repeat(begin, length)
    powers = np.full(int(length.max()), np.uint64(0x9E3779B97F4A7C15))
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    words = mix(np.add.reduceat((codes + np.uint64(1)) * powers[place], begin))
    owner = np.repeat(np.arange(len(texts)), counts)
    pairs = mix(words[:-1] * np.uint64(3) + words[1:])[owner[:-1] == owner[1:]]
    both = np.concatenate([words, pairs])
    owners = np.concatenate([owner, owner[:-1][owner[:-1] == owner[1:]]])
    order = np.argsort(owners, kind="stable")
    return (both[order] % np.uint64(BUCKETS)).astype(np.int64), np.bincount(owners, minlength=len(texts))


def counted(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Occurrences of each bucket in all texts."""

    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            texts = batch.column(0)
            for at in range(0, len(texts), 512):
                found, _ = buckets_of(texts.slice(at, 512).to_pylist())
                total += np.bincount(found, minlength=BUCKETS)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"]
        )

    parts = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "bucket int, n bigint")
    out = np.zeros(BUCKETS)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    def logs(n: np.ndarray) -> np.ndarray:
        return np.log((n + SMOOTHING) / (n + SMOOTHING).sum())

    return logs(target) - logs(raw)


def judged(labels: DataFrame) -> DataFrame:
    """doc_id and quality of each labelled id; null labels and ids are left out, and ids
    labelled both ways are not good."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
    return known.groupBy("doc_id").agg(F.min("quality").alias("quality"))


def good_share(labels: DataFrame) -> float:
    """Share of good ids among the labelled ones; 1 without labels, as nothing is known to be poor."""
    share = judged(labels).agg(F.avg("quality")).first()[0]
    return 1.0 if share is None else share


def target_counts(docs: DataFrame, labels: DataFrame, most: int = MAX_TARGET) -> np.ndarray:
    """Counts over at most ``most`` labelled good documents, those with the smallest hash of
    the id."""
    good = (
        judged(labels).where("quality = 1")
        .orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id").limit(most)
    )
    ids = F.broadcast(good)  # at most ``most`` rows
    return counted(docs.join(ids, "doc_id", "left_semi"))


def weigh(docs: DataFrame, ratio: np.ndarray, seed: int = 11, sharpness: float = SHARPNESS) -> DataFrame:
    """doc_id, ``n_grams``, ``log_weight`` and ``key`` (weight plus noise that follows from seed, id
    and text).  Texts without words have weight 0."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def make():
        own = shared.value

        def work(texts: list[str | None]) -> list:
            found, many = buckets_of(texts)
            sums = np.zeros(len(texts))
            full = many > 0
            if full.any():
                sums[full] = np.add.reduceat(own[found], (np.cumsum(many) - many)[full])
            return [many, pa.array(sharpness * sums / np.maximum(many, 1))]

        return work

    source = docs.select("doc_id", "text", F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("h"))
    found = map_texts(source, "text", [("n_grams", pa.int64()), ("log_weight", pa.float64())], make, ["doc_id", "h"])
    # A number strictly between 0 and 1 from 52 bits of the hash.
    u = (F.shiftrightunsigned("h", 12).cast("double") + 0.5) / float(1 << 52)
    return found.select("doc_id", "n_grams", "log_weight", (F.col("log_weight") - F.log(-F.log(u))).alias("key"), "h")


def boundary(keyed: DataFrame, k: int) -> float:
    """The k-th largest key."""
    low, high = keyed.agg(F.min("key"), F.max("key")).first()
    left = k
    while low < high:
        width = (high - low) / RANGES
        inside = keyed.where(F.col("key").between(low, high))
        part = F.least(F.floor((F.col("key") - low) / F.lit(width or 1.0)), F.lit(RANGES - 1))
        ranges = inside.groupBy(part.alias("part")).agg(
            F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")
        ).orderBy(F.desc("part")).collect()
        for r in ranges:
            if r["n"] >= left:
                break
            left -= r["n"]
        if len(ranges) == 1 and (r["low"], r["high"]) == (low, high):
            # No finer range can be told apart: neighbouring numbers.
            return low
        low, high = r["low"], r["high"]
    return high


def resample(
    docs: DataFrame, labels: DataFrame, keep: float | None = None, seed: int = 11, most: int = MAX_TARGET
) -> DataFrame:
    """Per row: doc_id, ``n_grams``, ``log_weight``, ``key``, ``selected`` for the ceil(keep * rows)
    largest keys; rows that tie with the last of them, such as repeated rows, are selected too.
    If ``keep`` is not given, it is the share of good ids among the labelled ones.

    Null and empty texts have weight 0 and take part.  Without labelled good documents
    all weights are 0, and the sample is uniform.  An empty table gives an empty one."""
    raw = counted(docs)
    target = target_counts(docs, labels, most)
    ratio = log_ratio(target, raw) if target.any() else np.zeros(BUCKETS)
    keyed = stored(weigh(docs, ratio, seed), "keys")
    rows = keyed.count()
    if not rows:
        return keyed.select("doc_id", "n_grams", "log_weight", "key", F.lit(False).alias("selected"))
    wanted = int(np.ceil((good_share(labels) if keep is None else keep) * rows))
    selected = F.col("key") >= boundary(keyed, wanted) if wanted else F.lit(False)
    return keyed.select("doc_id", "n_grams", "log_weight", "key", selected.alias("selected"))
