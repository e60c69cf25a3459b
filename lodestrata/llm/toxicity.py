"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text is its lower-cased words in windows of ``WINDOW`` words that overlap by
``WINDOW - STRIDE``.  A word enters as a learned vector of its own and the mean vector
of its character n-grams, so unseen words are judged by their parts; vectors that
training has not touched are zero.  Two gated recurrent units read a window in either
direction, attention pools their states, and the text has the score of its worst window.

The network is trained in numpy in one task, on at most ``max_positive`` and
``max_negative`` labelled texts (those with the smallest hash of the id), of each every
window up to ``MAX_WINDOWS``, past a million words.  A text's label holds for some window only: after a
first round over all windows, the highest windows of each text count, and toxic texts
whose highest window scores below ``DOUBTFUL`` are taken as labelled by mistake.  Scoring takes
every window of every text.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.llm.common import fold, map_texts, stored

WINDOW, STRIDE = 32, 24
BUCKETS = 1 << 16  # of words, and of character n-grams
GRAMS = (3, 4, 5)
WORD_DIM, CHAR_DIM, HIDDEN = 8, 16, 12
MAX_POSITIVE, MAX_NEGATIVE, MAX_WINDOWS = 600, 1500, 1 << 16
ROUNDS, BATCH = 3, 256
DOUBTFUL = 0.2
SCORED_AT_ONCE, WORDS_AT_ONCE = 2048, 8192
SLICE_BYTES = 2 << 20
_WORD = re.compile(r"\w{1,64}")


# --- inputs -----------------------------------------------------------------------


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def starts_of(n: int) -> range:
    """Starts of the windows over ``n`` words; the last one ends at or after the text."""
    return range(0, max(1, -(-(n - WINDOW) // STRIDE) + 1) * STRIDE, STRIDE) if n else range(0)


def parts_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets; n-gram buckets of all words in turn; where each word's begin."""
    joined = "".join(f"<{w}>" for w in words)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    length = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(length)
    owner = np.repeat(np.arange(len(words)), length)
    grams, owners = [], []
    rolling = None
    for n in range(1, max(GRAMS) + 1):
        tail = codes[n - 1 :]
        rolling = tail.copy() if rolling is None else rolling[: len(tail)] * np.uint32(16777619) ^ tail
        if n in GRAMS:
            own = owner[: len(tail)]
            inside = own == owner[n - 1 :]
            mixed = (rolling[inside] + np.uint32(n)) * np.uint32(2654435761)
            grams.append((mixed ^ mixed >> np.uint32(15)) % np.uint32(BUCKETS))
            owners.append(own[inside])
    grams, owners = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    # Every word has "<x>" at least, so no word is without n-grams.
    first = np.searchsorted(owners[order], np.arange(len(words)))
    power = np.uint32(16777619) ** (np.arange(len(codes), dtype=np.uint32) - np.repeat(ends - length, length).astype(np.uint32))
    whole = np.add.reduceat(codes * power, ends - length)
    whole = (whole ^ whole >> np.uint32(15)) * np.uint32(2654435761)
    return (whole ^ whole >> np.uint32(13)) % np.uint32(BUCKETS), grams[order], first


def numbered(texts: list[list[str]]) -> tuple[list[str], list[np.ndarray]]:
    """Distinct words, and each text as their numbers from 1."""
    seen: dict[str, int] = {}
    ids = [np.array([seen.setdefault(w, len(seen) + 1) for w in t], np.int32) for t in texts]
    return list(seen), ids


def windows_of(ids: np.ndarray, starts) -> np.ndarray:
    """Rows of WINDOW word numbers, 0 after the end."""
    starts = np.asarray(starts)
    padded = np.concatenate([ids, np.zeros(WINDOW, np.int32)])
    return padded[np.minimum(starts[:, None] + np.arange(WINDOW), len(padded) - 1)]


# --- the network --------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Network:
    """p: w, c embeddings; per direction i in 0, 1: X{i} inputs, U{i} gates, N{i}
    candidate, b{i}; A, a attention; o, k output.  scale, shift: calibration."""

    p: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0

    @staticmethod
    def fresh(seed: int) -> Network:
        rng = np.random.default_rng(seed)
        d, h = WORD_DIM + CHAR_DIM, HIDDEN

        def dense(*shape):
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

        p = {
            "w": np.zeros((BUCKETS, WORD_DIM), np.float32),
            "c": np.zeros((BUCKETS, CHAR_DIM), np.float32),
            "A": dense(2 * h, h), "a": dense(h), "o": dense(2 * h), "k": np.zeros(1, np.float32),
        }
        for i in (0, 1):
            p |= {f"X{i}": dense(d, 3 * h), f"U{i}": dense(h, 2 * h), f"N{i}": dense(h, h)}
            p[f"b{i}"] = np.zeros(3 * h, np.float32)
        return Network(p)

    def inputs(self, words: np.ndarray, grams: np.ndarray, first: np.ndarray) -> np.ndarray:
        ends = np.append(first[1:], len(grams))
        out = np.empty((len(words), WORD_DIM + CHAR_DIM), self.p["c"].dtype)
        out[:, :WORD_DIM] = self.p["w"][words]
        for at in range(0, len(words), WORDS_AT_ONCE):
            a, b = first[at : at + WORDS_AT_ONCE], ends[at : at + WORDS_AT_ONCE]
            sums = np.add.reduceat(self.p["c"][grams[a[0] : b[-1]]], a - a[0], axis=0)
            out[at : at + WORDS_AT_ONCE, WORD_DIM:] = sums / (b - a)[:, None]
        return out

    def forward(self, x: np.ndarray, rows: np.ndarray, keep: bool = False):
        """Logits of windows; x: a vector for each word, rows: word numbers from 1."""
        p, h = self.p, HIDDEN
        there = (rows > 0).astype(np.float32)
        states = np.empty((len(rows), WINDOW, 2 * h), np.float32)
        tape = []
        for i in (0, 1):
            given = np.zeros((len(x) + 1, 3 * h), np.float32)
            given[1:] = x @ p[f"X{i}"] + p[f"b{i}"]
            state = np.zeros((len(rows), h), np.float32)
            for t in range(WINDOW) if i == 0 else range(WINDOW - 1, -1, -1):
                g = given[rows[:, t]]
                zr = _sigmoid(g[:, : 2 * h] + state @ p[f"U{i}"])
                z, r = zr[:, :h] * there[:, t : t + 1], zr[:, h:]
                inner = state @ p[f"N{i}"]
                n = np.tanh(g[:, 2 * h :] + r * inner)
                if keep:
                    tape.append((i, t, state, z, r, inner, n, zr[:, :h]))
                state = state + z * (n - state)
                states[:, t, i * h : (i + 1) * h] = state
        mid = np.tanh(states @ p["A"])
        score = np.where(there > 0, mid @ p["a"], -1e9)
        weight = np.exp(score - score.max(1, keepdims=True))
        weight /= weight.sum(1, keepdims=True)
        pooled = (weight[:, :, None] * states).sum(1)
        logits = pooled @ p["o"] + p["k"]
        return (logits, (there, states, tape, mid, weight, pooled)) if keep else logits

    def backward(self, x, rows, saved, error) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Gradients of the dense parameters, and of x; error: of each logit."""
        p, h = self.p, HIDDEN
        there, states, tape, mid, weight, pooled = saved
        g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("w", "c")}
        g["o"], g["k"] = error @ pooled, error.sum(keepdims=True)
        d_pooled = error[:, None] * p["o"]
        d_states = weight[:, :, None] * d_pooled[:, None, :]
        d_weight = (states * d_pooled[:, None, :]).sum(2)
        d_score = weight * (d_weight - (weight * d_weight).sum(1, keepdims=True))
        g["a"] = np.einsum("bt,bth->h", d_score, mid)
        d_mid = d_score[:, :, None] * p["a"] * (1 - mid * mid)
        g["A"] = np.einsum("bts,bth->sh", states, d_mid)
        d_states += d_mid @ p["A"].T
        at_word = {i: np.empty((WINDOW, len(rows), 3 * h), np.float32) for i in (0, 1)}
        back = {i: np.zeros((len(rows), h), np.float32) for i in (0, 1)}
        for i, t, state, z, r, inner, n, raw in reversed(tape):
            d = back[i] + d_states[:, t, i * h : (i + 1) * h]
            d_n = d * z * (1 - n * n)
            d_z = d * (n - state) * there[:, t : t + 1] * raw * (1 - raw)
            d_r = d_n * inner * r * (1 - r)
            d_inner = d_n * r
            zr = np.concatenate([d_z, d_r], 1)
            g[f"U{i}"] += state.T @ zr
            g[f"N{i}"] += state.T @ d_inner
            back[i] = d * (1 - z) + zr @ p[f"U{i}"].T + d_inner @ p[f"N{i}"].T
            at_word[i][t, :, : 2 * h], at_word[i][t, :, 2 * h :] = zr, d_n
        d_x = np.zeros_like(x)
        where = rows.T.ravel()
        order = np.argsort(where, kind="stable")
        begin = np.searchsorted(where[order], np.arange(1, len(x) + 1))
        for i in (0, 1):
            d_in = np.add.reduceat(at_word[i].reshape(-1, 3 * h)[order], begin, axis=0)
            g[f"X{i}"], g[f"b{i}"] = x.T @ d_in, d_in.sum(0)
            d_x += d_in @ p[f"X{i}"].T
        return g, d_x

    def logits(self, x: np.ndarray, rows: np.ndarray) -> np.ndarray:
        out = [self.forward(x, rows[i : i + SCORED_AT_ONCE]) for i in range(0, len(rows), SCORED_AT_ONCE)]
        return np.concatenate(out) if out else np.zeros(0, np.float32)


def score_texts(net: Network, texts: list[str | None]) -> np.ndarray:
    """The worst window of each text; 0 for texts without words."""
    words, ids = numbered([words_of(t) for t in texts])
    scores = np.zeros(len(texts))
    if not words:
        return scores
    x = net.inputs(*parts_of(words))
    starts = [starts_of(len(i)) for i in ids]
    counts = np.array([len(s) for s in starts])
    rows = np.concatenate([windows_of(i, s) for i, s in zip(ids, starts) if len(s)])
    logits = net.logits(x, rows)
    full = counts > 0
    first = (np.cumsum(counts) - counts)[full]
    worst = np.maximum.reduceat(logits, first)
    scores[full] = _sigmoid(net.scale * worst.astype(np.float64) + net.shift)
    return scores


# --- training -------------------------------------------------------------------------


def train(texts: list[str], labels: list[int], seed: int = 7, rounds: int = ROUNDS) -> Network:
    """``texts``: words joined by blanks, as sampled."""
    net = Network.fresh(seed)
    y = np.asarray(labels, np.float32)
    words, ids = numbered([t.split(" ") for t in texts])
    if not words or y.min() == y.max():
        # Nothing to tell apart: every text with words has the one score there is.
        net.p["k"][:] = 4.0 if len(y) and y.min() == 1 else -4.0
        net.p["o"][:] = 0
        return net
    buckets, grams, first = parts_of(words)
    many = np.diff(np.append(first, len(grams)))
    rng = np.random.default_rng(seed)
    rows, owner = [], []
    for n, i in enumerate(ids):
        starts = np.array(starts_of(len(i)))
        if len(starts) > MAX_WINDOWS:
            starts = np.sort(rng.choice(starts, MAX_WINDOWS, replace=False))
        rows.append(windows_of(i, starts))
        owner.append(np.full(len(starts), n))
    rows, owner = np.concatenate(rows), np.concatenate(owner)
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.p.items() if k not in "wc"}
    spread = {k: np.full(BUCKETS, 1e-8, np.float32) for k in "wc"}
    step = 0

    def learn(chosen: np.ndarray) -> None:
        nonlocal step
        part = rows[chosen]
        own, inverse = np.unique(part, return_inverse=True)
        zero = int(own[0] == 0)
        local = inverse.reshape(part.shape) + (1 - zero)
        own = own[zero:] - 1
        n = many[own]
        mine = np.cumsum(n) - n
        flat = grams[np.repeat(first[own] - mine, n) + np.arange(n.sum())]
        x = net.inputs(buckets[own], flat, mine)
        logits, saved = net.forward(x, local, keep=True)
        target = y[owner[chosen]]
        share = max(1e-3, float(target.mean()))
        balance = np.where(target > 0, 0.5 / share, 0.5 / max(1e-3, 1 - share))
        error = ((_sigmoid(logits) - target) * balance / len(part)).astype(np.float32)
        g, d_x = net.backward(x, local, saved, error)
        step += 1
        for k, d in g.items():
            m, v = moment[k]
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            net.p[k] -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        parts = (("w", buckets[own], d_x[:, :WORD_DIM]),
                 ("c", flat, np.repeat(d_x[:, WORD_DIM:] / n[:, None], n, axis=0)))
        for k, at, d in parts:
            order = np.argsort(at, kind="stable")
            at = at[order]
            begin = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
            d = np.add.reduceat(d[order], begin, axis=0)
            at = at[begin]
            spread[k][at] += (d * d).mean(1)
            net.p[k][at] -= 0.1 * d / np.sqrt(spread[k][at])[:, None]

    def worst() -> tuple[np.ndarray, np.ndarray]:
        """Windows by text, the highest first; the logits of all."""
        logits = net.logits(net.inputs(buckets, grams, first), rows)
        return np.lexsort((-logits, owner)), logits

    begins = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    doubtful = np.log(DOUBTFUL / (1 - DOUBTFUL))
    chosen = np.arange(len(rows))
    for round_ in range(rounds):
        if round_:
            order, logits = worst()
            ends = np.append(begins[1:], len(rows))
            # Of a clean text its four highest windows, and some at random; of a toxic
            # one the highest, unless it is so low that the label is doubtful.
            top = [
                order[b : min(e, b + (1 if y[owner[b]] else 4))]
                for b, e in zip(begins, ends)
                if not y[owner[b]] or logits[order[b]] > doubtful
            ]
            clean = np.flatnonzero(y[owner] == 0)
            chosen = np.unique(np.concatenate([*top, rng.choice(clean, min(len(clean), 3 * len(y)))]))
        for _ in range(2 if round_ else 1):
            mixed = rng.permutation(chosen)
            for at in range(0, len(mixed), BATCH):
                learn(mixed[at : at + BATCH])
    order, logits = worst()
    net.scale, net.shift = _calibrate(np.maximum.reduceat(logits, begins), y[owner[begins]])
    return net


def _calibrate(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic fit of the labels to the texts' highest logits."""
    u = np.stack([logits.astype(np.float64), np.ones(len(y))], 1)
    b = np.array([1.0, 0.0])
    for _ in range(50):
        q = _sigmoid(u @ b)
        step = np.linalg.solve(u.T @ (u * (q * (1 - q))[:, None]) + 1e-2 * np.eye(2), u.T @ (q - y) + 1e-2 * (b - [1, 0]))
        b = b - np.clip(step, -1, 1)
    return max(float(b[0]), 1e-3), float(b[1])


def train_fold(doc_id: str = "doc_id") -> Column:
    return fold(doc_id, 5) != 0


def learn(
    docs: DataFrame,
    labels: DataFrame,
    max_positive: int = MAX_POSITIVE,
    max_negative: int = MAX_NEGATIVE,
    **options,
) -> Network:
    """Trained on the rows of ``labels`` outside the held-out fold that have a document.

    Null labels and ids are left out; of several labels of one id the highest holds."""
    known = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where(train_fold() & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    picked = []
    for label, most in ((1, max_positive), (0, max_negative)):
        ordered = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id")
        picked += ordered.limit(most).collect()
    spark = docs.sparkSession
    # At most max_positive + max_negative rows.
    ids = F.broadcast(spark.createDataFrame(picked, known.schema))
    texts = docs.select("doc_id", "text").join(ids, "doc_id").dropDuplicates(["doc_id"])

    def make():
        return lambda texts: [[" ".join(words_of(t)) for t in texts]]

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist() if r["words"]]
        rows.sort(key=lambda r: r["doc_id"])
        net = train([r["words"] for r in rows], [r["toxic"] for r in rows], **options)
        taken = [sum(r["toxic"] == v for r in rows) for v in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(net)]), *(pa.array([n]) for n in taken)], ["net", "clean", "toxic"])

    rows = stored(map_texts(texts, "text", [("words", pa.string())], make, ["doc_id", "toxic"]), "sample")
    # One task has the sample, which is bounded, and what it takes goes with it.
    made = rows.coalesce(1).mapInArrow(fit, "net binary, clean bigint, toxic bigint").first()
    net = pickle.loads(bytes(made["net"]))
    # The sample has another share of toxic texts than the labels: correct the prior.
    all_of = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if made["clean"] and made["toxic"] and len(all_of) == 2:
        net.shift += float(np.log(all_of[1] / all_of[0]) - np.log(made["toxic"] / made["clean"]))
    return net


# --- scoring ------------------------------------------------------------------------


def score(
    docs: DataFrame,
    net: Network,
    text: str = "text",
    keep: list[str] | None = None,
    prefix: str = "",
) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (score >= 1/2).

    Null texts and texts without words score 0.  Rows are judged one by one, so
    repeated rows score alike."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def make():
        own = shared.value

        def work(texts: list[str | None]) -> list:
            scores = score_texts(own, texts)
            return [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]

        return work

    schema = [(prefix + "score", pa.float64()), (prefix + "predicted", pa.int32())]
    return map_texts(docs, text, schema, make, keep, SLICE_BYTES)


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    net = learn(docs, labels, **options)
    rows = docs.select("doc_id", "text", (~train_fold()).alias("held_out"))
    return score(rows, net, keep=["doc_id", "held_out"])


def civil_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Rows that are not predicted toxic, columns unchanged."""
    found = score(docs, learn(docs, labels, **options), prefix="__found_")
    return found.where(F.col("__found_predicted") == 0).select(*docs.columns)
