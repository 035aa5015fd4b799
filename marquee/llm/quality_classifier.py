"""Quality classifier: random-indexing word vectors pooled per document, a two-layer network, calibrated.

Method: words are hashed to CELLS cells. A cell's index vector is sparse, one +1 and one -1 in DIMS places,
both fixed by its hash. Over the whole corpus, every word adds the index vectors of its neighbours within
SPAN words to its own context vector, a running sum of counts. A word's vector is its context vector with
counts damped by a square root, the corpus mean taken out and the length set to one. A document is pooled
from its words: mean, spread (root mean square) and the share of words in each of SHAPES word shapes. A
network with one hidden layer is fitted in numpy on labelled documents, and its logits are divided by a
temperature fitted on labelled documents that it has not seen.

What is bounded: the context table has CELLS x DIMS numbers; the fit uses at most FIT labelled documents, in
the order of a hash of their ids. Everything else covers all rows: the context vectors all documents, the
scores all documents. Scores use the text alone.

Defined cases: null and empty texts have the zero vector and get the score the network gives it; without
labels of both kinds every score is the share of label 1 (0.5 without any); repeated rows get equal scores;
an empty table gives an empty table; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import sys
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.common import text_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELLS = 1 << 14
DIMS = 32
SPAN = 2
FIT = 20_000
HIDDEN = 24
EPOCHS = 60
RATE = 0.01
DECAY = 1e-4
SHAPES = 6
FEATURES = 2 * DIMS + SHAPES
BLOCK = 100_000            # words handled at a time
REMEMBERED = 150_000       # words whose hash a task remembers before it starts afresh


class Cells(dict):
    """word -> cell * SHAPES + shape, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        letters = sum(65 <= b <= 90 or 97 <= b <= 122 or b > 127 for b in word)
        shape = (0 if letters == len(word) and word == word.lower() else 1 if letters == len(word) and word[1:] == word[1:].lower()
                 else 2 if word.isdigit() else 3 if letters == 0 else 4 if word.upper() == word and letters > 1 else 5)
        cell = self[word] = zlib.crc32(word) % CELLS * SHAPES + shape
        return cell


def index_places() -> tuple[np.ndarray, np.ndarray]:
    """Place of the +1 and of the -1 of every cell's index vector."""
    mixed = (np.arange(CELLS, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    plus = ((mixed >> np.uint64(20)) % np.uint64(DIMS)).astype(np.int64)
    minus = (plus + 1 + ((mixed >> np.uint64(40)) % np.uint64(DIMS - 1)).astype(np.int64)) % DIMS
    return plus, minus


def _blocks(texts):
    """Runs of whole texts: (cells and shapes of all words, number of words of each text)."""
    known, ids, sizes = Cells(), [], []
    for text in texts:
        found = text.encode().split()
        ids += [known[w] for w in found]
        sizes.append(len(found))
        if len(ids) >= BLOCK:
            yield np.array(ids, dtype=np.int64), np.array(sizes)
            ids, sizes = [], []
    if sizes:
        yield np.array(ids, dtype=np.int64), np.array(sizes)


def context_counts(docs: DataFrame) -> DataFrame:
    """cell, n (words) and context (DIMS sums) over all documents; tasks add up theirs first."""
    def run(batches):
        plus, minus = index_places()
        total, seen = np.zeros(CELLS * DIMS, dtype=np.int64), np.zeros(CELLS, dtype=np.int64)
        for batch in batches:
            for ids, sizes in _blocks(batch.column(0).to_pylist()):
                cell = ids // SHAPES
                text = np.repeat(np.arange(len(sizes)), sizes)
                seen += np.bincount(cell, minlength=CELLS)
                for gap in range(1, SPAN + 1):
                    near = text[gap:] == text[:-gap]
                    a, b = cell[gap:][near], cell[:-gap][near]
                    for word, other in ((a, b), (b, a)):
                        total += np.bincount(word * DIMS + plus[other], minlength=CELLS * DIMS)
                        total -= np.bincount(word * DIMS + minus[other], minlength=CELLS * DIMS)
        used = np.flatnonzero(seen)
        rows = total.reshape(CELLS, DIMS)[used]
        yield pa.RecordBatch.from_arrays([
            pa.array(used), pa.array(seen[used]), pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), DIMS).cast(pa.list_(pa.int64()))],
            names=["cell", "n", "context"])

    parts = docs.select(text_of("text")).mapInArrow(run, "cell bigint, n bigint, context array<bigint>")
    sums = [F.sum(F.get("context", i)).alias(f"c{i}") for i in range(DIMS)]
    return parts.groupBy("cell").agg(F.sum("n").alias("n"), *sums)


def word_vectors(counts: DataFrame) -> np.ndarray:
    """CELLS x DIMS vectors from the context table, which has at most CELLS rows."""
    rows = counts.collect()
    out, n = np.zeros((CELLS, DIMS)), np.zeros(CELLS)
    for r in rows:
        out[r["cell"]], n[r["cell"]] = r[2:], r["n"]
    out = np.sign(out) * np.sqrt(np.abs(out))
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    mean = (out * n[:, None]).sum(axis=0) / max(n.sum(), 1)
    out = np.where(n[:, None] > 0, out - mean, 0)
    return (out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pool(texts: list[str], vectors: np.ndarray) -> np.ndarray:
    """Features of each text: mean and spread of its word vectors, shares of word shapes."""
    out = []
    for ids, sizes in _blocks(texts):
        cell, shape = ids // SHAPES, ids % SHAPES
        pooled = np.zeros((len(sizes), FEATURES), dtype=np.float32)
        some = np.flatnonzero(sizes)
        if len(some):
            starts = (np.cumsum(sizes) - sizes)[some]
            mine = vectors[cell]
            n = sizes[some][:, None]
            pooled[some, :DIMS] = np.add.reduceat(mine, starts, axis=0) / n
            pooled[some, DIMS:2 * DIMS] = np.sqrt(np.add.reduceat(mine * mine, starts, axis=0) / n)
            shapes = np.eye(SHAPES, dtype=np.float32)[shape]
            pooled[some, 2 * DIMS:] = np.add.reduceat(shapes, starts, axis=0) / n
        out.append(pooled)
    return np.concatenate(out) if out else np.zeros((0, FEATURES), dtype=np.float32)


class Network:
    """Two layers (tanh, logistic), inputs standardised, logits over a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        held = np.arange(len(x)) % 5 == 4  # unseen by the layers, for the temperature
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        z = (x - self.mean) / self.scale
        p = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN),
             rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        m, s, step = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p], 0
        fit = np.flatnonzero(~held) if (~held).any() else np.arange(len(x))
        for _ in range(EPOCHS):
            order = rng.permutation(fit)
            for at in range(0, len(order), 256):
                i = order[at:at + 256]
                h = np.tanh(z[i] @ p[0] + p[1])
                d = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3][0], -30, 30))) - y[i]) / len(i)
                back = d[:, None] * p[2] * (1 - h * h)
                grads = [z[i].T @ back + DECAY * p[0], back.sum(axis=0), h.T @ d + DECAY * p[2], np.array([d.sum()])]
                step += 1
                for k, g in enumerate(grads):  # Adam
                    m[k] += 0.1 * (g - m[k])
                    s[k] += 0.001 * (g * g - s[k])
                    p[k] = p[k] - RATE * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(s[k] / (1 - 0.999 ** step)) + 1e-8)
        self.layers, self.temperature = p, 1.0
        if held.any():
            logits = self.logits(x[held])
            tries = np.exp(np.linspace(np.log(0.25), np.log(8), 80))
            loss = [np.mean(np.logaddexp(0, -np.where(y[held] > 0, 1, -1) * logits / t)) for t in tries]
            self.temperature = float(tries[int(np.argmin(loss))])

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -10, 10)
        return np.tanh(z @ self.layers[0] + self.layers[1]) @ self.layers[2] + self.layers[3][0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, most: int = FIT):
    """(word vectors, network or None, share of label 1), learned from labels that are not held out."""
    vectors = word_vectors(context_counts(docs))
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "quality")
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(most).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    table = docs.sparkSession.sparkContext.broadcast(vectors)

    @F.pandas_udf("array<float>")
    def features(texts: pd.Series) -> pd.Series:
        return pd.Series(list(pool(texts.tolist(), table.value)))

    # at most FIT ids are broadcast, at most FIT rows of FEATURES numbers come back
    rows = docs.join(F.broadcast(sample), "doc_id").select("doc_id", text_of("text").alias("text"), "quality").select(
        "doc_id", features("text").alias("v"), "quality").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()
    y = np.array([r["quality"] for r in rows], dtype=float)
    network = Network(np.array([r["v"] for r in rows], dtype=float), y) if len(set(y)) > 1 else None
    return vectors, network, float(y.mean()) if len(y) else 0.5


def with_score(docs: DataFrame, model, name: str = "score") -> DataFrame:
    """The documents, all their columns, and the probability of label 1. Map-side only."""
    vectors, network, constant = model
    table = docs.sparkSession.sparkContext.broadcast(vectors)

    @F.pandas_udf("double")
    def apply(texts: pd.Series) -> pd.Series:
        if network is None:
            return pd.Series(np.full(len(texts), constant))
        return pd.Series(network.score(pool(texts.tolist(), table.value).astype(float)))

    return docs.withColumn(name, apply(text_of("text")))


def score(docs: DataFrame, labels: DataFrame, most: int = FIT) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels, most))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
