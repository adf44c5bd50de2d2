"""Quality classifier with supervised subword embeddings.

A document is the average of learned vectors: of its hashed words, of their character trigrams
and of its hashed word pairs. A softmax over the two labels reads the average; all is
trained together by stochastic gradient descent in numpy on a bounded labelled sample.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, quoted, whole
from tidemark.llm.windows import (GRAM_BUCKETS, WORD_BUCKETS, WORD_CHARS, hashed, labelled_sample,
                                  natural_share, word_features)

SIZE = 8
PAIR_BUCKETS = 1 << 15
REPEATED = 0                # the bucket of all pairs of equal words
PER_CLASS, MAX_CHARS = 2_000, 20_000
BATCH, STEPS, RATE = 32, 1_200, 0.3
THRESHOLD = 0.3
SEED = 11
CACHE_WORDS = 300_000

_words = re.compile(r"\S{1,%d}" % WORD_CHARS).findall
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
# the three tables lie one after another
_GRAM_AT, _PAIR_AT = WORD_BUCKETS, WORD_BUCKETS + GRAM_BUCKETS
_ROWS = _PAIR_AT + PAIR_BUCKETS


def pair_buckets(sums: np.ndarray) -> np.ndarray:
    """Of each two words that follow one another."""
    a, b = sums[:-1], sums[1:]
    out = hashed(a * _PAIR ^ b, PAIR_BUCKETS)
    out[a == b] = REPEATED
    return out


class Model:
    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.vectors = np.zeros((_ROWS, SIZE), np.float32)
        self.softmax = (rng.standard_normal((SIZE, 2)) * 0.5).astype(np.float32)
        self.bias = np.zeros(2, np.float32)

    def probability(self, averages: np.ndarray) -> np.ndarray:
        z = (averages @ self.softmax + self.bias).astype(np.float64)
        return 1 / (1 + np.exp(z[:, 0] - z[:, 1]))


class Lexicon:
    """Numbers words as they come and keeps each one's hash, and its vector for a given model."""

    def __init__(self, model: Model):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.sums = np.empty(0, np.uint64)
        self.table = np.empty((0, SIZE), np.float32)

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.number) > CACHE_WORDS:
            self.reset()
        out = []
        for text in texts:
            words = _words(text)
            out.append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)))
        new = list(self.number)[len(self.sums):]
        if new:
            sums, grams, starts = word_features(new)
            counts = np.diff(np.r_[starts, grams.size])
            vectors = self.model.vectors
            means = np.add.reduceat(vectors[_GRAM_AT + grams], starts, axis=0) / counts[:, None]
            self.table = np.concatenate([self.table, vectors[hashed(sums, WORD_BUCKETS)] + means.astype(np.float32)])
            self.sums = np.concatenate([self.sums, sums])
        return out

    def averages(self, texts: list[str]) -> np.ndarray:
        """Mean word vector plus mean pair vector; zeros where there is none."""
        out = np.zeros((len(texts), SIZE), np.float32)
        for at, ids in enumerate(self.numbers(texts)):
            if len(ids):
                out[at] = self.table[ids].mean(axis=0)
            if len(ids) > 1:
                out[at] += self.model.vectors[_PAIR_AT + pair_buckets(self.sums[ids])].mean(axis=0)
        return out


def _features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each text, the rows of the tables that its average takes, and their weights."""
    lexicon = Lexicon(Model())
    numbers = lexicon.numbers(texts)
    words = list(lexicon.number)
    sums, grams, starts = word_features(words)
    counts = np.diff(np.r_[starts, grams.size])
    buckets, out = hashed(sums, WORD_BUCKETS), []
    for ids in numbers:
        n = len(ids)
        if not n:
            out.append((np.empty(0, np.int32), np.empty(0, np.float32)))
            continue
        used, times = np.unique(ids, return_counts=True)
        c = counts[used]
        at = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c) + np.repeat(starts[used], c)
        pairs, often = np.unique(pair_buckets(sums[ids]), return_counts=True)
        out.append((np.concatenate([buckets[used], _GRAM_AT + grams[at], _PAIR_AT + pairs]),
                    np.concatenate([times / n, np.repeat(times / n / c, c), often / max(1, n - 1)]).astype(np.float32)))
    return out


def train(texts: list[str], y: np.ndarray, natural: float | None = None, seed: int = SEED) -> Model:
    """``natural`` is the share of label 1 where the sample is drawn from; scores are set to it."""
    model, rng = Model(seed), np.random.default_rng(seed)
    share = (y.sum() + 1) / (len(y) + 2) if natural is None else natural
    offset = np.float32(np.log(share / (1 - share)))
    if len(set(y.tolist())) == 2:
        features = _features(texts)
        yes, no = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        for step in range(STEPS):
            rate = RATE * (1 - step / STEPS)
            batch = np.r_[rng.choice(yes, BATCH // 2), rng.choice(no, BATCH // 2)]
            rows = np.concatenate([features[i][0] for i in batch])
            weights = np.concatenate([features[i][1] for i in batch])
            sizes = np.array([len(features[i][0]) for i in batch])
            owner = np.repeat(np.arange(BATCH), sizes)
            parts = model.vectors[rows] * weights[:, None]
            averages = np.stack([np.bincount(owner, parts[:, d], BATCH) for d in range(SIZE)], axis=1)
            gap = model.probability(averages.astype(np.float32)) - y[batch]
            slope = np.stack([-gap, gap], axis=1).astype(np.float32)
            on_averages = slope @ model.softmax.T
            model.softmax -= rate / BATCH * (averages.T.astype(np.float32) @ slope)
            model.bias -= rate / BATCH * slope.sum(axis=0)
            used, place = np.unique(rows, return_inverse=True)
            pull = on_averages[owner] * weights[:, None]
            model.vectors[used] -= rate * np.stack(
                [np.bincount(place, pull[:, d], len(used)) for d in range(SIZE)], axis=1).astype(np.float32)
    # the batches were half and half; the scores are to be probabilities where documents come from
    model.bias[1] += offset
    return model


def _score_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                averages = lexicon.averages([t.as_py() for t in part.column(1)])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(shared.value.probability(averages))], names=["key", "score"])

    return run


def fitted(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Model:
    texts, y = labelled_sample(docs, labels, "quality", per_class, max_chars)
    return train(texts, y, natural_share(labels, "quality"))


def scored(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """``key, score`` of every row; texts without words, null or empty, score as the average does."""
    shared = docs.sparkSession.sparkContext.broadcast(model)        # 2.6 MB, whatever the corpus
    frame = docs.select(docs[quoted(key)].cast("long").alias("key"), whole(docs["text"]).alias("text"))
    return frame.mapInArrow(_score_batches(shared), "key long, score double").withColumnRenamed("key", key)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each document; held-out labels are never learnt."""
    return scored(docs, fitted(docs, labels)).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
