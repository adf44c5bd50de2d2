"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word's input is a learned vector of the word beside the mean of learned vectors of its
character trigrams. The network reads overlapping windows of words in both directions,
weighs the states by attention, and gives each window a score; a document scores as its
worst window. It is trained in numpy on a bounded sample of labelled documents: only whole
documents are labelled, so each step learns from the window that now scores highest.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, quoted, whole
from tidemark.llm.windows import GRAM_BUCKETS, WORD_CHARS, labelled_sample, natural_share, word_features

WINDOW, STRIDE = 32, 24
PART = 8                    # components from the word, and as many from its characters
HIDDEN = 8                  # states of each direction
PER_CLASS, MAX_CHARS = 1_000, 20_000
BATCH = 48
SEED = 7
ROUNDS, RATE, GRAM_RATE, DAMPING = 12, 0.5, 0.1, 1e-3   # of the vectors: Adagrad from a floor, so rare ones move little
VOCABULARY, LEAST_DOCS = 20_000, 3
CACHE_WORDS = 150_000
CHUNK = 2_048               # windows scored at once

_words = re.compile(r"\w{1,%d}" % WORD_CHARS).findall


def window_starts(n: int) -> np.ndarray:
    """Windows over n words: every word is in one, neighbours overlap, the last one ends the text."""
    if n <= WINDOW:
        return np.zeros(1, np.int64)
    starts = np.arange(0, n - WINDOW + STRIDE, STRIDE)
    starts[-1] = n - WINDOW
    return starts


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


class Network:
    """The parameters, and window scores with or without gradients.

    Word 0 of the inputs is padding: no input, no attention unless nothing else is there.
    Words outside the vocabulary have no vector of their own, only their characters'.
    """

    def __init__(self, vocabulary: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)

        def small(*shape: int, scale: float = 0.3) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.vocabulary = {w: at + 1 for at, w in enumerate(vocabulary)}
        # from zero: what the sample says little about stays near nothing
        self.words = np.zeros((len(vocabulary) + 1, PART), np.float32)
        self.grams = np.zeros((GRAM_BUCKETS, PART), np.float32)
        self.dense = {
            "input": small(2, 2 * PART, 3 * HIDDEN), "bias": np.zeros((2, 1, 3 * HIDDEN), np.float32),
            "gates": small(2, HIDDEN, 2 * HIDDEN), "state": small(2, HIDDEN, HIDDEN),
            "look": small(2, HIDDEN), "out": small(2, HIDDEN), "shift": np.full(1, -1.0, np.float32)}

    def places(self, words: list[str]) -> np.ndarray:
        return np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int32, len(words))

    def vectors(self, words: list[str]) -> np.ndarray:
        """Word and character parts; the padding word is empty and gets zeros."""
        _, grams, starts = word_features(words)
        if not words:
            return np.zeros((0, 2 * PART), np.float32)
        counts = np.diff(np.r_[starts, grams.size])
        means = np.zeros((len(words), PART), np.float32)
        some = counts > 0
        means[some] = np.add.reduceat(self.grams[grams], starts[some], axis=0) / counts[some, None]
        return np.concatenate([self.words[self.places(words)], means], axis=1)

    def projected(self, vectors: np.ndarray) -> np.ndarray:
        """What each word adds to the gates of both directions: 2 x words x 3 HIDDEN."""
        return np.matmul(vectors[None], self.dense["input"]) + self.dense["bias"]

    def _run(self, table: np.ndarray, ids: np.ndarray, keep: bool):
        """States of all steps, 2 x T x B x HIDDEN; direction 1 reads from the end."""
        b, steps = ids.shape
        h = np.zeros((2, b, HIDDEN), np.float32)
        states = np.empty((steps, 2, b, HIDDEN), np.float32)
        kept = []
        x = np.empty((2, b, 3 * HIDDEN), np.float32)
        for t in range(steps):
            np.take(table[0], ids[:, t], axis=0, out=x[0], mode="clip")
            np.take(table[1], ids[:, steps - 1 - t], axis=0, out=x[1], mode="clip")
            gates = np.matmul(h, self.dense["gates"])
            gates += x[:, :, :2 * HIDDEN]
            _sigmoid(gates)
            z, r = gates[:, :, :HIDDEN], gates[:, :, HIDDEN:]
            new = np.matmul(r * h, self.dense["state"])
            new += x[:, :, 2 * HIDDEN:]
            np.tanh(new, out=new)
            if keep:
                kept.append((h.copy(), z, r, new))
            h = h + z * (new - h)
            states[t] = h
        return states, kept

    def _pool(self, states: np.ndarray, ids: np.ndarray):
        """Attention, what each step says, and the logits."""
        steps = len(states)
        both = np.stack([self.dense["look"], self.dense["out"]], axis=2)       # 2 x H x 2
        seen = np.matmul(states, both)                                         # T x 2 x B x 2
        seen = seen[:, 0] + seen[::-1, 1]                                      # T x B x 2
        hidden = ids.T == 0
        hidden[0, hidden.all(axis=0)] = False
        look = np.where(hidden, np.float32(-30), seen[:, :, 0])
        weight = np.exp(look - look.max(axis=0))
        weight *= ~hidden
        weight /= weight.sum(axis=0)
        logit = (weight * seen[:, :, 1]).sum(axis=0) + self.dense["shift"][0]
        assert len(weight) == steps
        return weight, seen[:, :, 1], logit

    def scores(self, table: np.ndarray, ids: np.ndarray) -> np.ndarray:
        out = np.empty(len(ids), np.float32)
        for at in range(0, len(ids), CHUNK):
            part = ids[at:at + CHUNK]
            out[at:at + CHUNK] = self._pool(self._run(table, part, False)[0], part)[2]
        return out

    def gradients(self, table: np.ndarray, vectors: np.ndarray, ids: np.ndarray, y: np.ndarray
                  ) -> tuple[dict[str, np.ndarray], np.ndarray]:
        """Of the mean log loss: for the dense parameters, and for the word vectors."""
        d = self.dense
        states, kept = self._run(table, ids, True)
        weight, said, logit = self._pool(states, ids)
        steps, b = weight.shape
        slope = ((1 / (1 + np.exp(-logit)) - y) / b).astype(np.float32)
        grow = {k: np.zeros_like(v) for k, v in d.items()}
        grow["shift"][0] = slope.sum()
        on_said = weight * slope
        on_look = weight * (said - (weight * said).sum(axis=0)) * slope
        on_x = np.zeros((2, len(vectors), 3 * HIDDEN), np.float32)
        flipped = (slice(None), slice(None, None, -1))
        carry = np.zeros((2, b, HIDDEN), np.float32)
        for t in range(steps - 1, -1, -1):
            says = np.stack([on_said[t], on_said[flipped[1]][t]])
            looks = np.stack([on_look[t], on_look[flipped[1]][t]])
            grow["out"] += np.matmul(says[:, None, :], states[t])[:, 0]
            grow["look"] += np.matmul(looks[:, None, :], states[t])[:, 0]
            dh = carry + says[:, :, None] * d["out"][:, None] + looks[:, :, None] * d["look"][:, None]
            h, z, r, new = kept[t]
            d_new = dh * z * (1 - new * new)
            rh = r * h
            d_rh = np.matmul(d_new, d["state"].transpose(0, 2, 1))
            d_z, d_r = dh * (new - h) * z * (1 - z), d_rh * h * r * (1 - r)
            d_gates = np.concatenate([d_z, d_r], axis=2)
            grow["state"] += np.matmul(rh.transpose(0, 2, 1), d_new)
            grow["gates"] += np.matmul(h.transpose(0, 2, 1), d_gates)
            carry = dh * (1 - z) + d_rh * r + np.matmul(d_gates, d["gates"].transpose(0, 2, 1))
            d_x = np.concatenate([d_gates, d_new], axis=2)
            np.add.at(on_x[0], ids[:, t], d_x[0])
            np.add.at(on_x[1], ids[:, steps - 1 - t], d_x[1])
        grow["bias"] = on_x.sum(axis=1, keepdims=True)
        grow["input"] = np.matmul(vectors.T[None], on_x)
        return grow, np.matmul(on_x, d["input"].transpose(0, 2, 1)).sum(axis=0)


class _Numbers(dict):
    """Of words, as they come. Without a reference to itself, so that it goes when its last user does."""

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        return at


class Lexicon:
    """Numbers words as they come, 0 being padding, and keeps what the network adds for each."""

    def __init__(self, network: Network):
        self.network = network
        self.room = np.empty((2, 1024, 3 * HIDDEN), np.float32)
        self.reset()

    def reset(self) -> None:
        self.number = _Numbers({"": 0})
        self.known = 0

    def windows(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Window word numbers and, for each window, the index of its text."""
        if len(self.number) > CACHE_WORDS:
            self.reset()
        numbered_texts = []
        for text in texts:
            words = _words(text.lower())
            numbered_texts.append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)))
        lengths = [len(x) for x in numbered_texts]
        starts = [window_starts(n) for n in lengths]
        owner = np.repeat(np.arange(len(texts)), [len(s) for s in starts])
        flat = np.concatenate([*numbered_texts, np.zeros(WINDOW, np.int32)])
        first = np.cumsum([0, *lengths])[:-1]
        at = (first[owner] + np.concatenate(starts))[:, None] + np.arange(WINDOW)
        ids = flat[np.minimum(at, len(flat) - 1)]
        ids[at >= (first + lengths)[owner][:, None]] = 0
        return ids, owner

    def table_now(self) -> np.ndarray:
        """Of the words so far. New ones go into the room that is left, which doubles when it is
        full: a copy of the table for every few texts would leave the worker's memory in pieces."""
        known, now = self.known, len(self.number)
        if now > self.room.shape[1]:
            room = np.empty((2, max(now, 2 * self.room.shape[1]), 3 * HIDDEN), np.float32)
            room[:, :known] = self.room[:, :known]
            self.room = room
        if now > known:
            new = list(islice(self.number, known, None))
            if not known:
                self.room[:, :1] = self.network.projected(np.zeros((1, 2 * PART), np.float32))
                known, new = 1, new[1:]
            if new:
                self.room[:, known:now] = self.network.projected(self.network.vectors(new))
            self.known = now
        return self.room[:, :now]


class _Adam:
    def __init__(self, rate: float):
        self.rate, self.moments, self.turn = rate, {}, 0

    def step(self, values: dict[str, np.ndarray], slopes: dict[str, np.ndarray]) -> None:
        self.turn += 1
        for k, g in slopes.items():
            m, v = self.moments.setdefault(k, (np.zeros_like(g), np.zeros_like(g)))
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            values[k] -= self.rate * (m / (1 - 0.9 ** self.turn)) / (
                np.sqrt(v / (1 - 0.999 ** self.turn)) + 1e-7)


def _vocabulary(texts: list[str]) -> list[str]:
    """The words in several of the sample's documents, the most widespread first."""
    spread = Counter(w for text in texts for w in set(_words(text.lower())))
    known = sorted((-n, w) for w, n in spread.items() if n >= LEAST_DOCS)
    return [w for _, w in known[:VOCABULARY]]


def _adagrad(values: np.ndarray, sums: np.ndarray, at: np.ndarray, slope: np.ndarray, rate: float) -> None:
    rows, place = np.unique(at, return_inverse=True)
    total = np.zeros((len(rows), slope.shape[1]), np.float32)
    np.add.at(total, place, slope)
    sums[rows] += (total * total).mean(axis=1, keepdims=True)
    values[rows] -= rate * total / (np.sqrt(sums[rows]) + 1e-6)


def train(texts: list[str], y: np.ndarray, natural: float | None = None, seed: int = SEED) -> Network:
    """Learn from whole documents. With one label only, the network says how rare the other is.

    ``natural`` is the share of toxic ones where the sample is drawn from; scores are set to it.
    """
    network = Network(_vocabulary(texts), seed)
    order = np.random.default_rng(seed).permutation(len(y))
    texts, y = [texts[i] for i in order], y[order]
    if len(set(y.tolist())) < 2:
        network.dense["out"][:] = 0
        network.dense["shift"][0] = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
        return network
    rng = np.random.default_rng(seed)
    lexicon = Lexicon(network)
    ids, owner = lexicon.windows(texts)
    words = list(lexicon.number)
    _, grams, starts = word_features(words)
    places, counts = network.places(words), np.diff(np.r_[starts, grams.size])
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    span = np.diff(np.r_[first, len(owner)])
    adam, word_sums, gram_sums = (_Adam(0.01), np.full((len(network.words), 1), DAMPING, np.float32),
                                  np.full((GRAM_BUCKETS, 1), DAMPING, np.float32))
    spared = np.arange(len(y)) % 5 == 4     # for calibration only
    if len(set(y[spared].tolist())) < 2 or len(set(y[~spared].tolist())) < 2:
        spared[:] = False
    yes, no = np.flatnonzero((y == 1) & ~spared), np.flatnonzero((y == 0) & ~spared)
    steps = max(40, len(y) // BATCH)
    for turn in range(ROUNDS):
        vectors = network.vectors(words)
        worst = network.scores(network.projected(vectors), ids)
        # the highest window of each document
        ranked = np.lexsort((worst, owner))
        top = ranked[first + span - 1]
        for _ in range(steps):
            batch = np.r_[rng.choice(yes, BATCH // 2), rng.choice(no, BATCH // 2)]
            chosen = top[batch]
            # at first any window may be the one, later the highest is
            loose = rng.random(BATCH) < max(0.1, 0.6 - 0.15 * turn)
            chosen = np.where(loose, first[batch] + (rng.random(BATCH) * span[batch]).astype(np.int64), chosen)
            used, local = np.unique(ids[chosen], return_inverse=True)
            if used[0] != 0:
                used, local = np.r_[0, used], local + 1
            local = local.reshape(BATCH, WINDOW)
            names = [words[i] for i in used]
            inputs = network.vectors(names)
            slopes, on_inputs = network.gradients(network.projected(inputs), inputs, local, y[batch])
            adam.step(network.dense, slopes)
            _adagrad(network.words, word_sums, places[used], on_inputs[:, :PART], RATE)
            network.words[0] = 0
            n = counts[used[1:]]
            at = np.concatenate([np.arange(s, s + c) for s, c in zip(starts[used[1:]], n, strict=True)])
            _adagrad(network.grams, gram_sums, grams[at],
                     np.repeat(on_inputs[1:, PART:] / n[:, None], n, axis=0), GRAM_RATE)
    if spared.any():
        logits = np.maximum.reduceat(network.scores(network.projected(network.vectors(words)), ids), first)
        share = y.mean() if natural is None else natural
        weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
        slope, shift = _calibration(logits[spared].astype(np.float64), y[spared], weight[spared])
        network.dense["out"] *= np.float32(slope)
        network.dense["shift"] = (network.dense["shift"] * slope + shift).astype(np.float32)
    return network


def _calibration(logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift, from a grid, that make a document's score a probability."""
    sign, best = np.where(y == 1, 1.0, -1.0), (np.inf, 1.0, 0.0)
    for slope in (0.25, 0.5, 0.75, 1.0):
        for shift in np.linspace(-8, 8, 65):
            loss = (weight * np.logaddexp(0, -sign * (slope * logits + shift))).sum() + 0.02 * shift * shift
            best = min(best, (loss, slope, float(shift)))
    return best[1], best[2]


def _document_scores(lexicon: Lexicon, texts: list[str]) -> np.ndarray:
    ids, owner = lexicon.windows(texts)
    logits = lexicon.network.scores(lexicon.table_now(), ids)
    worst = np.maximum.reduceat(logits, np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]))
    return 1 / (1 + np.exp(-worst.astype(np.float64)))


def _score_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                score = _document_scores(lexicon, [t.as_py() for t in part.column(1)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(score)], names=["key", "score"])

    return run


def _keep_batches(shared, text: int, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                score = _document_scores(lexicon, [t.as_py() or "" for t in part.column(text)])
                yield part.filter(pa.array(score < threshold))

    return run


def fitted(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, max_chars: int = MAX_CHARS) -> Network:
    texts, y = labelled_sample(docs, labels, "toxic", per_class, max_chars)
    return train(texts, y, natural_share(labels, "toxic"))


def scored(docs: DataFrame, network: Network, key: str = "doc_id") -> DataFrame:
    """``key, score`` of every row. Null and empty texts, and texts without words, score as one
    window of padding. All windows of a text count, however long it is."""
    shared = docs.sparkSession.sparkContext.broadcast(network)      # 1.6 MB, whatever the corpus
    frame = docs.select(docs[quoted(key)].cast("long").alias("key"), whole(docs["text"]).alias("text"))
    return frame.mapInArrow(_score_batches(shared), "key long, score double").withColumnRenamed("key", key)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each document; held-out labels are never learnt."""
    out = scored(docs, fitted(docs, labels))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents below the threshold, with all their columns; decided where a row lies."""
    shared = docs.sparkSession.sparkContext.broadcast(fitted(docs, labels))
    return docs.mapInArrow(_keep_batches(shared, docs.columns.index("text"), threshold), docs.schema)
