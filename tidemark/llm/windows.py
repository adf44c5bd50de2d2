"""What the learned scorers share: labelled samples, and words as arrays."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, whole

GRAM = 3
GRAM_BUCKETS = 1 << 14
WORD_BUCKETS = 1 << 15
WORD_CHARS = 64             # longer words go on as further words, so nothing is lost
_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0x100000001B3)
_POWERS = np.cumprod(np.full(4 * WORD_CHARS + 2, _BASE, np.uint64))


def hashed(values: np.ndarray, buckets: int) -> np.ndarray:
    """Multiplicative hashing of 64-bit numbers into a power of two."""
    return ((values * _MULT) >> np.uint64(65 - int(buckets).bit_length())).astype(np.int32)


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: its hash, and flat n-gram buckets with the place where each word's begin.

    The n-grams are of bytes, with a mark before and after the word, so every non-empty word
    has at least one.
    """
    coded = [b"<" + w.encode() + b">" for w in words]
    flat = np.frombuffer(b"".join(coded), np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, coded), np.int64, len(coded))
    starts = np.cumsum(lengths) - lengths
    if not coded:
        return np.empty(0, np.uint64), np.empty(0, np.int32), starts
    place = np.arange(flat.size) - np.repeat(starts, lengths)
    sums = np.add.reduceat((flat + np.uint64(1)) * _POWERS[place], starts)
    grams = flat[:-2] | flat[1:-1] << np.uint64(8) | flat[2:] << np.uint64(16)
    counts = lengths - GRAM + 1
    gram_starts = np.cumsum(counts) - counts
    at = np.arange(counts.sum()) - np.repeat(gram_starts, counts) + np.repeat(starts, counts)
    return sums, hashed(grams[at], GRAM_BUCKETS), gram_starts


def usable_labels(labels: DataFrame, column: str) -> DataFrame:
    """Rows to learn from: an id, a label of 0 or 1, and not held out."""
    return labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1) & ~held_out("doc_id"))


def natural_share(labels: DataFrame, column: str) -> float:
    """The share of label 1 among all labels that may be learnt from, never quite 0 or 1."""
    ones, known = usable_labels(labels, column).agg(F.sum(column), F.count("*")).first()
    return ((ones or 0) + 1) / (known + 2)


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, per_class: int, max_chars: int
                    ) -> tuple[list[str], np.ndarray]:
    """Whole texts and 0/1 labels to learn from: a bounded sample in hash order.

    At most ``per_class`` ids of each label, at most twice as many rows, and only texts of at
    most ``max_chars``. Held-out ids never come in; of several labels of one id the largest
    counts; null ids and labels other than 0 and 1 are left out.
    """
    known = (usable_labels(labels, column).groupBy("doc_id").agg(F.max(column).alias("y")))
    order = F.xxhash64("doc_id")
    picked = None
    for y in (0, 1):
        some = known.where(F.col("y") == y).orderBy(order, "doc_id").limit(per_class)
        picked = some if picked is None else picked.unionByName(some)
    # at most 2 * per_class short rows, so it may be broadcast
    texts = (docs.select("doc_id", whole("text").alias("text")).where(F.length("text") <= max_chars)
             .join(F.broadcast(picked), "doc_id"))
    rows = texts.orderBy(order, "doc_id", "text").limit(4 * per_class).select("text", "y").toArrow()
    return rows["text"].to_pylist(), rows["y"].to_numpy().astype(np.int64)
