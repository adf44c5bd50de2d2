"""Language by a bidirectional gated recurrent network over the bytes of a text.

Two networks read the bytes, one from the left and one from the right. At every position their
states give a probability of each language; a document's probabilities are the means over its
letters. The network is trained in numpy by backpropagation through time on windows of a bounded
sample of documents with a known language; in some of the windows the language changes midway,
so that each position is judged by what lies around it.

The gates are ``1/2 + x / (2 + 2|x|)`` and the new state is ``x / (1 + |x|)``: the usual shapes, at
a quarter of the price of exponentials.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import quoted, whole

HIDDEN = 16                             # states of each direction
WINDOW, MARGIN = 240, 8                 # bytes labelled in a window, and read on each side of them
OUTSIDE = 256                           # stands before and after a text
PER_LANGUAGE, MAX_CHARS = 300, 10_000   # the sample: about so many documents of a language, texts up to this
SPAN, BATCH, STEPS, RATE = 64, 64, 400, 0.012
SEED = 11
CHUNK = 2_048                           # windows read at once
SLICE = 4 << 20                         # bytes of texts looked at together, unless one text has more

_LETTER = np.zeros(257, bool)           # bytes of letters: ASCII ones, and all of several-byte characters
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def held_out(doc_id: Column | str) -> Column:
    """Every third document by the CRC of its id: never learnt from. Null ids are not held out."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string")) % 3 == 1, F.lit(False))


@dataclass
class Tape:
    """What a step leaves behind for the way back, arrays of 2 x windows x HIDDEN."""

    before: np.ndarray
    gates: np.ndarray
    new: np.ndarray
    pull: np.ndarray


class Network:
    """Parameters by direction: 0 reads from the left, 1 from the right."""

    def __init__(self, languages: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)

        def small(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.languages = languages
        self.weights = {
            "bytes": small(2, 3, 257, HIDDEN, scale=0.5),       # update gate, reset gate, new state
            "state": small(2, 3, HIDDEN, HIDDEN, scale=0.25),
            "out": small(2, HIDDEN, len(languages), scale=0.1),
            "shift": np.zeros(len(languages), np.float32)}

    def logits(self, ids: np.ndarray, tape: list[Tape] | None = None) -> np.ndarray:
        """positions x windows x languages, of byte numbers positions x windows."""
        steps, n = ids.shape
        w = self.weights
        out = np.empty((steps, n, len(self.languages)), np.float32)
        out[:] = w["shift"]
        h = np.zeros((2, 1, n, HIDDEN), np.float32)
        x = np.empty((2, 3, n, HIDDEN), np.float32)
        for t in range(steps):
            for side, row in enumerate((ids[t], ids[steps - 1 - t])):
                for part in range(3):
                    np.take(w["bytes"][side, part], row, axis=0, out=x[side, part], mode="clip")
            pulls = np.matmul(h, w["state"])
            gates = pulls[:, :2]
            gates += x[:, :2]
            size = np.abs(gates)
            size += 1
            gates /= size
            gates *= 0.5
            gates += 0.5
            new = gates[:, 1] * pulls[:, 2]
            new += x[:, 2]
            size = np.abs(new)
            size += 1
            new /= size
            if tape is not None:
                tape.append(Tape(h[:, 0].copy(), gates.copy(), new.copy(), pulls[:, 2].copy()))
            new -= h[:, 0]
            new *= gates[:, 0]
            h[:, 0] += new
            said = np.matmul(h[:, 0], w["out"])
            out[t] += said[0]
            out[steps - 1 - t] += said[1]
        return out

    def gradients(self, ids: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> tuple[dict[str, np.ndarray], float]:
        """Of the mean log loss over the positions that count, and that loss."""
        w, tape = self.weights, []
        p = np.ascontiguousarray(np.moveaxis(_softmax(self.logits(ids, tape)), 0, -1))
        steps, n = ids.shape
        share = counts / max(1, counts.sum())
        at = np.arange(steps)[:, None], np.arange(n)[None], labels
        loss = float(-(np.log(np.maximum(p[at], 1e-9)) * share).sum())
        slope = p
        slope[at] -= 1
        slope *= share[:, :, None].astype(np.float32)
        grow = {k: np.zeros_like(v) for k, v in w.items()}
        grow["shift"] = slope.sum(axis=(0, 1))
        on_bytes = np.empty((steps, 2, 3, n, HIDDEN), np.float32)
        carry = np.zeros((2, n, HIDDEN), np.float32)
        backward = w["state"].transpose(0, 1, 3, 2)
        for t in range(steps - 1, -1, -1):
            kept = tape[t]
            z, r = kept.gates[:, 0], kept.gates[:, 1]
            said = np.stack([slope[t], slope[steps - 1 - t]])
            after = kept.before + z * (kept.new - kept.before)
            grow["out"] += np.matmul(after.transpose(0, 2, 1), said)
            dh = carry + np.matmul(said, w["out"].transpose(0, 2, 1))
            dx = on_bytes[t]
            dx[:, 2] = dh * z * (1 - np.abs(kept.new)) ** 2
            dx[:, 0] = dh * (kept.new - kept.before)
            dx[:, 1] = dx[:, 2] * kept.pull
            dx[:, :2] *= 0.5 * (1 - np.abs(2 * kept.gates - 1)) ** 2
            on_pull = dx.copy()
            on_pull[:, 2] *= r
            grow["state"] += np.matmul(kept.before[:, None].transpose(0, 1, 3, 2), on_pull)
            carry = dh * (1 - z) + np.matmul(on_pull, backward).sum(axis=1)
        on_bytes[:, 1] = on_bytes[::-1, 1].copy()       # by position, not by step
        order = np.argsort(ids, axis=None, kind="stable")
        of = ids.ravel()[order]
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        flat = on_bytes.transpose(0, 3, 1, 2, 4).reshape(steps * n, 2, 3, HIDDEN)[order]
        grow["bytes"][:, :, of[first]] = np.add.reduceat(flat, first, axis=0).transpose(1, 2, 0, 3)
        return grow, loss

    def pooled(self, flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probabilities of each text: the mean over its letters' bytes, the texts lying end to end in ``flat``."""
        firsts = np.cumsum(lengths) - lengths
        windows = np.maximum(1, -(-lengths // WINDOW))
        owner = np.repeat(np.arange(len(lengths)), windows)
        start = (np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)) * WINDOW
        sums = np.zeros((len(lengths), len(self.languages)))
        letters = np.zeros(len(lengths))
        reach = np.arange(-MARGIN, WINDOW + MARGIN)[:, None]
        for at in range(0, len(owner), CHUNK):
            own, place = owner[at:at + CHUNK], start[at:at + CHUNK] + reach
            inside = (place >= 0) & (place < lengths[own])
            ids = np.full(place.shape, OUTSIDE, np.intp)
            ids[inside] = flat[(firsts[own] + place)[inside]]
            counts = _LETTER[ids[MARGIN:-MARGIN]]
            p = _softmax(self.logits(ids)[MARGIN:-MARGIN])
            p *= counts
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            sums[own[first]] += np.add.reduceat(p.sum(axis=1, dtype=np.float64), first, axis=1).T
            letters[own[first]] += np.add.reduceat(counts.sum(axis=0), first)
        return sums / np.maximum(letters, 1)[:, None]


def _softmax(logits: np.ndarray) -> np.ndarray:
    """Along the last axis, which comes first in the result: whole rows of positions are faster."""
    p = np.ascontiguousarray(np.moveaxis(logits, -1, 0))
    p -= p.max(axis=0)
    np.exp(p, out=p)
    p /= p.sum(axis=0)
    return p


class _Adam:
    def __init__(self):
        self.moments, self.turn = {}, 0

    def step(self, values: dict[str, np.ndarray], slopes: dict[str, np.ndarray], rate: float) -> None:
        self.turn += 1
        for k, g in slopes.items():
            m, v = self.moments.setdefault(k, (np.zeros_like(g), np.zeros_like(g)))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            values[k] -= rate * (m / (1 - 0.9 ** self.turn)) / (np.sqrt(v / (1 - 0.99 ** self.turn)) + 1e-7)


def _windows(by_language: list[list[np.ndarray]], rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and labels, positions x windows: pieces of texts, every fourth window from two languages,
    every eighth in capitals."""
    ids = np.full((BATCH, SPAN), OUTSIDE, np.intp)
    labels = np.zeros((BATCH, SPAN), np.int64)
    for row in range(BATCH):
        cuts = (0, int(rng.integers(8, SPAN - 8)), SPAN) if row % 4 == 0 else (0, SPAN)
        for low, high in zip(cuts, cuts[1:], strict=False):
            language = int(rng.integers(len(by_language)))
            texts = by_language[language]
            text = texts[int(rng.integers(len(texts)))]
            # some windows reach beyond the text's ends, as windows of short texts do
            first = int(rng.integers(-4, max(-3, len(text) - (high - low) + 5)))
            piece = text[max(0, first):first + high - low]
            at = low + max(0, -first)
            ids[row, at:at + len(piece)] = piece
            labels[row, low:high] = language
        if row % 8 == 1:                # as a headline would have it
            ids[row] -= 32 * ((ids[row] >= 97) & (ids[row] <= 122))
    return ids.T.copy(), labels.T.copy()


def train(texts: list[bytes], languages: list[str], seed: int = SEED) -> Network:
    """Learn from texts and their languages; without any, a network that knows none."""
    known = sorted(set(languages))
    network = Network(known, seed)
    by_language = [[np.frombuffer(t, np.uint8) for t, of in zip(texts, languages, strict=True) if of == each and t]
                   for each in known]
    by_language = [each or [np.zeros(0, np.uint8)] for each in by_language]
    if len(known) > 1:
        rng, adam = np.random.default_rng(seed), _Adam()
        for step in range(STEPS):
            ids, labels = _windows(by_language, rng)
            slopes, _ = network.gradients(ids, labels, _LETTER[ids])
            adam.step(network.weights, slopes, RATE * (1 - 0.9 * step / STEPS))
    return network


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE, max_chars: int = MAX_CHARS
           ) -> tuple[list[bytes], list[str]]:
    """Texts to learn from and their languages, a bounded sample by a hash of the id.

    Documents that are not held out, with an id, a text of 1 to ``max_chars`` characters with a letter and
    a language, even an empty one. Each language is sampled at the rate that gives one and a half times
    ``per_language`` on average (all, where it has fewer); of all that, at most twice ``per_language`` for
    each language there is come to the driver.
    """
    known = docs.select(docs["doc_id"].alias("id"), whole(docs["text"]).alias("text"), docs["lang"].alias("lang"))
    known = known.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out("id")
                        & (F.length("text") <= max_chars) & F.col("text").rlike(r"\p{L}"))
    totals = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not totals:
        return [], []
    scale = 1 << 30
    rates = F.create_map(*[x for lang, n in totals.items()
                           for x in (F.lit(lang), F.lit(min(scale, int(scale * 1.5 * per_language / n) + 1)))])
    order = F.xxhash64("id")
    rows = (known.where(F.pmod(order, F.lit(scale)) < rates[F.col("lang")])
            .orderBy(order, "id", "lang", "text").limit(2 * per_language * len(totals))
            .select("text", "lang").toArrow())
    return [t.encode() for t in rows["text"].to_pylist()], rows["lang"].to_pylist()


def fitted(docs: DataFrame, per_language: int = PER_LANGUAGE, max_chars: int = MAX_CHARS) -> Network:
    return train(*sample(docs, per_language, max_chars))


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``SLICE`` bytes each."""
    first, total = 0, 0
    for at, size in enumerate(sizes.tolist()):
        total += size
        if total >= SLICE or at == len(sizes) - 1:
            yield first, at + 1
            first, total = at + 1, 0


def _score_batches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        names = pa.array([*network.languages, "und"], pa.string())
        for batch in batches:
            column = batch.column(1).cast(pa.binary())
            offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
            data = column.buffers()[2]
            data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
            lengths = np.diff(offsets).astype(np.int64)
            for low, high in _slices(lengths):
                read = np.flatnonzero(lengths[low:high])        # the others have no letter
                shares = np.zeros((high - low, len(network.languages)))
                best = np.full(high - low, len(network.languages))
                if len(read) and network.languages:
                    shares[read] = network.pooled(data[offsets[low]:offsets[high]], lengths[low:high][read])
                    best[read] = shares[read].argmax(axis=1)
                top = np.concatenate([shares, np.zeros((high - low, 1))], axis=1)[np.arange(high - low), best]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), names.take(pa.array(best)), pa.array(np.minimum(top, 1.0)),
                     pa.array(list(shares), pa.list_(pa.float64()))],
                    names=["key", "lang_pred", "score", "shares"])

    return run


def scored(docs: DataFrame, network: Network, key: str = "doc_id") -> DataFrame:
    """``key, lang_pred, score, shares`` of every row: the likeliest language, its probability, and all.

    ``shares`` follows ``network.languages``, which are in order of code points; ties go to the first.
    A null or empty text, one without a letter, and any text where no language was learnt is ``und``
    with score 0 and shares 0. Every byte of a text is read, however long it is; a task holds the text
    at hand and windows of a fixed number. Repeated rows give repeated rows, null keys stay null,
    columns other than key and text are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)      # some 100 KB, whatever the corpus
    text = whole(docs["text"])
    frame = docs.select(docs[quoted(key)].alias("key"), F.when(text.rlike(r"\p{L}"), text).otherwise("").alias("text"))
    of = docs.select(docs[quoted(key)].alias("key")).schema[0].dataType.simpleString()
    return frame.mapInArrow(_score_batches(shared), f"key {of}, lang_pred string, score double, shares array<double>"
                            ).withColumnRenamed("key", key)


def language(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, shares`` of each document, learnt from those not held out.

    See ``sample`` for what is learnt from and ``scored`` for odd rows. An empty table gives no rows.
    """
    return scored(docs, fitted(docs)).select("doc_id", held_out("doc_id").alias("held_out"),
                                             "lang_pred", "score", "shares")
