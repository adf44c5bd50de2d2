"""Byte-level BPE by given merge ranks: encoding with a hierarchical-bitmap rank queue, decoding.

The queue holds, for every merge rank, the positions whose pair has that rank. A bitmap over
ranks, with a bitmap of its non-empty words above it, gives the lowest rank in use by
find-first-set. Merging never searches: positions that a neighbour's merge made untrue are
skipped when they come up. So a pre-token of n bytes costs n log n, however long it is. Many
pre-tokens share one queue: they lie end to end, and no pair reaches across their bounds.
Short pre-tokens, nearly all, need no queue: array steps make one merge of each.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from tidemark.llm.common import quoted, whole

CACHE_ENTRIES = 400_000     # of pre-tokens, and of words; an emptied cache only costs time
CACHE_CHARS = 64            # longer ones are worked out anew
ID_BITS = 32
NO_PAIR = np.iinfo(np.int32).max
SHORT = 48                  # bytes of a pre-token merged in step with others; a longer one goes through the queue
TOGETHER = 1 << 16          # bytes of pre-tokens merged in one queue, unless one alone has more
TEXTS = 64                  # texts looked through before merging what is new in them
FLUSH_TOKENS = 2_000_000    # tokens in an output batch, unless one text has more


class RankQueue:
    """Positions by rank: ``push`` anywhere, ``pop`` all of the lowest rank, in order.

    ``leaf`` has a bit for each rank in use, 64 to a word; ``top`` a bit for each word that is
    not zero.
    """

    def __init__(self, ranks: int):
        words = (ranks >> 6) + 1
        self.leaf = [0] * words
        self.top = 0
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, positions: list[int]) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket += positions
            return
        self.buckets[rank] = positions
        word = rank >> 6
        self.leaf[word] |= 1 << (rank & 63)
        self.top |= 1 << word

    def pop(self) -> tuple[int, list[int]]:
        top = self.top
        word = (top & -top).bit_length() - 1
        bits = self.leaf[word]
        rank = (word << 6) + (bits & -bits).bit_length() - 1
        bits &= bits - 1
        self.leaf[word] = bits
        if not bits:
            self.top = top & (top - 1)
        bucket = self.buckets.pop(rank)
        bucket.sort()
        return rank, bucket


class Merger:
    """Merges of a vocabulary that has all single bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.double = np.full(1 << 16, -1, np.int32)
        self.pairs: dict[int, int] = {}     # rank of a merge by the ids of its two sides
        for token, rank in ranks.items():
            if len(token) == 2:
                self.double[token[0] << 8 | token[1]] = rank
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << ID_BITS | right] = rank
        keys = np.fromiter(self.pairs, np.int64, len(self.pairs))
        order = np.argsort(keys)
        self.keys, self.found = keys[order], np.fromiter(self.pairs.values(), np.int32, len(self.pairs))[order]

    def merged(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of each pre-token, none of them empty."""
        return [tuple(np.frombuffer(ids, np.int32).tolist()) for ids in self.packed(pieces)]

    def packed(self, pieces: list[bytes]) -> list[bytes]:
        """The same as 32-bit numbers one after the other."""
        if not self.keys.size:
            return self._queued(pieces)
        short, long = [p for p in pieces if len(p) <= SHORT], [p for p in pieces if len(p) > SHORT]
        of_short, of_long = iter(self._in_step(short) if short else ()), iter(self._queued(long) if long else ())
        return [next(of_short if len(p) <= SHORT else of_long) for p in pieces]

    def _in_step(self, pieces: list[bytes]) -> list[bytes]:
        """A merge of every pre-token at a time: the first of its lowest pairs, which holds for any ranks."""
        data = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int32)
        owner = np.repeat(np.arange(len(pieces)), np.fromiter(map(len, pieces), np.int64, len(pieces)))
        ids, rank = self.single[data], np.full(data.size, NO_PAIR, np.int32)
        pairs = self.double[data[:-1] << 8 | data[1:]]
        rank[:-1] = np.where((owner[1:] == owner[:-1]) & (pairs >= 0), pairs, NO_PAIR)
        done_ids, done_owner = [], []
        while ids.size:
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            lowest = np.repeat(np.minimum.reduceat(rank, first), np.diff(first, append=ids.size))
            going = lowest != NO_PAIR
            if not going.all():
                done_ids.append(ids[~going])
                done_owner.append(owner[~going])
                ids, owner, rank, lowest = ids[going], owner[going], rank[going], lowest[going]
                if not ids.size:
                    break
            at = np.flatnonzero(rank == lowest)
            at = at[np.concatenate([[True], owner[at[1:]] != owner[at[:-1]]])]
            ids[at] = rank[at]
            kept = np.ones(ids.size, bool)
            kept[at + 1] = False
            at -= np.arange(at.size)            # each merge before it took one place away
            ids, owner, rank = ids[kept], owner[kept], rank[kept]
            changed = np.concatenate([at, at[at > 0] - 1])
            rank[changed] = NO_PAIR
            changed = changed[changed + 1 < ids.size]
            changed = changed[owner[changed] == owner[changed + 1]]
            wanted = ids[changed].astype(np.int64) << ID_BITS | ids[changed + 1]
            place = np.minimum(np.searchsorted(self.keys, wanted), self.keys.size - 1)
            rank[changed] = np.where(self.keys[place] == wanted, self.found[place], NO_PAIR)
        owner, ids = np.concatenate(done_owner), np.concatenate(done_ids)
        packed = ids[np.argsort(owner, kind="stable")].tobytes()
        ends = (4 * np.cumsum(np.bincount(owner, minlength=len(pieces)))).tolist()
        return [packed[low:high] for low, high in zip([0, *ends], ends, strict=False)]

    def _queued(self, pieces: list[bytes]) -> list[bytes]:
        data = b"".join(pieces)
        n = len(data)
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        starts = np.cumsum(lengths) - lengths
        first = np.zeros(n + 1, np.uint8)
        first[starts] = 1
        first[n] = 1
        flat = np.frombuffer(data, np.uint8).astype(np.int32)
        pairs = np.full(n, -1, np.int32)
        pairs[:-1] = np.where(first[1:-1] == 1, -1, self.double[flat[:-1] << 8 | flat[1:]])
        at = np.flatnonzero(pairs >= 0)
        at = at[np.argsort(pairs[at], kind="stable")]
        cuts = np.flatnonzero(np.diff(pairs[at])) + 1
        for bucket in np.split(at, cuts) if at.size else ():
            self.queue.push(int(pairs[bucket[0]]), bucket.tolist())
        bound = first.tobytes()
        # plain lists are faster, packed ones bound the memory of a very long pre-token
        pack = list if n <= 16 * TOGETHER else (lambda numbers: array("i", numbers))
        after, before = pack(range(1, n + 1)), pack(range(-1, n - 1))
        ids, pair = pack(self.single[flat].tolist()), pack(pairs.tolist())
        self._run(bound, after, before, ids, pair)
        ids = np.array(ids, np.int32)
        alive = ids >= 0
        ends = (4 * np.cumsum(np.add.reduceat(alive, starts))).tolist() if n else []
        packed = ids[alive].tobytes()
        return [packed[low:high] for low, high in zip([0, *ends], ends, strict=False)]

    def _run(self, bound: bytes, after, before, ids, pair) -> None:
        """Merge until no pair is left. A position merged into its left neighbour gets id -1."""
        rank_of, queue = self.pairs.get, self.queue
        buckets, push = queue.buckets, queue.push
        while queue.top:
            rank, bucket = queue.pop()
            as_left = rank << ID_BITS
            for place, at in enumerate(bucket):
                if pair[at] != rank:            # a neighbour's merge has changed it
                    continue
                gone = after[at]
                end = after[at] = after[gone]
                ids[at], ids[gone] = rank, -1
                pair[gone] = -1
                lowest = rank
                if bound[end]:
                    pair[at] = -1
                else:
                    before[end] = at
                    new = pair[at] = rank_of(as_left | ids[end], -1)
                    if new >= 0:
                        if new in buckets:
                            buckets[new].append(at)
                        else:
                            push(new, [at])
                        if new < lowest:
                            lowest = new
                if not bound[at]:
                    left = before[at]
                    new = rank_of(ids[left] << ID_BITS | rank, -1)
                    if new != pair[left]:
                        pair[left] = new
                        if new >= 0:
                            if new in buckets:
                                buckets[new].append(left)
                            else:
                                push(new, [left])
                            if new < lowest:
                                lowest = new
                if lowest < rank:               # that one comes first; the others wait
                    push(rank, bucket[place + 1:])
                    break


# a blank beside a space, or at an end of the text
_other_blanks = regex.compile(r" [\s\x1c-\x1f\x85]|[\s\x1c-\x1f\x85] |\A |[\s\x1c-\x1f\x85]\Z").search


class Encoder:
    """Splits by a pattern, merges each match. Keeps what it has met, within bounds.

    With this pattern a single space between other characters always starts a match, so words
    between such spaces are looked up whole. Texts with other blanks go by matches alone.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.merger = Merger(ranks)
        self.tokens = token_table(ranks)
        self.pieces: dict[str, bytes] = {}      # ids as 32-bit numbers
        self.words: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> None:
        """Ids of pre-tokens not met yet."""
        waiting, size = [], 0
        for text in pieces.difference(self.pieces):
            coded = text.encode()
            known = self.ranks.get(coded)
            if known is not None:
                self.pieces[text] = known.to_bytes(4, sys.byteorder)
                continue
            waiting.append((text, coded))
            size += len(coded)
            if size >= TOGETHER:
                self._merge(waiting)
                waiting, size = [], 0
        self._merge(waiting)

    def _merge(self, waiting: list[tuple[str, bytes]]) -> None:
        if waiting:
            self.pieces.update(zip((t for t, _ in waiting), self.merger.packed([c for _, c in waiting]), strict=True))

    def encode_all(self, texts: Iterable[str]) -> list[np.ndarray]:
        for cache in (self.pieces, self.words):
            if len(cache) >= CACHE_ENTRIES:
                cache.clear()
        plans, new_words, new_pieces = [], set(), set()
        for text in texts:
            if _other_blanks(text):
                head, words = self.split(text), []
            else:
                first, *words = text.split(" ")
                head = self.split(first)
                new_words.update(set(words).difference(self.words))
            new_pieces.update(head)
            plans.append((head, words))
        parts = {w: self.split(" " + w) for w in new_words}
        new_pieces.update(*parts.values())
        self._learn(new_pieces)
        ids, of_word = self.pieces.__getitem__, self.words.__getitem__
        for word, pieces in parts.items():
            self.words[word] = b"".join(map(ids, pieces))
        out = [np.frombuffer(b"".join(chain(map(ids, head), map(of_word, words))), np.int32) for head, words in plans]
        for cache, met in ((self.pieces, new_pieces), (self.words, new_words)):
            for long in [x for x in met if len(x) > CACHE_CHARS]:
                del cache[long]
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank)
                for token, rank in (line.split() for line in lines if line.strip())}


def share_ranks(spark: SparkSession, path: str, pattern: str) -> Broadcast:
    """The vocabulary for all executors; as large as the file, whatever the corpus."""
    return spark.sparkContext.broadcast((load_ranks(path), pattern))


_ENCODERS: dict[int, Encoder] = {}      # of this worker, so later tasks find warm caches


def _encoder(shared: Broadcast) -> Encoder:
    ranks, pattern = shared.value
    found = _ENCODERS.get(id(ranks))        # kept alive by its encoder, so the id stays its own
    if found is None:
        _ENCODERS.clear()
        found = _ENCODERS[id(ranks)] = Encoder(ranks, pattern)
    return found


def _list_array(lists: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(lists) + 1, np.int32)
    np.cumsum([len(x) for x in lists], out=offsets[1:])
    values = np.concatenate(lists) if lists else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def _decode(ids: np.ndarray, table: dict[int, bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids.tolist()))


def token_table(ranks: dict[bytes, int]) -> dict[int, bytes]:
    return {rank: token for token, rank in ranks.items()}


def _encode_batches(shared: Broadcast, decode_too: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        table = encoder.tokens
        for batch in batches:
            done, lists, tokens = 0, [], 0
            for at in range(0, batch.num_rows, TEXTS):
                for ids in encoder.encode_all(batch.column(1).slice(at, TEXTS).to_pylist()):
                    lists.append(ids)
                    tokens += len(ids)
                    if tokens >= FLUSH_TOKENS or done + len(lists) == batch.num_rows:
                        columns = [batch.column(0).slice(done, len(lists)), _list_array(lists)]
                        if decode_too:
                            columns.append(pa.array([_decode(each, table) for each in lists], pa.binary()))
                        yield pa.RecordBatch.from_arrays(columns, names=names[:len(columns)])
                        done, lists, tokens = done + len(lists), [], 0

    names = ["key", "token_ids", "decoded"]
    return run


def encode(docs: DataFrame, shared: Broadcast, key: str = "doc_id", text: str = "text",
           decode_too: bool = False) -> DataFrame:
    """``key, token_ids`` of each row, and with ``decode_too`` the bytes the ids stand for.

    A null text has no tokens. Rows are worked on one by one: repeated rows give repeated rows,
    null keys stay null, columns other than the two are not read. Any text, of any length, is
    encoded whole.
    """
    fields = [StructField(key, docs.schema[key].dataType),
              StructField("token_ids", ArrayType(IntegerType()))]
    if decode_too:
        fields.append(StructField("decoded", BinaryType()))
    frame = docs.select(docs[quoted(key)].alias("key"), whole(docs[quoted(text)]).alias("text"))
    inner = StructType([StructField("key", docs.schema[key].dataType), *fields[1:]])
    return frame.mapInArrow(_encode_batches(shared, decode_too), inner).toDF(*[f.name for f in fields])


def decode(tokens: DataFrame, shared: Broadcast, key: str = "doc_id", ids: str = "token_ids") -> DataFrame:
    """``key, decoded``: the bytes of each row's ids; null ids give null, unknown ids an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_table(shared.value[0])
        for batch in batches:
            texts = [None if row is None else b"".join([table[i] for i in row])
                     for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())],
                                             names=["key", "decoded"])

    schema = StructType([StructField("key", tokens.schema[key].dataType),
                         StructField("decoded", BinaryType())])
    return (tokens.select(tokens[quoted(key)].alias("key"), tokens[quoted(ids)].alias("ids"))
            .mapInArrow(run, schema).toDF(key, "decoded"))
