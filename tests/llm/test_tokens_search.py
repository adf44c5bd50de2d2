"""BPE against a public encoder, top-k against all products."""

import random
from itertools import pairwise

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import bpe, topk

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
OTHER = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
ODD = ["", " ", "  ", "a  b", " a", "a ", "a \n b", "\x1c a\x1c b", "a\x85 b", "日本語 テスト", "it's we'll 's", "a" * 5000,
       "ab" * 20_000, "😀 😀😀", "x\t y", "!!!! ???", "ⅷ ² ½ x²", "  x", "<|endoftext|>", "é é", "​ ​"]


@pytest.mark.parametrize("text", ODD)
def test_ids_of_odd_texts(text):
    assert ENCODER.encode(text).tolist() == OTHER.encode_ordinary(text)


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ab é1'\n\t.!s日 \x1c\x85"), st.characters(exclude_categories=["Cs"]))))
def test_ids_of_any_text(text):
    assert ENCODER.encode(text).tolist() == OTHER.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 70_000), st.integers(0, 50))))
def test_queue_gives_the_lowest_rank_leftmost_first(entries):
    queue = bpe.RankQueue(70_001)
    for rank, at in entries:
        queue.push(rank, [at])
    out = []
    while queue.top:
        rank, bucket = queue.pop()
        out += [(rank, at) for at in bucket]
    assert out == sorted(entries) and not queue.buckets and not any(queue.leaf)


@pytest.mark.parametrize("together", [1, 7, 1 << 16])
def test_many_texts_at_once(monkeypatch, together):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    monkeypatch.setattr(bpe, "CACHE_CHARS", 6)
    monkeypatch.setattr(bpe, "TOGETHER", together)
    small = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    texts = [" ".join(f"word{i * k} and{i % 3}x" for i in range(50)) for k in range(20)] + ODD
    for at in range(0, len(texts), 9):
        got = small.encode_all(texts[at:at + 9])
        assert [g.tolist() for g in got] == [OTHER.encode_ordinary(t) for t in texts[at:at + 9]]
    assert max(map(len, [*small.pieces, *small.words])) <= 6


def test_a_merge_that_opens_a_lower_one():
    """A pair that a merge makes possible comes first, even if others of the rank wait."""
    ranks = {bytes([b]): 300 + b for b in range(256)}
    ranks |= {b"ab": 20, b"abc": 10, b"cab": 5, b"abab": 30}
    other = tiktoken.Encoding("small", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(0)
    pieces = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 30))).encode() for _ in range(500)]
    assert bpe.Merger(ranks).merged(pieces) == [tuple(other.encode_ordinary(p.decode())) for p in pieces]


def test_frames(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate([*ODD, None])] + [(None, "no id", "", ""), (3, "again", "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, decoded string").repartition(2)
    shared = bpe.share_ranks(spark, PATH, public_tokenizers.PATTERN)
    both = bpe.encode(docs, shared, decode_too=True).collect()
    want = sorted((str(i), OTHER.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows)
    assert sorted((str(r.doc_id), r.token_ids, bytes(r.decoded)) for r in both) == want
    back = bpe.decode(bpe.encode(docs, shared), shared).collect()
    assert sorted((str(r.doc_id), bytes(r.decoded)) for r in back) == [(i, b) for i, _, b in want]
    assert bpe.encode(docs.limit(0), shared).count() == 0


def test_long_outputs_are_cut_into_batches(spark, monkeypatch):
    texts = [(i, "some words " * (i % 7)) for i in range(50)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    shared = bpe.share_ranks(spark, PATH, public_tokenizers.PATTERN)
    monkeypatch.setattr(bpe, "FLUSH_TOKENS", 5)
    got = {r.doc_id: r.token_ids for r in bpe.encode(docs, shared).collect()}
    assert got == {i: OTHER.encode_ordinary(t) for i, t in texts}


def by_hand(queries, candidates, k):
    out = []
    for q, v in queries:
        if q is None or v is None:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), c) for c, w in candidates
                        if c is not None and w is not None and len(w) == len(v) and c != q)
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, vector array<long>, rank int").repartition(3)


@pytest.mark.parametrize("scale", [3, 2_000, 10 ** 7, 10 ** 9])
def test_top_k(spark, scale, monkeypatch):
    monkeypatch.setattr(topk, "TILE_QUERIES", 7)
    monkeypatch.setattr(topk, "TILE_CANDIDATES", 16)
    rng = random.Random(scale)
    rows = [(i, [rng.randint(-scale, scale) for _ in range(6)]) for i in range(150)]
    rows += [(150 + i, rows[i][1]) for i in range(20)] + [(200, None), (None, [1] * 6), (201, [0] * 6), (202, [1, 2])]
    rows += [(203, [5, 6]), (7, rows[7][1])]
    queries = [r for r in rows if r[0] is None or r[0] % 4 == 0 or r[0] in (203, 7)]
    got = topk.top_k(frame(spark, queries), frame(spark, rows), 10, block_queries=16)
    assert sorted(map(tuple, got.collect())) == by_hand(queries, rows, 10)


def test_top_k_of_nothing(spark):
    some, none = frame(spark, [(1, [1, 2])]), frame(spark, [])
    assert topk.top_k(none, some).count() == 0
    assert topk.top_k(some, none).count() == 0
    assert topk.top_k(some, some).count() == 0


def test_integer_vectors(spark):
    rows = [(1, [0.5, -0.0001, 1.0]), (2, [float("nan"), 0.0]), (3, [float("inf")]), (4, [None, 1.0]), (5, None), (6, [])]
    frame_ = spark.createDataFrame(rows, "i int, embedding array<float>")
    got = {r[0]: r[1] for r in frame_.select("i", topk.integer_vector("embedding")).collect()}
    assert got == {1: [512, int(np.floor(-0.0001 * 1024)), 1024], 2: None, 3: None, 4: None, 5: None, 6: []}


def test_short_pre_tokens_merge_in_step_for_any_ranks(monkeypatch):
    """Ranks in random order, so merges may make pairs that come first; none of these needs the queue."""
    rng = random.Random(3)
    tokens = {bytes(rng.choices(b"abc", k=n)) for n in range(2, 9) for _ in range(60)}
    ranks = {bytes([b]): b for b in range(256)} | {
        t: 256 + i for i, t in enumerate(rng.sample(sorted(tokens), len(tokens)))}

    def plain(piece):
        parts = [bytes([b]) for b in piece]
        while pairs := [(ranks[a + b], i) for i, (a, b) in enumerate(pairwise(parts)) if a + b in ranks]:
            i = min(pairs)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return tuple(ranks[p] for p in parts)

    merger = bpe.Merger(ranks)
    monkeypatch.delattr(bpe.Merger, "_run")
    pieces = [bytes(rng.choices(b"abcd", k=rng.randint(1, bpe.SHORT))) for _ in range(400)]
    assert merger.merged(pieces) == [plain(p) for p in pieces]
