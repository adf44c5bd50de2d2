"""Toxicity and quality: held-out accuracy, gradients, whole texts, odd rows."""

import gc
import random
import tracemalloc
import zlib

import numpy as np
import pytest

from tidemark.llm import quality, toxicity
from tidemark.llm.windows import labelled_sample, word_features

DOCS = "doc_id long, text string, score string, key string, lang string"
LABELS = "doc_id long, quality int, toxic int"
BAD = ("vile", "rotten", "filthy", "awful")


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    lexicon = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    docs, labels = [], []
    for i in range(500):
        toxic, good = i % 4 == 0, i % 5 != 0
        words = [rng.choice(lexicon) for _ in range(rng.randint(5, 150))]
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(BAD)
        if not good:
            words = [w + rng.choice(("%%%", "&&&")) for w in words] if i % 2 else [words[0]] * len(words)
            if toxic:
                words.append(rng.choice(BAD))
        docs.append((i, " ".join(words)))
        labels.append((i, int(good), int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame([(i, t, "a", "b", "en") for i, t in docs], DOCS).repartition(3),
            spark.createDataFrame(labels, LABELS))


ODD = [(None, "no id"), (9001, None), (9002, ""), (9003, " \n"), (9004, "!!! ???"), (9005, "x" * 30_000),
       (9006, "word " * 40_000), (9007, "twice"), (9007, "twice")]


@pytest.mark.parametrize(("module", "column", "least"), [(toxicity, "toxic", 0.93), (quality, "quality", 0.93)])
def test_held_out(spark, corpus, module, column, least):
    docs, labels = corpus
    d, lab = frames(spark, docs + ODD, labels)
    got = (module.toxicity if module is toxicity else module.quality)(d, lab)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == len(docs) + len(ODD)
    assert all(0 <= r.score <= 1 for r in rows)
    truth = {r[0]: r[1 + ["quality", "toxic"].index(column)] for r in labels}
    tried = [r for r in rows if r.doc_id in truth and r.held_out]
    assert tried and all(r.held_out == held(r.doc_id) for r in rows if r.doc_id is not None)
    assert np.mean([r.predicted == truth[r.doc_id] for r in tried]) >= least
    line = 0.5 if module is toxicity else 0.3
    assert all(r.predicted == int(r.score >= line) for r in rows)
    again = {(r.doc_id, r.score) for r in (module.toxicity if module is toxicity else module.quality)(d, lab).collect()}
    assert again == {(r.doc_id, r.score) for r in rows}


def test_one_bad_word_in_a_very_long_text(spark, corpus):
    docs, labels = corpus
    clean = " ".join(t for (i, t), lab in zip(docs, labels, strict=True) if lab[1] and not lab[2])
    d, lab = frames(spark, docs + [(8000, clean + " you vile rotten filthy awful thing"), (8001, clean)], labels)
    score = {r.doc_id: r.score for r in toxicity.toxicity(d, lab).where("doc_id >= 8000").collect()}
    assert score[8000] > 0.5 and score[8000] >= score[8001]
    kept = toxicity.drop_toxic(d, lab)
    assert kept.columns == d.columns
    left = {r.doc_id for r in kept.collect()}
    assert 8000 not in left and len(left & {i for i, _ in docs}) > 300


def test_labels_that_teach_nothing(spark, corpus):
    docs, labels = corpus
    for some in ([], [(1, 1, 0), (2, 1, 0)], [(None, 1, 1), (3, None, None), (4, 7, 7)]):
        d, lab = frames(spark, docs[:5], some)
        assert toxicity.toxicity(d, lab).count() == 5
        assert quality.quality(d, lab).count() == 5
    d, lab = frames(spark, [], labels)
    assert toxicity.toxicity(d, lab).count() == 0 and quality.quality(d, lab).count() == 0


def test_sample_is_bounded_and_never_held_out(spark, corpus):
    docs, labels = corpus
    d, lab = frames(spark, docs, labels + labels[:20])
    texts, y = labelled_sample(d, lab, "toxic", 30, 10_000)
    assert len(texts) == 60 and y.sum() == 30
    secret = {t for i, t in docs if held(i)} - {t for i, t in docs if not held(i)}
    assert not secret & set(texts)
    assert max(map(len, labelled_sample(d, lab, "toxic", 500, 100)[0])) <= 100


def test_every_word_is_in_a_window():
    for n in (0, 1, 31, 32, 33, 56, 57, 1000):
        starts = toxicity.window_starts(n)
        covered = {w for s in starts for w in range(s, s + toxicity.WINDOW)}
        assert set(range(n)) <= covered
        assert n <= toxicity.WINDOW or (max(starts) + toxicity.WINDOW == n
                                        and (np.diff(starts) < toxicity.WINDOW).all())


def test_a_lexicon_leaves_no_words_behind(monkeypatch):
    """Words numbered before a reset, and by lexicons of earlier tasks, go without the garbage collector."""
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 100)
    network = toxicity.Network([], seed=1)
    gc.collect()
    gc.disable()
    tracemalloc.start()
    try:
        for task in range(5):
            lexicon = toxicity.Lexicon(network)
            for turn in range(5):
                lexicon.windows([" ".join(f"w{task}x{turn}x{i}" for i in range(2000))])
            del lexicon
        assert tracemalloc.get_traced_memory()[0] < 500_000
    finally:
        tracemalloc.stop()
        gc.enable()


def test_a_table_that_grows_is_the_table_of_all_words(monkeypatch):
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 5000)
    network = toxicity.Network(["w1", "w3000"], seed=1)
    network.words[1:] = 0.5
    network.grams[:] = np.random.default_rng(2).standard_normal(network.grams.shape)
    lexicon = toxicity.Lexicon(network)
    for low, high in ((0, 10), (0, 10), (5, 3000), (2000, 4900), (4000, 7000), (0, 40), (100, 9000)):
        lexicon.windows(["", " ".join(f"w{i}" for i in range(low, high))])
        table, words = lexicon.table_now(), list(lexicon.number)
        vectors = np.concatenate([np.zeros((1, 2 * toxicity.PART), np.float32), network.vectors(words[1:])])
        assert table.shape[1] == len(words)
        assert np.allclose(table, network.projected(vectors), atol=1e-5)


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    network = toxicity.Network([], seed=1)
    network.dense = {k: v.astype(np.float64) for k, v in network.dense.items()}
    vectors = rng.standard_normal((6, 2 * toxicity.PART))
    vectors[0] = 0
    ids = rng.integers(0, 6, (4, 5))
    ids[0] = 0
    y = np.array([0, 1, 0, 1])

    def loss():
        logit = network._pool(network._run(network.projected(vectors), ids, False)[0], ids)[2]
        return np.mean(np.logaddexp(0, logit) - y * logit)

    slopes, on_vectors = network.gradients(network.projected(vectors), vectors, ids, y)
    for values, slope in [*((network.dense[k], slopes[k]) for k in network.dense), (vectors, on_vectors)]:
        for at in rng.choice(values.size, min(5, values.size), replace=False):
            place = np.unravel_index(at, values.shape)
            before = values[place]
            values[place] = before + 1e-3
            up = loss()
            values[place] = before - 1e-3
            down = loss()
            values[place] = before
            assert abs((up - down) / 2e-3 - slope[place]) < 2e-3


def test_features_of_a_word_do_not_depend_on_its_neighbours():
    words = ["a", "straße", "x" * 64, "日本語", "b"]
    sums, grams, starts = word_features(words)
    ends = [*starts[1:], len(grams)]
    for at, w in enumerate(words):
        alone, own, _ = word_features([w])
        assert alone[0] == sums[at] and own.tolist() == grams[starts[at]:ends[at]].tolist()
