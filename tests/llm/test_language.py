"""Language of whole texts: gradients, held-out accuracy, windows, odd rows."""

import random
import zlib

import numpy as np
import pytest

from tidemark.llm import language
from tidemark.llm.common import read

DOCS = "doc_id long, text string, lang string, score string, key string"
PARTS = {"aa": ("the", "ing", "wh", "ou", "nd"), "bb": ("sch", "ein", "ü", "keit", "zu"), "": ("ção", "nh", "ar", "os", "é")}


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 3 == 1


def prose(rng, lang, words):
    return " ".join("".join(rng.choice(PARTS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    return [(i, prose(rng, lang, rng.randint(3, 120)), lang) for i, lang in enumerate(rng.choices(list(PARTS), k=400))]


@pytest.fixture(scope="module")
def network(corpus):
    rows = [(t.encode(), lang) for i, t, lang in corpus if not held(i)]
    return language.train([t for t, _ in rows], [lang for _, lang in rows])


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", "k") for i, t, lang in rows], DOCS).repartition(3)


ODD = [(None, "no id", "aa"), (9001, None, "aa"), (9002, "", "bb"), (9003, " \n", None), (9004, "!!! 123 ???", "bb"),
       (9005, "\U0001F600" * 50, "aa"), (9006, "x", None), (9007, "thewhing", "aa"), (9007, "thewhing", "aa")]


def test_gradients_against_differences():
    rng = np.random.default_rng(1)
    net = language.Network(["a", "b", "c"], 3)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    ids = rng.integers(60, 70, (9, 5)).astype(np.intp)
    labels, counts = rng.integers(0, 3, (9, 5)), rng.random((9, 5)) > 0.3
    slopes, _ = net.gradients(ids, labels, counts)
    for name, values in net.weights.items():
        flat, slope = values.reshape(-1), slopes[name].reshape(-1)
        for i in np.flatnonzero(slope)[::max(1, np.count_nonzero(slope) // 12)]:
            old, loss = flat[i], []
            for step in (1e-2, -1e-2):
                flat[i] = old + step
                loss.append(net.gradients(ids, labels, counts)[1])
            flat[i] = old
            assert abs((loss[0] - loss[1]) / 2e-2 - slope[i]) < 2e-5


def test_held_out(spark, corpus):
    got = language.language(frame(spark, corpus + ODD))
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score", "shares"]
    rows = got.collect()
    assert len(rows) == len(corpus) + len(ODD)
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    truth = {i: lang for i, _, lang in corpus}
    tried = [r for r in rows if r.doc_id in truth and r.held_out]
    assert len(tried) > 80 and np.mean([r.lang_pred == truth[r.doc_id] for r in tried]) > 0.98
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (9001, 9002, 9003, 9004, 9005))
    assert by_id[None].lang_pred in PARTS and by_id[9006].lang_pred in PARTS and by_id[9007].lang_pred == "aa"
    assert {(r.doc_id, r.score) for r in language.language(frame(spark, corpus + ODD)).collect()} == {
        (r.doc_id, r.score) for r in rows}


def test_labels_of_held_out_documents_and_the_lang_of_any_are_not_inputs(spark, corpus):
    other = [(i, t, "bb" if held(i) else lang) for i, t, lang in corpus]
    a, b = (sorted((r.doc_id, r.lang_pred, r.score) for r in language.language(frame(spark, x)).collect())
            for x in (corpus, other))
    assert a == b


def _pooled(network, texts):
    coded = [t.encode() for t in texts]
    return network.pooled(np.frombuffer(b"".join(coded), np.uint8), np.array([len(c) for c in coded], np.int64))


def test_every_part_of_a_long_text_counts(network):
    rng = random.Random(6)
    a, b = prose(rng, "aa", 3_000), prose(rng, "bb", 9_000)
    at = network.languages.index
    shares = _pooled(network, [a + " " + b, a, b, "hm"])
    whole = np.array([len(a.encode()), len(b.encode())]) / len((a + b).encode())
    assert abs(shares[0, at("aa")] - whole[0]) < 0.05 and abs(shares[0, at("bb")] - whole[1]) < 0.05
    # a text scores the same whatever lies beside it
    assert np.allclose(_pooled(network, [a])[0], shares[1], atol=1e-6)
    assert np.allclose(shares.sum(axis=1), 1, atol=1e-5)


def test_windows_agree_with_the_whole(network, monkeypatch):
    rng = random.Random(8)
    texts = [prose(rng, lang, 200) for lang in PARTS]
    parts = _pooled(network, texts)
    monkeypatch.setattr(language, "WINDOW", 1 << 14)
    assert np.abs(parts - _pooled(network, texts)).max() < 0.03


@pytest.mark.parametrize("rows", [[], [(1, "a word", "aa")], [(2, "a word", None), (4, None, "aa")]])
def test_little_to_learn_from(spark, rows):
    got = language.language(frame(spark, rows) if rows else frame(spark, ODD).limit(0)).collect()
    assert len(got) == len(rows)
    learnt = [r for r in rows if r[1] and r[2] and not held(r[0])]
    assert all(r.lang_pred == ("aa" if learnt else "und") for r in got)


def test_given_documents(spark, folder):
    docs = read(spark, folder, "documents")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = [r for r in language.language(docs).collect() if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) >= 0.95
