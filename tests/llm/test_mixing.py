"""Mixing against a plain queue on one machine."""

import hashlib
import re

import pytest

from tidemark.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, copies string, row string"


def by_hand(rows, weights=(5, 2, 1), epochs=3):
    """Targets by filling round after round; then one queue of all entries."""
    sized = [(i, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), n) for n, (i, t, s) in enumerate(rows)]
    sources = sorted({s for _, s, _, _ in sized}, key=lambda s: (s is None, s or ""))
    size = {s: sum(w for _, x, w, _ in sized if x == s) for s in sources}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(sources)}
    budget, target, open_ = sum(size.values()), {}, list(sources)
    while open_:
        left = budget - sum(target.values())
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] > epochs * size[s] * total]
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        first = min(over, key=lambda s: (size[s] / weight[s], sources.index(s)))
        target[first] = float(epochs * size[first])
        open_.remove(first)
    entries = []
    for s in sources:
        key = sorted((hashlib.md5(str("" if i is None else i).encode()).hexdigest(), i is None, i or 0, w, n)
                     for i, x, w, n in sized if x == s)
        sent = 0
        for h, no, i, w, n in key:
            sent += w
            for e in range(epochs):
                finish = (e * size[s] + sent) / target[s] if target[s] > 0 else 0.0
                entries.append((finish, s is None, s or "", e, h, no, i, w, n))
    entries.sort()
    copies, total = dict.fromkeys(range(len(rows)), 0), 0
    for entry in entries:
        total += entry[-2]
        if total > budget:
            break
        copies[entry[-1]] += 1
    return [(i, w, size[s], target[s], copies[n] * w) for i, s, w, n in sized]


@pytest.fixture(scope="module")
def rows():
    out = [(i, "w " * (1 + i * 7 % 23), f"s{i % 5}") for i in range(120)]
    out += [(500 + i, "big " * 9, "hot") for i in range(60)]
    out += [(None, "no id here", "s1"), (900, None, "s2"), (901, "", None), (902, "a\tb\nc\x0bd", None),
            (903, "twice the same", "s3"), (903, "twice the same", "s3"), (904, "x" * 100_000, "s4"),
            (905, " \t ", "empty")]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", "y", "z") for i, t, s in rows], SCHEMA)


def test_as_by_hand(spark, rows):
    got = mixing.mix_decisions(frame(spark, rows)).select("doc_id", "size", "source_size", "target", "taken")
    order = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted(map(tuple, got.collect()), key=order) == sorted(by_hand(rows), key=order)


def test_targets_are_met_and_capped(spark, rows):
    got = mixing.mix_decisions(frame(spark, rows)).toPandas()
    assert (got["taken"] <= 3 * got["size"]).all()
    by_source = got.groupby("source", dropna=False).agg({"taken": "sum", "target": "first", "source_size": "first"})
    assert (by_source["target"] <= 3 * by_source["source_size"]).all()
    assert ((by_source["taken"] - by_source["target"]).abs() <= got["size"].max()).all()
    assert abs(by_source["target"].sum() - got["size"].sum()) < 1e-6


def test_mixed_rows_keep_their_columns(spark, rows):
    docs = frame(spark, rows)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    taken = mixing.mix_decisions(docs).agg({"copies": "sum"}).first()[0]
    assert mixed.count() == taken


def test_empty(spark):
    none = frame(spark, [])
    assert mixing.mix_decisions(none).count() == 0
    assert mixing.mix(none).count() == 0


def test_no_words_at_all(spark):
    got = mixing.mix_decisions(frame(spark, [(1, None, "a"), (2, " ", None)]))
    assert [r["taken"] for r in got.collect()] == [0, 0]
