"""Exact and near dedup against plain comparisons of all texts."""

import hashlib
import random
import re

import pytest

from tidemark.llm import exact_dedup, near_dedup
from tidemark.llm.components import components

SCHEMA = "doc_id long, text string, kept string, row string, members string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], SCHEMA).repartition(3)


def key(row):
    return tuple((x is not None, str(x)) for x in row)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    base = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.randint(1, 80))) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t.replace(" ", " \t\n")) for i, t in enumerate(base[:15])]
    rows += [(200, "ä" * 3000 + "x"), (201, "ä" * 3000 + "y"), (202, "ä" * 3000 + "x"), (203, "ä" * 24), (204, "ä" * 24),
             (205, None), (206, ""), (207, " "), (208, "a"), (209, "a"), (None, "a"), (None, "only null"),
             (210, "twice"), (210, "twice"), (211, "b" * 48), (212, "b" * 48), (213, "b" * 560), (214, "b" * 560)]
    rows += [(300 + i, "z" * 400_000) for i in range(3)] + [(400 + i, "hot copy of a text") for i in range(150)]
    return rows


def test_exact(spark, texts):
    got = exact_dedup.exact_dedup_decisions(frame(spark, texts)).collect()
    plain = {}
    for i, t in texts:
        plain.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    want = []
    for t, ids in plain.items():
        keep = min((i for i in ids if i is not None), default=None)
        for n, i in enumerate(sorted(ids, key=lambda x: (x is None, x or 0))):
            want.append((i, keep, len(ids), n == 0, hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_exact_keeps_columns_and_one_of_each(spark, texts):
    docs = frame(spark, texts)
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in texts})


def test_exact_empty(spark):
    assert exact_dedup.exact_dedup_decisions(frame(spark, [])).count() == 0
    assert exact_dedup.exact_dedup(frame(spark, [])).count() == 0


def sets_of(text, words):
    parts = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not parts:
        return frozenset()
    n = min(words, len(parts))
    return frozenset(tuple(parts[i:i + n]) for i in range(len(parts) - n + 1))


def near_by_hand(rows, words, percent):
    sets = [sets_of(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    parent[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for n, (i, _) in enumerate(rows):
        root = find(n)
        least[root] = min((x for x in (least.get(root), i) if x is not None), default=None)
    return [(i, len(sets[n]), least[find(n)], i == least[find(n)]) for n, (i, _) in enumerate(rows)]


@pytest.fixture(scope="module")
def near_rows():
    """Chains of edits, a dense group, and texts around a shared passage that are not alike."""
    rng = random.Random(5)
    word = lambda: f"t{rng.randint(0, 5000)}"
    rows, n = [], 0
    for size in (3, 8, 40, 120):
        for _ in range(6):
            text = [word() for _ in range(size)]
            for _ in range(5):
                rows.append((n, " ".join(text)))
                n += 1
                text = list(text)
                for _ in range(max(1, size // 60)):
                    text[rng.randrange(size)] = word()
    dense = [word() for _ in range(200)]
    for _ in range(60):
        copy = list(dense)
        copy[rng.randrange(200)] = word()
        rows.append((n, " ".join(copy)))
        n += 1
    passage = [word() for _ in range(60)]
    for _ in range(60):
        rows.append((n, " ".join(passage + [word() for _ in range(rng.randint(5, 40))])))
        n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, "One two"), (n + 3, "one TWO"), (n + 4, "one"), (n + 5, "Éone two three"),
             (n + 6, "éone two three"), (None, "one two"), (n + 7, "same row here"), (n + 7, "same row here")]
    return rows


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_near(spark, near_rows, words, percent):
    got = near_dedup.near_dedup_decisions(frame(spark, near_rows), words, percent).collect()
    assert sorted(map(tuple, got), key=key) == sorted(near_by_hand(near_rows, words, percent), key=key)


def test_small_blocks_give_the_same(spark, near_rows, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    got = near_dedup.near_dedup_decisions(frame(spark, near_rows), 3, 85).collect()
    assert sorted(map(tuple, got), key=key) == sorted(near_by_hand(near_rows, 3, 85), key=key)


def test_near_keeps_one_of_each(spark, near_rows):
    docs = frame(spark, near_rows)
    kept = near_dedup.near_dedup(docs, 3, 85)
    assert kept.columns == docs.columns
    want = near_by_hand(near_rows, 3, 85)
    assert kept.count() == len({c for _, n, c, _ in want if n}) + sum(1 for _, n, _, _ in want if not n)


def test_near_empty_and_alone(spark):
    assert near_dedup.near_dedup_decisions(frame(spark, [])).count() == 0
    alone = near_dedup.near_dedup_decisions(frame(spark, [(4, "nobody else says this"), (None, None)])).collect()
    assert sorted(map(tuple, alone), key=key) == sorted([(4, 1, 4, True), (None, 0, None, True)], key=key)


def test_chance_to_miss():
    m = near_dedup.collection_size(85)
    assert 2 * (1 - 0.85 ** 2) ** m <= near_dedup.MISS < 2 * (1 - 0.85 ** 2) ** (m - 1)


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (102, 101)] + [(200, i) for i in range(201, 260)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 102), 100),
                   **dict.fromkeys(range(200, 260), 200)}


def test_what_is_connected_is_not_compared_again(spark):
    # one lead: 3,000 members of one component, 40 outside it in three others
    members = spark.createDataFrame([(0, b, 1) for b in range(1, 3001)] + [(0, b, 5000 + b % 3) for b in range(4000, 4040)]
                                    + [(9, b, 7) for b in range(6000, 6100)], "a long, b long, component long")
    spread = near_dedup._spread(members)
    assert [tuple(r) for r in spread.collect()] == [(0, 1, 12, 1)]
    cells = near_dedup._dealt(members, spread).toPandas()
    assert len(cells) == 3000 + 40 * 13
    met = set()
    for (first, second), cell in cells.groupby(["first", "second"]):
        left, right = (cell, cell) if first == second else (cell[cell.side == 0], cell[cell.side == 1])
        met |= {(min(x, y), max(x, y)) for x in left.b for y in right.b if x != y}
    outside = range(4000, 4040)
    assert met == {(x, y) for y in outside for x in [*range(1, 3001), *outside] if x < y}
