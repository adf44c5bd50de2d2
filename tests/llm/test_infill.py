"""Fill-in-the-middle against plain Python, odd rows, other units and marks."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import infill

DOCS = "doc_id long, text string, key string, n string, output string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "k", "x", "y") for i, t in rows], DOCS).repartition(3)


def by_hand(doc_id, text, rate=100, spm=50):
    text = text or ""
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    lines, line = [], ""
    for c in text:
        line += c
        if c == "\n":
            lines.append(line)
            line = ""
    lines += [line] if line else []
    n = len(lines)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    low, high = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    pre, mid, suf = "".join(lines[:low]), "".join(lines[low:high]), "".join(lines[high:])
    if h4 % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


ODD = [(None, "no id\nat all"), (None, None), (1, None), (2, ""), (3, "\n"), (4, "\n\n\n"), (5, "one"), (6, "a\r\nb\r\n"),
       (7, "has <P> in it\n"), (8, "near <S\n> miss\n<"), (9, "\U0001F600\néß\n中文\n" * 5), (10, "tail <\nP>\n"),
       (11, "same\ntext\n"), (11, "same\ntext\n"), (12, "x" * 200_000), (13, "line of it\n" * 300_000), (14, " \t\n \n")]


@pytest.mark.parametrize(("rate", "spm"), [(100, 50), (60, 0), (100, 100), (0, 50)])
def test_like_plain_python(spark, rate, spm):
    rng = random.Random(3)
    rows = ODD + [(100 + i, "".join(rng.choice("ab\n<P>é") for _ in range(rng.randint(0, 60)))) for i in range(300)]
    got = infill.infill(frame(spark, rows), rate=rate, spm=spm)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    back = got.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    want = sorted(((i, *by_hand(i, t, rate, spm), t or "") for i, t in rows), key=repr)
    assert sorted((tuple(r) for r in back), key=repr) == want


def test_empty_table_and_other_units(spark):
    assert infill.infill(frame(spark, ODD).limit(0)).count() == 0
    rows = frame(spark, [(i, "one two  three") for i in range(40)])
    got = infill.infill(rows, unit=r"\S+\s*", marks=("[a]", "[b]", "[c]")).collect()
    assert {r.n for r in got} == {3} and {r.form for r in got} == {"psm", "spm"}
    assert {r.prefix_chars for r in got} <= {0, 4, 9, 14}
    uncovered = infill.infill(rows, unit=r"[a-z]+").first()
    assert (uncovered.n, uncovered.form, uncovered.output) == (0, "plain", "one two  three")


@pytest.mark.parametrize("marks", [("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("<P>", "<P><", "x"), ("aa", "b", "c")])
def test_marks_that_cannot_be_told_apart(spark, marks):
    with pytest.raises(ValueError, match="marks"):
        infill.infill(frame(spark, ODD), marks=marks)
