"""Fill-in-the-middle: a text's units are cut at two drawn places and its three parts put in a new order.

One match of ``(unit)*`` over the whole text keeps every repetition of its group, so the ends of
that group are the number of units and the offsets of both cuts at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.llm.common import let, quoted, whole

LINE = r"[^\n]*\n|[^\n]+"
MARKS = ("<P>", "<S>", "<M>")       # before the prefix, the suffix, the middle
FLUSH_CHARS = 8_000_000             # of texts in an output batch, unless one text has more


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers of 32 bits from the digest of ``seed:key``; a null key counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _checked(marks: tuple[str, str, str]) -> tuple[str, str, str]:
    clash = any(b in a for i, a in enumerate(marks) for k, b in enumerate(marks) if i != k)
    if clash or not all(marks) or any(a.endswith(b[:k]) for a in marks for b in marks for k in range(1, len(b))):
        raise ValueError(f"marks must be told apart wherever they meet: {marks}")
    return marks


def _cut(text: str, ends: list[int], one: int, two: int) -> tuple[int, int]:
    """Offsets where the middle begins and ends: after the smaller and the larger number of units."""
    n = len(ends)
    low, high = sorted((one % (n + 1), two % (n + 1)))
    return (ends[low - 1] if low else 0), (ends[high - 1] if high else 0)


def _batches(unit: str, marks: tuple[str, str, str], spm: int):
    p, s, m = marks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(f"({unit})*").fullmatch
        for batch in batches:
            rows, chars, done = [], 0, 0
            texts = batch.column(1)
            draw = [batch.column(i).to_pylist() for i in range(2, 6)]
            for at in range(batch.num_rows):
                text = texts[at].as_py()
                match = units(text)
                ends = match.ends(1) if match else []
                if not draw[2][at] or not ends:
                    rows.append((len(ends), "plain", None, None, text))
                else:
                    start, stop = _cut(text, ends, draw[0][at], draw[1][at])
                    prefix, middle, suffix = text[:start], text[start:stop], text[stop:]
                    if draw[3][at] % 100 < spm:
                        rows.append((len(ends), "spm", start, stop - start, s + suffix + p + prefix + m + middle))
                    else:
                        rows.append((len(ends), "psm", start, stop - start, p + prefix + s + suffix + m + middle))
                chars += len(text)
                if chars >= FLUSH_CHARS or at == batch.num_rows - 1:
                    n, form, before, inside, output = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(done, len(rows)), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                         pa.array(before, pa.int64()), pa.array(inside, pa.int64()), pa.array(output, pa.string())],
                        names=["key", "n", "form", "prefix_chars", "middle_chars", "output"])
                    done, rows, chars = at + 1, [], 0

    return run


def infill(docs: DataFrame, key: str = "doc_id", text: str = "text", *, unit: str = LINE, seed: int = 7,
           rate: int = 100, spm: int = 50, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """``key, n, form, prefix_chars, middle_chars, output`` of each row.

    ``n`` is the number of units, ``form`` is ``psm`` (prefix, suffix, middle), ``spm`` (suffix,
    prefix, middle; ``spm`` of 100 of those changed) or ``plain``, and the lengths count code
    points. A text stays plain, with null lengths, if it is empty or null, if it holds a mark, if
    the units do not cover it (``n`` is 0 then), and otherwise for 100 - ``rate`` of 100 texts.

    Draws depend on seed and key alone, so reruns agree and rows repeated under one key are cut
    alike; a null key draws as an empty one and stays null. Columns other than the two are not
    read. Any text, of any length, is cut whole; a task holds about 50 bytes a unit of the
    text at hand.
    """
    p, s, m = _checked(marks)
    body = whole(docs[quoted(text)])
    h = draws(docs[quoted(key)], seed)
    changes = ~(body.contains(p) | body.contains(s) | body.contains(m)) & (h[2] % 100 < rate)
    frame = docs.select(docs[quoted(key)].alias("key"), body.alias("text"), h[0].alias("one"), h[1].alias("two"),
                        changes.alias("changes"), h[3].alias("order"))
    schema = StructType([
        StructField("key", docs.schema[key].dataType), StructField("n", LongType()), StructField("form", StringType()),
        StructField("prefix_chars", LongType()), StructField("middle_chars", LongType()),
        StructField("output", StringType())])
    return frame.mapInArrow(_batches(unit, marks, spm), schema).withColumnRenamed("key", key)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that ``output`` was made from; a changed text holds no mark, so its parts lie between them."""
    either = "|".join(regex.escape(x) for x in _checked(marks))
    changed = let(F.split(output, either), lambda part: F.when(
        form == "psm", F.concat(part[1], part[3], part[2])).otherwise(F.concat(part[2], part[3], part[1])))
    return F.when(form == "plain", output).otherwise(changed)
