"""Regular-expression matches with their places, as column expressions.

Places are code points. Nothing here leaves a row: no join, no shuffle, no Python.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.llm.common import let

BEFORE = 32     # characters of context that come with a match
HIT = ("array<struct<start:int,end:int,value:string,before:string,after:string>>")


def nothing(kind: str) -> Column:
    return F.array().cast(kind)


def running_sums(numbers: Column) -> Column:
    """Inclusive running sums, block by block, so n numbers cost n * sqrt(n) copies at most."""
    def added(block: Column) -> Column:
        return F.aggregate(block, F.array(F.lit(0)),
                           lambda sums, x: F.concat(sums, F.array(F.element_at(sums, -1) + x)))

    def in_blocks(all_numbers: Column, width: Column) -> Column:
        count = F.ceil(F.size(all_numbers) / width).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), count - 1),
                             lambda b: added(F.slice(all_numbers, b * width + 1, width)))
        return let(blocks, lambda summed: let(
            added(F.transform(summed, lambda s: F.element_at(s, -1))),
            lambda offsets: F.flatten(F.transform(summed, lambda s, b: F.transform(
                F.slice(s, F.lit(2), F.size(s) - 1), lambda x: x + F.get(offsets, b))))))

    return let(numbers, lambda n: F.when(F.size(n) == 0, n).otherwise(
        let(F.ceil(F.sqrt(F.size(n))).cast("int"), lambda width: in_blocks(n, width))))


def hits(text: Column, pattern: str, group: int = 0, over: int = 0) -> Column:
    """Leftmost non-overlapping matches: start, end, value of the group, and what stands around.

    The pieces between matches and the matches themselves, end to end, give the places. A text
    without a match is looked at once. What stands before a match goes back over that many of
    the matches before it.
    """
    def before(s: Column, i: Column) -> Column:
        tail = F.get(s["piece"], i)
        if over:
            earlier = [F.coalesce(F.get(s[name], i - back), F.lit(""))
                       for back in range(over, 0, -1) for name in ("piece", "hit")]
            tail = F.concat(*[F.right(e, F.lit(BEFORE)) for e in earlier], tail)
        return F.right(tail, F.lit(BEFORE))

    def placed(s: Column) -> Column:
        steps = F.transform(s["hit"], lambda h, i: F.length(h) + F.length(F.get(s["piece"], i)))
        return let(running_sums(steps), lambda ends: F.transform(s["hit"], lambda h, i: F.struct(
            (F.get(ends, i) - F.length(h)).cast("int").alias("start"), F.get(ends, i).cast("int").alias("end"),
            F.get(s["value"], i).alias("value"), before(s, i).alias("before"),
            F.left(F.get(s["piece"], i + 1), F.lit(1)).alias("after"))))

    whole_hit = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole_hit
    parts = F.struct(F.split(text, pattern, -1).alias("piece"), whole_hit.alias("hit"), value.alias("value"))
    return F.when(text.rlike(pattern), let(parts, placed)).otherwise(nothing(HIT))


def overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def count_of(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def listing(spans: Column, names: Sequence[str], key: Callable[[Column], list[Column]]) -> Column:
    """``kind:start:end``, comma-joined in the order of ``key``; ``kind`` indexes ``names``."""
    name = F.array(*[F.lit(n) for n in names])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        *[c.alias(f"k{i}") for i, c in enumerate(key(s))], s["kind"].alias("kind"),
        s["start"].alias("start"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")
