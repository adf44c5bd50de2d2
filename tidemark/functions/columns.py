"""Column expressions for cleaning and feature derivation. All of them stay in codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import contract


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_date(c: Column | str) -> Column:
    """Date, or null where the text is no date (also under ANSI mode)."""
    return _col(c).try_cast("date")


def to_double(c: Column | str) -> Column:
    """Number from text, or null where the text is no number."""
    return _col(c).try_cast("double")


def or_sentinel(c: Column | str, sentinel: float = contract.NO_CONTRACT_END) -> Column:
    return F.coalesce(_col(c), F.lit(sentinel))


def or_unknown(c: Column | str, label: str = contract.UNKNOWN) -> Column:
    return F.coalesce(_col(c), F.lit(label))


def prefix_ordinal(c: Column | str, length: int = 2) -> Column:
    """Integer held in the first characters ("03 Mid" -> 3); null where there is none."""
    return F.substring(_col(c), 1, length).try_cast("int")


def pct_gap(expected: Column | str, actual: Column | str, digits: int = 2) -> Column:
    """Shortfall of ``actual`` in percent of ``expected``; 0 unless ``expected`` is positive."""
    want, got = _col(expected), _col(actual)
    return F.when(want > 0, F.round((want - got) / want * 100, digits)).otherwise(F.lit(0.0))


def bucket_label(c: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Left-closed buckets. A null value takes the last label, as an open-ended chain does."""
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    value, result = _col(c), F.lit(labels[-1])
    for edge, label in reversed(list(zip(edges, labels))):
        result = F.when(value < edge, F.lit(label)).otherwise(result)
    return result


def tenure_bucket(days: Column | str) -> Column:
    return bucket_label(days, contract.TENURE_EDGES, contract.TENURE_LABELS)


def month_key(c: Column | str) -> Column:
    """First day of the month as DATE, so that equality with a snapshot date holds."""
    return F.trunc(_col(c), "month")


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for null)."""
    return F.when(condition, 1).otherwise(0)


def category_flags(c: Column | str, values: Mapping[str, str]) -> dict[str, Column]:
    return {name: flag(_col(c) == value) for name, value in values.items()}


def completion_text(c: Column | str) -> Column:
    return F.when(_col(c).isNotNull(), "Completed").otherwise("Pending/Retracted")


def growth(current: Column | str, previous: Column | str) -> Column:
    """Relative change; null where there is no positive base."""
    now, base = _col(current), _col(previous)
    return F.when(base > 0, (now - base) / base)


def split_label(date: Column | str, train_end: str = contract.TRAIN_END,
                validation_end: str = contract.VALIDATION_END) -> Column:
    d = _col(date)
    return (F.when(d < F.lit(train_end).cast("date"), "train")
            .when(d < F.lit(validation_end).cast("date"), "validation")
            .otherwise("test"))


def clip(c: Column | str, low: float, high: float) -> Column:
    """Value held within the bounds; null stays null (``least`` alone would skip it)."""
    value = _col(c)
    return F.when(value < low, F.lit(low)).when(value > high, F.lit(high)).otherwise(value)


def hash_position(c: Column | str) -> Column:
    """Place of a key on a fixed pseudo-random line of 52 bits.

    The same on every engine that has md5, and exact as a double.
    """
    return F.conv(F.substring(F.md5(_col(c).cast("string")), 1, 13), 16, 10).cast("bigint")


def in_hash_fraction(c: Column | str, fraction: float) -> Column:
    return hash_position(c) < int(fraction * (1 << 52))
