"""Set questions about keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contract import ENTITY


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def in_all(frames: Sequence[DataFrame], key: str = ENTITY) -> DataFrame:
    return reduce(lambda a, b: a.intersect(b), [f.select(key) for f in frames])


def only_in_first(frames: Sequence[DataFrame], key: str = ENTITY) -> DataFrame:
    return reduce(lambda a, b: a.subtract(b), [f.select(key) for f in frames])


def overlap_report(frames: Mapping[str, DataFrame], key: str = ENTITY) -> DataFrame:
    """Distinct keys per table, in all of them and in the first only, from one grouping.

    Each table adds a bit; keys are reduced on the map side and shuffled once.
    """
    tagged = reduce(lambda a, b: a.unionByName(b), [
        f.select(F.col(key).alias("_k"), F.lit(1 << i).alias("_bit"))
        for i, f in enumerate(frames.values())])
    seen = tagged.groupBy("_k").agg(F.bit_or("_bit").alias("_in"))
    names = list(frames)
    full = (1 << len(names)) - 1
    counts = {f"n_{n}": F.count_if(F.col("_in").bitwiseAND(1 << i) > 0)
              for i, n in enumerate(names)}
    counts["n_in_all"] = F.count_if(F.col("_in") == full)
    counts[f"n_{names[0]}_only"] = F.count_if(F.col("_in") == 1)
    return seen.agg(*[c.alias(n) for n, c in counts.items()])
