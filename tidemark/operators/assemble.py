"""Wide assembly, training sets, keep-one, fills, splits, snapshots and samples."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.contract import ENTITY, OBSERVED
from tidemark.functions.columns import hash_position, pct_gap, split_label, tenure_bucket
from tidemark.operators.quantiles import kth_smallest

KEYS = (ENTITY, OBSERVED)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()) -> DataFrame:
    """One row per key: the first by ``order``, then by all other columns.

    An aggregate instead of a ranking window, so copies of one key meet on the
    map side and no task ever holds them all.
    """
    rest = [c for c in df.columns if c not in keys]
    ranks = [(F.col(o) if isinstance(o, str) else o).alias(f"_o{i}") for i, o in enumerate(order)]
    packed = F.min(F.struct(*ranks, *[F.col(c) for c in rest])).alias("_row")
    return (df.groupBy(*keys).agg(packed)
            .select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c)
                      for c in df.columns]))


def join_parts(base: DataFrame, parts: Sequence[DataFrame],
               keys: Sequence[str] = KEYS) -> DataFrame:
    """Chain of left joins on the same keys; the base is shuffled once for all of them."""
    return reduce(lambda a, b: a.join(b, list(keys), "left"), parts, base)


def join_labels(features: DataFrame, labels: DataFrame, keys: Sequence[str] = KEYS,
                train_end: str = contract.TRAIN_END,
                validation_end: str = contract.VALIDATION_END) -> DataFrame:
    return (features.join(labels, list(keys), "inner")
            .withColumn("split", split_label(OBSERVED, train_end, validation_end)))


def fill_missing(df: DataFrame, numeric: Sequence[str] = contract.NUMERIC_FEATURES,
                 recency_prefix: str = "days_since_",
                 never: float = contract.NEVER_HAPPENED_DAYS) -> DataFrame:
    """0 for missing numbers, a far-away day count for things that never happened."""
    present = [c for c in numeric if c in df.columns]
    return df.fillna({c: never if c.startswith(recency_prefix) else 0 for c in present})


def with_defaults(df: DataFrame,
                  numeric: Mapping[str, tuple] = contract.RECORD_RANGES,
                  text: Mapping[str, str] = contract.RECORD_TEXT_DEFAULTS) -> DataFrame:
    """Complete partial records: absent columns are added, nulls replaced."""
    wanted: dict[str, Column] = {}
    for name, (default, _, _) in numeric.items():
        value = F.lit(float(default))
        wanted[name] = (F.coalesce(F.col(name).cast("double"), value)
                        if name in df.columns else value)
    for name, default in text.items():
        value = F.lit(default)
        wanted[name] = F.coalesce(F.col(name), value) if name in df.columns else value
    return df.withColumns(wanted)


def latest(df: DataFrame, date: str = OBSERVED) -> DataFrame:
    """Rows of the newest date. The date is a scalar subquery, never fetched to the driver."""
    newest = df.agg(F.max(date).alias("_newest")).scalar()
    return df.where(F.col(date) == newest)


def quantile_split(df: DataFrame, date: str = OBSERVED, train: float = 0.7,
                   validation: float = 0.85) -> DataFrame:
    """Split by dates that leave the given shares of rows before them.

    Rows are counted per date first; the number of dates is bounded by the calendar.
    """
    days = (df.where(F.col(date).isNotNull())
            .groupBy(F.unix_date(date).alias("_d")).agg(F.count("*").alias("_n")))
    cuts = days.agg(F.percentile("_d", F.array(F.lit(train), F.lit(validation)),
                                 F.col("_n")).alias("_cuts")).scalar()
    day = F.unix_date(date)
    return df.withColumn("split", F.when(day >= cuts[1], "test")
                         .when(day >= cuts[0], "validation").otherwise("train"))


def hash_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """A repeatable sample by key; the same rows on every run and cluster."""
    return df.where(hash_position(key) < int(fraction * (1 << 52)))


def bernoulli_sample(df: DataFrame, fraction: float = 0.01, seed: int = 42) -> DataFrame:
    return df.sample(fraction=fraction, seed=seed)


def _first_by_hash(entities: DataFrame, entity: str, n: int) -> DataFrame:
    """The n entities first on the hash line (ties by id); all of them if there are fewer."""
    placed = entities.select(entity, hash_position(entity).alias("_place"))
    cut = kth_smallest(placed, "_place", n)
    if cut is None:
        return placed.select(entity)
    place, missing = cut
    inside = placed.where(F.col("_place") < place)
    tied = placed.where(F.col("_place") == place).orderBy(entity).limit(missing)
    return inside.unionByName(tied).select(entity)


def stratified_entities(all_entities: DataFrame, positives: DataFrame, n: int,
                        share: float = 0.3, entity: str = ENTITY) -> DataFrame:
    """n entities, ``share`` of them positive (fewer if there are not enough positives)."""
    known = positives.select(entity).where(F.col(entity).isNotNull()).distinct()
    others = (all_entities.select(entity).where(F.col(entity).isNotNull()).distinct()
              .join(known, entity, "left_anti"))
    n_positive = min(int(n * share), known.count())
    chosen = _first_by_hash(known, entity, n_positive).withColumn("stratum", F.lit("positive"))
    return chosen.unionByName(_first_by_hash(others, entity, n - n_positive)
                              .withColumn("stratum", F.lit("other")))


def restrict_to(df: DataFrame, entities: DataFrame, entity: str = ENTITY) -> DataFrame:
    return df.join(entities.select(entity).distinct(), entity, "left_semi")


def never_in(df: DataFrame, events: DataFrame, entity: str = ENTITY) -> DataFrame:
    """Distinct entities of ``df`` that have no event."""
    return (df.select(entity).distinct()
            .join(events.select(entity).distinct(), entity, "left_anti"))


def complete_domain(counts: DataFrame, column: str, domain: Sequence[str],
                    zero: Sequence[str]) -> DataFrame:
    """Every value of a small fixed domain, with 0 where the data has none."""
    spark = counts.sparkSession
    values = spark.createDataFrame([(v,) for v in domain], f"{column} string")
    return (values.join(counts, column, "left")
            .withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero}))


def partial_features(df: DataFrame) -> DataFrame:
    """Features derived from the few inputs a user types in (85/15 traffic split, 30-day month)."""
    total = F.col("monthly_total_mb")
    return df.withColumns({
        "speed_gap_pct": pct_gap("speed", "line_speed"),
        "tenure_bucket": tenure_bucket("tenure_days"),
        "monthly_download_mb": total * 0.85,
        "monthly_upload_mb": total * 0.15,
        "avg_daily_download_mb": total * 0.85 / 30,
        "active_days_in_month": F.lit(30.0),
    })


