"""Layered tables: names, writes, properties, layout, counts."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tidemark.contract import ACTION_LISTS, ENTITY, OBSERVED
from tidemark.operators.actions import action_list
from tidemark.operators.quality import key_violations
from tidemark.session import fresh_folder

LAYERS = ("bronze", "silver", "gold", "ml")


def namespace(base: str, env: str = "prod") -> str:
    """``base`` in production, ``base_env`` elsewhere."""
    return base if env == "prod" else f"{base}_{env}"


def database(base: str, layer: str, env: str = "prod") -> str:
    return f"{namespace(base, env)}_{layer}"


def create_layers(spark: SparkSession, base: str, env: str = "prod") -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database(base, layer, env)}")


def read_table(spark: SparkSession, base: str, layer: str, name: str, env: str = "prod"
               ) -> DataFrame:
    return spark.table(f"{database(base, layer, env)}.{name}")


@contextmanager
def _session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting for the time of one write: inserts into tables take it from the session only."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def evened(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows gathered by their table partition before a partitioned write.

    A rebalance, so small partitions share a task and a large one is split over
    many: neither a file per task and partition, nor one task for a hot month.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by])


def write_table(df: DataFrame, name: str, partition_by: Sequence[str] = (),
                mode: str = "overwrite", fmt: str = "parquet", laid_out: bool = False) -> int:
    """Write a table and return the rows written, counted by the write itself.

    ``laid_out`` says that the rows already lie where they belong, ranged and sorted with the
    table's partitions first: they are written as they come.
    ``mode="refresh"`` replaces only the partitions that the data touches.
    """
    counter = Observation()
    counted = df.observe(counter, F.count("*").alias("rows"))
    if mode == "refresh":
        with _session_setting(df.sparkSession, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            counted.select(*df.sparkSession.table(name).columns).write.insertInto(name, overwrite=True)
    else:
        writer = counted.write.mode(mode).format(fmt)
        if partition_by:
            placed = counted if laid_out else evened(counted, partition_by)
            writer = placed.write.mode(mode).format(fmt).partitionBy(*partition_by)
        writer.saveAsTable(name)
    return counter.get["rows"]


def materialise(df: DataFrame, label: str = "shared") -> DataFrame:
    """Write a frame that several jobs or subqueries read, and return it as a scan.

    The files lie in the shared folder of the session, so the result outlives
    lost executors and nothing before it is computed again.
    """
    folder = fresh_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def publish_features(df: DataFrame, name: str, keys: Sequence[str] = (ENTITY, OBSERVED)) -> int:
    """Write a feature table whose keys are unique and set, or fail before it is replaced."""
    broken = key_violations(df, keys).limit(1).count()
    if broken:
        raise ValueError(f"{name}: keys {tuple(keys)} repeat or hold nulls")
    rows = write_table(df, name)
    set_properties(df.sparkSession, name, {"primary_key": ",".join(keys)})
    return rows


def write_action_lists(scores: DataFrame, database_name: str) -> dict[str, int]:
    return {lst: write_table(action_list(scores, tier), f"{database_name}.action_list_{lst}")
            for lst, tier in ACTION_LISTS.items()}


def append_log(df: DataFrame, name: str) -> int:
    """Append to a log table, stamped with the time of computing."""
    return write_table(df.withColumn("computed_at", F.current_timestamp()), name, mode="append")


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header, written by the executors."""
    df.write.mode("overwrite").option("header", True).csv(path)


def set_properties(spark: SparkSession, name: str, properties: Mapping[str, str],
                   comment: str | None = None) -> None:
    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    pairs = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in properties.items())
    if pairs:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {name} IS {quoted(comment)}")


def cluster_layout(df: DataFrame, columns: Sequence[str], partitions: int | None = None
                   ) -> DataFrame:
    """Lay rows out by their lookup columns, so that file and row-group ranges can be skipped."""
    ranged = (df.repartitionByRange(partitions, *columns) if partitions
              else df.repartitionByRange(*columns))
    return ranged.sortWithinPartitions(*columns)


Z_BITS = 8      # of each column's place: 256 ranges


def range_starts(df: DataFrame, column: str, ranges: int) -> list:
    """The least values of ``ranges`` stretches with about equally many distinct values each; any type with an order.

    The driver gets one value per range.
    """
    dealt = df.select(column).where(F.col(column).isNotNull()).distinct().repartitionByRange(ranges, column)
    starts = dealt.groupBy(F.spark_partition_id().alias("_range")).agg(F.min(column).alias("low")).collect()
    return sorted(r["low"] for r in starts)


def _place(value: Column, starts: Column, bits: int) -> Column:
    """How many of the sorted starts lie at or below the value, by halving."""
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda place, step: place + F.when(
        F.get(starts, place + step - 1) <= value, step).otherwise(0))


def z_value(df: DataFrame, columns: Sequence[str], bits: int = Z_BITS) -> Column:
    """The place of a row on a curve through all columns: the bits of their ranges, dealt in turn.

    A column counts by the rank of its value, so neither its type nor its distribution matters; nulls
    are first. Columns named first have the higher bit of each round.
    """
    if bits * len(columns) > 62:
        raise ValueError(f"{len(columns)} columns of {bits} bits do not fit a curve of 62")
    out = F.lit(0).cast("long")
    for at, column in enumerate(columns):
        kind = df.schema[column].dataType
        starts = F.lit(range_starts(df, column, (1 << bits) - 1)).cast(ArrayType(kind))
        place = _place(F.col(column), starts, bits)
        for b in range(bits):
            bit = F.shiftright(place, b).bitwiseAND(F.lit(1)).cast("long")
            out = out.bitwiseOR(F.shiftleft(bit, b * len(columns) + len(columns) - 1 - at))
    return out


def z_order(df: DataFrame, columns: Sequence[str], files: int | None = None, bits: int = Z_BITS) -> DataFrame:
    """Lay rows out along a Z curve through the columns, so that a lookup by any one of them skips files.

    Files are cut along the curve. The ranges of the columns are found first, one pass over each
    column, so the input is read several times: pass a table.
    """
    z = F.col("_z")
    placed = df.withColumn("_z", z_value(df, columns, bits))
    ranged = (placed.repartitionByRange(files, z, *columns) if files else placed.repartitionByRange(z, *columns))
    return ranged.sortWithinPartitions(z, *columns).drop("_z")


def file_ranges(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(file, low_..., high_...): the least and the largest value of each column in each file."""
    return table.groupBy(F.input_file_name().alias("file")).agg(
        *[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("low", F.min), ("high", F.max))])


def opened_share(table: DataFrame, column: str) -> DataFrame:
    """(files, share): the mean share of files that a lookup by one value of the column must open.

    Every distinct value is looked up once; a file must be opened if the value lies in its range. The side
    that is broadcast has a row per file.
    """
    ranges = file_ranges(table, [column])
    values = table.select(F.col(column).alias("value")).where(F.col(column).isNotNull()).distinct()
    files = ranges.count()      # a row per file
    met = values.join(F.broadcast(ranges), F.col("value").between(F.col(f"low_{column}"), F.col(f"high_{column}")))
    return met.groupBy("value").agg(F.count("*").alias("n")).agg(
        F.lit(files).cast("long").alias("files"), (F.avg("n") / F.lit(files)).alias("share"))
