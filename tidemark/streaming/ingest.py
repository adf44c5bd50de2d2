"""Raw file streams into bronze, quality-gated row transforms, and a monthly rollup kept fresh."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.operators.quality import Rule, enforce, recorded
from tidemark.operators.rollup import merged_months, monthly_partials, months_of
from tidemark.sources.readers import with_ingest_meta
from tidemark.sources.tables import evened
from tidemark.streaming.merging import MergedTable


def land(stream: DataFrame, path: str, checkpoint: str, meta: bool = True,
         partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append everything the source has to a bronze folder, exactly once, then stop."""
    rows = with_ingest_meta(stream) if meta else stream
    writer = (rows.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)


def refine(stream: DataFrame, clean: Callable[[DataFrame], DataFrame], rules: Sequence[Rule],
           observation: str | None = None) -> DataFrame:
    """The batch cleaning function and its rules, applied to a stream."""
    return enforce(clean(stream), rules, observation)


def land_checked(stream: DataFrame, clean: Callable[[DataFrame], DataFrame], rules: Sequence[Rule], table: str,
                 path: str, log_path: str, checkpoint: str) -> StreamingQuery:
    """Clean and gate each micro-batch, and keep what every rule found in it.

    Rows go to ``path/batch=n``, counts per rule to ``log_path/batch=n``; the counting rides on the write of
    the rows. Both folders are replaced as a whole, so a repeated batch counts once.
    """
    def step(batch: DataFrame, number: int) -> None:
        seen = Observation()
        enforce(clean(batch), rules, seen).write.mode("overwrite").parquet(f"{path}/batch={number}")
        (recorded(batch.sparkSession, table, str(number), rules, seen.get).drop("batch").coalesce(1)
         .write.mode("overwrite").parquet(f"{log_path}/batch={number}"))

    return (stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def monthly_refresh(daily: DataFrame, state_path: str, monthly_path: str, checkpoint: str, keep: int = 8
                    ) -> StreamingQuery:
    """Keep monthly aggregates equal to a full rollup while days arrive in any order.

    Each micro-batch is reduced to partial aggregates per (entity, month), which are kept as a
    ``MergedTable`` of few folders; days themselves are not stored. The months that a batch touches are
    merged and replaced. A batch that is repeated after a failure changes nothing.
    """
    spark = daily.sparkSession
    state = MergedTable(spark, state_path, monthly_partials(daily).schema, merged_months, ["month_key"], keep)

    def publish(batch: DataFrame) -> None:
        months = [r[0] for r in batch.select("month_key").distinct().collect()]     # calendar months of one batch
        if months:
            known = [m for m in months if m is not None]
            touched = state.partial().where(F.col("month_key").isin(known)
                                            | (F.col("month_key").isNull() if None in months else F.lit(False)))
            (evened(months_of(merged_months(touched)), ["month_key"]).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("month_key").parquet(monthly_path))

    return state.follow(daily, monthly_partials, checkpoint, publish)


def run(query: StreamingQuery) -> None:
    """Wait for a stream that stops by itself; failures are raised."""
    query.awaitTermination()
    failure = query.exception()
    if failure is not None:
        raise failure


def read_back(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
