"""Batch and stream scans of raw files, with the schema kept beside the stream."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet",
             schema: StructType | str | None = None) -> DataFrame:
    """Parquet or CSV (header; types inferred unless a schema is given)."""
    if fmt == "parquet":
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    if fmt == "csv":
        reader = spark.read.option("header", True)
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        return reader.csv(path)
    raise ValueError(f"unknown format {fmt!r}")


def with_ingest_meta(df: DataFrame) -> DataFrame:
    """Add ingestion time and source file; must come directly after the scan."""
    return df.withColumns({"_ingested_at": F.current_timestamp(),
                           "_source_file": F.col("_metadata.file_name")})


def load_or_infer_schema(spark: SparkSession, path: str, fmt: str, schema_dir: str) -> StructType:
    """The schema kept for a source; inferred from its files and kept on first use."""
    place = spark._jvm.org.apache.hadoop.fs.Path(schema_dir)
    exists = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    if exists:
        kept = spark.read.text(schema_dir, wholetext=True).first()[0]
        return StructType.fromJson(json.loads(kept))
    found = read_raw(spark, path, fmt).schema
    spark.createDataFrame([(found.json(),)], "value string").coalesce(1).write.text(schema_dir)
    return found


def stream_raw(spark: SparkSession, path: str, fmt: str, schema: StructType | str,
               max_files: int | None = None, name_glob: str | None = None) -> DataFrame:
    """New files of a folder as a stream."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.load(path)
