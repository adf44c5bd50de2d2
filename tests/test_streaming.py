import datetime as dt

import pytest
from conftest import values
from pyspark.sql import functions as F

from tidemark.contract import ENTITY
from tidemark.operators import quality
from tidemark.operators.rollup import monthly_rollup
from tidemark.plans.cleaning import clean_calls, clean_usage
from tidemark.sources import readers
from tidemark.streaming import ingest, requests

USAGE = f"{ENTITY} string, calendar_date string, usage_download_mbs string, usage_upload_mbs string"


def write_usage(spark, path, rows):
    spark.createDataFrame(rows, USAGE).coalesce(1).write.mode("append").parquet(path)


def refresh(spark, tmp_path, source, **options):
    stream = readers.stream_raw(spark, source, "parquet", USAGE, **options)
    daily = ingest.refine(stream, clean_usage, quality.USAGE_RULES)
    ingest.run(ingest.monthly_refresh(daily, f"{tmp_path}/daily", f"{tmp_path}/monthly", f"{tmp_path}/check"))
    return spark.read.parquet(f"{tmp_path}/monthly")


def test_bronze_lands_each_file_once(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    spark.createDataFrame([("A", 1)], "id string, n int").write.csv(source, header=True)
    for more in range(2):
        stream = readers.stream_raw(spark, source, "csv", "id string, n int")
        ingest.run(ingest.land(stream, out, check))
        assert spark.read.parquet(out).count() == 1 + more
        spark.createDataFrame([("B", 2 + more)], "id string, n int").write.mode("append").csv(source, header=True)
    assert {"_ingested_at", "_source_file"} <= set(spark.read.parquet(out).columns)


def test_monthly_refresh_equals_full_rollup_with_late_files(spark, tmp_path):
    source = str(tmp_path / "in")
    first = [("A", "2024-01-01", "10", "1"), ("A", "2024-02-01", "5", "1"), ("B", "2024-01-03", "bad", "2")]
    late = [("A", "2024-01-20", "30", "3"), ("C", "2024-03-01", "1", "1")]
    write_usage(spark, source, first)
    refresh(spark, tmp_path, source)
    write_usage(spark, source, late)
    got = refresh(spark, tmp_path, source, max_files=1)
    want = monthly_rollup(clean_usage(spark.createDataFrame(first + late, USAGE)))
    assert values(got, *want.columns) == values(want, *want.columns)


def test_repeated_batch_changes_nothing(spark, tmp_path):
    source = str(tmp_path / "in")
    write_usage(spark, source, [("A", "2024-01-01", "10", "1")])
    before = values(refresh(spark, tmp_path, source), ENTITY, "monthly_total_mb")
    stream = readers.stream_raw(spark, source, "parquet", USAGE)
    daily = ingest.refine(stream, clean_usage, quality.USAGE_RULES)
    # a lost checkpoint makes batch 0 run again on the same files
    ingest.run(ingest.monthly_refresh(daily, f"{tmp_path}/daily", f"{tmp_path}/monthly", f"{tmp_path}/check2"))
    assert values(spark.read.parquet(f"{tmp_path}/monthly"), ENTITY, "monthly_total_mb") == before


def test_fail_rule_stops_the_stream(spark, tmp_path):
    source = str(tmp_path / "in")
    write_usage(spark, source, [(None, "2024-01-01", "10", "1")])
    with pytest.raises(Exception, match="valid_customer_id failed"):
        refresh(spark, tmp_path, source)


def test_stream_cleaning_equals_batch_and_counts_violations(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [("A", "2024-01-01", "Loyalty"), ("B", "oops", None), (None, "2024-01-02", "Tech")]
    raw = spark.createDataFrame(rows, f"{ENTITY} string, event_date string, call_type string")
    raw.write.parquet(source)
    stream = readers.stream_raw(spark, source, "parquet", raw.schema)
    refined = ingest.refine(stream, clean_calls, quality.CALL_RULES, "calls")
    query = ingest.land(refined, str(tmp_path / "out"), str(tmp_path / "check"), meta=False)
    ingest.run(query)
    out = ingest.read_back(spark, str(tmp_path / "out"), refined.schema)
    batch = clean_calls(raw)
    assert out.exceptAll(batch).count() == 0 and batch.exceptAll(out).count() == 0
    seen = [p["observedMetrics"]["calls"] for p in map(dict_of, query.recentProgress) if p["observedMetrics"]]
    assert sum(s["valid_customer_id"] for s in seen) == 1
    assert sum(s["valid_event_date"] for s in seen) == 1


def dict_of(progress):
    import json
    return progress if isinstance(progress, dict) else json.loads(progress.json)


def test_closed_windows_equal_batch(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(t0 + dt.timedelta(seconds=37 * i), "/p", "error" if i % 7 == 0 else "success") for i in range(200)]
    source = str(tmp_path / "in")
    spark.createDataFrame(rows, "ts timestamp, endpoint string, status string").write.parquet(source)
    stream = readers.stream_raw(spark, source, "parquet", "ts timestamp, endpoint string, status string")
    counted = requests.windowed_requests(stream)
    ingest.run(ingest.land(counted, str(tmp_path / "out"), str(tmp_path / "check"), meta=False))
    got = spark.read.parquet(str(tmp_path / "out"))
    from tidemark.operators.requests import error_ratio
    closed = rows[-1][0] - dt.timedelta(minutes=10)
    batch = error_ratio(spark.read.parquet(source), by=["endpoint"]).where(F.col("window_end") <= F.lit(closed))
    columns = ["window_start", "window_end", "endpoint", "requests", "errors", "error_ratio"]
    assert values(got, *columns) == values(batch, *columns)


def test_a_table_of_several_files_is_streamed_whole(spark, folder, tmp_path):
    from tidemark.workload import QUERIES
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    orders.repartition(3).write.parquet(f"{tmp_path}/orders.parquet")
    got = QUERIES["str_bronze_ingest"](spark, str(tmp_path))
    assert got.exceptAll(orders.select(*got.columns)).count() == 0 and got.count() == orders.count()
