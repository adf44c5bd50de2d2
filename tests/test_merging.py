"""Merged stream tables: late rows, repeated batches, broken compactions, few folders, windows and silences."""

import datetime as dt
import math
import random
from pathlib import Path

from conftest import values
from pyspark.sql import functions as F

from tidemark.operators import requests as batch_requests
from tidemark.operators.rollup import merged_months, monthly_partials, monthly_rollup, months_of
from tidemark.sources import readers
from tidemark.streaming import ingest, requests
from tidemark.streaming.merging import MergedTable

T0 = dt.datetime(2024, 1, 1)
LOG = "ts timestamp, endpoint string, status string"


def counting(spark, path, keep=3):
    def merge(df):
        return df.groupBy("k").agg(F.sum("n").alias("n"))

    return MergedTable(spark, str(path), spark.createDataFrame([], "k string, n long").schema, merge, keep=keep)


def rows(spark, batch):
    return spark.createDataFrame([("all", 1), (f"k{batch % 2}", 10 + batch)], "k string, n long")


def held(table):
    return {r["k"]: r["n"] for r in table.read().collect()}


def test_folders_stay_few_and_batches_count_once(spark, tmp_path):
    table = counting(spark, tmp_path / "t")
    assert held(table) == {}
    for batch in range(14):
        table.store(rows(spark, batch), batch)
        if batch in (2, 5, 13):
            table.store(rows(spark, batch), batch)          # as after a lost commit
        assert len(table.parts()) <= 2 + 2 + 2
        assert held(table)["all"] == batch + 1
    assert held(table) == {"all": 14, "k0": sum(10 + b for b in range(0, 14, 2)), "k1": sum(10 + b for b in range(1, 14, 2))}
    assert len(list(Path(tmp_path / "t").glob("part-*"))) == len(table.parts())
    table.store(rows(spark, 0), 0)                          # long merged
    assert held(table)["all"] == 14


def test_a_compaction_that_broke_off(spark, tmp_path):
    table = counting(spark, tmp_path / "t", keep=100)
    for batch in range(4):
        table.store(rows(spark, batch), batch)
    before = held(table)
    merged = (1, 0, 2)
    table._write(table.merge(table._read([(0, b, b) for b in range(3)])), merged)       # not yet deleted: 0 to 2
    assert merged in table.parts() and held(table) == before
    (tmp_path / "t" / "part-1-0-2" / "_SUCCESS").unlink()                               # not yet whole
    assert merged not in table.parts() and held(table) == before
    table.compact()
    assert held(table) == before


def test_partial_months_add_up(spark):
    rng = random.Random(4)
    days = [(rng.choice("AB"), dt.date(2024, m, 1), None if rng.random() < .1 else 1e6 + rng.random(), rng.random())
            for m in (1, 2) for _ in range(60)] + [("C", None, None, 1.0), ("D", dt.date(2024, 1, 1), 3.0, 4.0)]
    daily = spark.createDataFrame(days, "unique_customer_identifier string, month_key date, usage_download_mbs double, "
                                  "usage_upload_mbs double").withColumn(
        "usage_total_mbs", F.col("usage_download_mbs") + F.col("usage_upload_mbs"))
    parts = [monthly_partials(daily.where(F.pmod(F.xxhash64("usage_upload_mbs"), F.lit(5)) == i)) for i in range(5)]
    two = merged_months(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    whole = months_of(merged_months(two.unionByName(parts[3]).unionByName(parts[4])))
    want = monthly_rollup(daily)
    assert whole.columns == want.columns
    a, b = (values(df, *want.columns) for df in (whole, want))
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        for p, q in zip(x, y, strict=True):
            assert p == q or math.isclose(p, q, rel_tol=1e-8)


def log_rows(n, seed=3):
    rng = random.Random(seed)
    return [(T0 + dt.timedelta(seconds=rng.randrange(40_000)), rng.choice(("/a", "/b")),
             rng.choice(("error", "success"))) for _ in range(n)]


def feed(spark, tmp_path, batches, table_of, reduce):
    source = str(tmp_path / "in")
    for batch in batches:
        spark.createDataFrame(batch, LOG).coalesce(1).write.mode("append").parquet(source)
    stream = readers.stream_raw(spark, source, "parquet", LOG, max_files=1)
    table = table_of(stream)
    ingest.run(table.follow(stream, reduce, str(tmp_path / "check")))
    return table, spark.createDataFrame([r for b in batches for r in b], LOG)


def test_windows_of_late_rows_equal_batch_to_the_last_row(spark, tmp_path):
    batches = [log_rows(80, s) for s in range(5)] + [[(T0 - dt.timedelta(days=9), "/a", "error"), (None, "/a", "error")]]
    table, log = feed(spark, tmp_path, batches, lambda s: requests.minute_table(s, str(tmp_path / "t"), ["endpoint"], keep=2),
                      lambda df: requests.minute_counts(df, ["endpoint"]))
    columns = ["window_start", "window_end", "endpoint", "requests", "errors", "error_ratio"]
    want = batch_requests.error_ratio(log.where("ts IS NOT NULL"), by=["endpoint"])
    assert values(requests.windows_of(table.read()), *columns) == values(want, *columns)
    assert len(table.parts()) <= 3
    hours = requests.counts_of(table.read(), "endpoint")
    want = batch_requests.counts_per(log, "endpoint")
    assert values(hours, "window_start", "endpoint", "count") == values(want, "window_start", "endpoint", "count")


def test_silences_over_batches_and_keys_that_never_spoke(spark, tmp_path):
    batches = [log_rows(25, s) for s in range(4)]
    batches.append([(T0 + dt.timedelta(seconds=41_000), "/b", "success"), (T0 + dt.timedelta(seconds=42_800), "/b", "success")])
    by = ["endpoint"]
    table, log = feed(spark, tmp_path, batches, lambda s: requests.session_table(s, str(tmp_path / "t"), by, keep=2),
                      lambda df: requests.sessions(df, by))
    until = F.lit(T0 + dt.timedelta(days=1))
    known = spark.createDataFrame([("/a",), ("/mute",), ("/mute",), (None,)], "endpoint string")
    got = values(requests.silences_of(table.read(), by, until, known), "endpoint", "silent_from", "silent_until", "seconds")
    want = values(batch_requests.silences(log, 30, by, until), "endpoint", "silent_from", "silent_until", "seconds")
    end = T0 + dt.timedelta(days=1)
    never = [(None, None, end, None), ("/mute", None, end, None)]
    assert got == sorted(want + never, key=lambda t: tuple((x is not None, x) for x in t))
    assert len([g for g in got if g[0] == "/b" and g[3] == 1800.0]) == 0       # exactly half an hour is none
