"""Raw to cleaned tables. The same functions serve batches and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.contract import CALL_FLAGS
from tidemark.functions.columns import (category_flags, flag, month_key, or_sentinel, or_unknown,
                                        pct_gap, prefix_ordinal, tenure_bucket, to_date, to_double)

_META = ("_ingested_at", "_source_file")


def clean_customer_info(raw: DataFrame) -> DataFrame:
    return raw.drop(*_META).withColumns({
        "datevalue": to_date("datevalue"),
        "ooc_days": or_sentinel("ooc_days"),
        "contract_status_ord": prefix_ordinal("contract_status"),
        "speed_gap_pct": pct_gap("speed", "line_speed"),
        "tenure_bucket": tenure_bucket("tenure_days"),
    })


def clean_usage(raw: DataFrame) -> DataFrame:
    typed = raw.drop(*_META).withColumns({
        "usage_download_mbs": to_double("usage_download_mbs"),
        "usage_upload_mbs": to_double("usage_upload_mbs"),
        "calendar_date": to_date("calendar_date"),
    })
    return typed.withColumns({
        "usage_total_mbs": F.col("usage_download_mbs") + F.col("usage_upload_mbs"),
        "month_key": month_key("calendar_date"),
    })


def clean_calls(raw: DataFrame) -> DataFrame:
    return raw.drop(*_META).withColumns({
        "event_date": to_date("event_date"),
        "call_type": or_unknown("call_type"),
        **category_flags("call_type", CALL_FLAGS),
    })


def clean_cease(raw: DataFrame) -> DataFrame:
    placed = to_date("cease_placed_date")
    completed = to_date("cease_completed_date")
    return raw.drop(*_META).withColumns({
        "cease_placed_date": placed,
        "cease_completed_date": completed,
        "is_completed": flag(completed.isNotNull()),
        "cease_month": month_key(placed),
    })
