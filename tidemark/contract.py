"""The one place that holds names, horizons, thresholds and the feature contract."""

from __future__ import annotations

from dataclasses import dataclass

ENTITY = "unique_customer_identifier"
OBSERVED = "observation_date"

# --- fixed values: horizons, lookbacks, split dates -------------------------
HORIZONS = (30, 60, 90)
CALL_WINDOWS = (30, 90, 180)
CALL_TYPE_WINDOW = 90
TRAIN_END = "2024-04-01"
VALIDATION_END = "2024-07-01"

# --- fixed values: cleaning -------------------------------------------------
NO_CONTRACT_END = -9999.0
UNKNOWN = "Unknown"
TENURE_EDGES = (90, 365, 730, 1095)
TENURE_LABELS = ("0-90d", "90d-1y", "1y-2y", "2y-3y", "3y+")
CALL_FLAGS = {
    "is_loyalty_call": "Loyalty",
    "is_complaint_call": "Complaints",
    "is_tech_call": "Tech",
}
TECHNOLOGIES = ("FTTP", "FTTC", "MPF", "WLR", "Unknown")
NEVER_HAPPENED_DAYS = 9999

# --- fixed values: model features -------------------------------------------
NUMERIC_FEATURES = (
    "contract_status_ord", "contract_dd_cancels", "dd_cancel_60_day", "ooc_days",
    "speed", "line_speed", "speed_gap_pct",
    "tenure_days",
    "calls_30d", "calls_90d", "calls_180d",
    "loyalty_calls_90d", "complaint_calls_90d", "tech_calls_90d",
    "avg_talk_time", "avg_hold_time", "max_hold_time", "days_since_last_call",
    "monthly_download_mb", "monthly_upload_mb", "monthly_total_mb",
    "avg_daily_download_mb", "std_daily_total_mb", "active_days_in_month",
    "peak_daily_total_mb", "usage_mom_change", "usage_vs_3mo_avg",
    "prior_cease_count", "days_since_last_cease",
)
CATEGORICAL_FEATURES = ("technology", "sales_channel", "tenure_bucket")
MODEL_FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES

SNAPSHOT_FEATURES = (
    "contract_status_ord", "contract_dd_cancels", "dd_cancel_60_day", "ooc_days",
    "technology", "speed", "line_speed", "speed_gap_pct",
    "sales_channel", "crm_package_name", "tenure_days", "tenure_bucket",
)
USAGE_FEATURES = (
    "monthly_download_mb", "monthly_upload_mb", "monthly_total_mb",
    "avg_daily_download_mb", "std_daily_total_mb", "active_days_in_month",
    "peak_daily_total_mb",
)
TREND_FEATURES = ("usage_mom_change", "usage_vs_3mo_avg")


def label_name(horizon: int) -> str:
    return f"churned_in_{horizon}d"


def probability_name(horizon: int) -> str:
    return f"churn_prob_{horizon}d"


def decile_name(horizon: int) -> str:
    return f"risk_decile_{horizon}d"


# --- fixed values: risk tiers -----------------------------------------------
TIER_ORDER = ("RED", "AMBER", "YELLOW", "GREEN")
TIER_HORIZON = {"RED": 30, "AMBER": 60, "YELLOW": 90}
ACTION_LISTS = {"loyalty": "RED", "marketing": "AMBER", "customer_success": "YELLOW"}
TIER_ACTIONS = {
    "RED": ("Emergency outbound call — best-offer retention deal",
            "Call center (Loyalty)", "Within 24 hours"),
    "AMBER": ("Targeted digital campaign — proactive contract renewal",
              "CRM / Marketing", "Within 7 days"),
    "YELLOW": ("Customer success check-in — experience improvement",
               "Customer Success", "Within 30 days"),
    "GREEN": ("No action — continue monitoring", "Automated", "N/A"),
}


@dataclass(frozen=True)
class TierThresholds:
    """A probability strictly above the threshold of its horizon opens the tier."""

    red: float = 0.5
    amber: float = 0.5
    yellow: float = 0.5

    @classmethod
    def from_conf(cls, spark, prefix: str = "tidemark.tier.") -> "TierThresholds":
        """Thresholds from the Spark session settings, with the defaults beneath."""
        read = {k: spark.conf.get(prefix + k, None) for k in ("red", "amber", "yellow")}
        return cls(**{k: float(v) for k, v in read.items() if v is not None})


# --- fixed values: accepted range and default of each scoring-record field ---
# name: (default, lowest, highest); None = no bound
RECORD_RANGES: dict[str, tuple[float, float | None, float | None]] = {
    "contract_status_ord": (0.0, 0, 6),
    "contract_dd_cancels": (0.0, 0, None),
    "dd_cancel_60_day": (0.0, 0, None),
    "ooc_days": (-9999.0, None, None),
    "speed": (0.0, 0, 10000),
    "line_speed": (0.0, 0, 10000),
    "speed_gap_pct": (0.0, -100, 100),
    "tenure_days": (0.0, 0, 36500),
    "calls_30d": (0.0, 0, None),
    "calls_90d": (0.0, 0, None),
    "calls_180d": (0.0, 0, None),
    "loyalty_calls_90d": (0.0, 0, None),
    "complaint_calls_90d": (0.0, 0, None),
    "tech_calls_90d": (0.0, 0, None),
    "avg_talk_time": (0.0, 0, None),
    "avg_hold_time": (0.0, 0, None),
    "max_hold_time": (0.0, 0, None),
    "days_since_last_call": (0.0, 0, None),
    "monthly_download_mb": (0.0, 0, None),
    "monthly_upload_mb": (0.0, 0, None),
    "monthly_total_mb": (0.0, 0, None),
    "avg_daily_download_mb": (0.0, 0, None),
    "std_daily_total_mb": (0.0, 0, None),
    "active_days_in_month": (0.0, 0, 31),
    "peak_daily_total_mb": (0.0, 0, None),
    "usage_mom_change": (0.0, -10, 10),
    "usage_vs_3mo_avg": (0.0, -10, 10),
    "prior_cease_count": (0.0, 0, None),
    "days_since_last_cease": (0.0, 0, None),
}
RECORD_TEXT_DEFAULTS = {"technology": "Unknown", "sales_channel": "Unknown",
                        "tenure_bucket": "0-90d"}
RECORD_ENUMS = {"technology": TECHNOLOGIES, "tenure_bucket": TENURE_LABELS}
RECORD_ID_MAX_LENGTH = 50

# --- fixed values: monitoring -----------------------------------------------
MAX_MEAN_PROBABILITY = 0.5
MIN_PROBABILITY_STD = 0.05
MAX_RED_SHARE = 0.30
MAX_GREEN_SHARE = 0.95
MAX_MEAN_SHIFT = 0.20
MAX_PSI = 0.2
MAX_NULL_RATE_RISE = 0.05
MAX_AUC_PR_DROP = 0.10
MIN_AUC_PR = 0.20
LATENCY_BUCKETS = (0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 5.0)
MAX_ERROR_RATIO = 0.05
MAX_P99_SECONDS = 2.0
