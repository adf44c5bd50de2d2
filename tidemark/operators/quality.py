"""Quality rules with a severity, reports, record validation, keys and failed casts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark import contract
from tidemark.functions.columns import to_double

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Rule:
    """A SQL condition that good rows meet, and what happens to the others.

    A condition that is null counts as not met.
    """

    name: str
    condition: str
    severity: str = WARN

    @property
    def met(self) -> Column:
        return F.coalesce(F.expr(self.condition), F.lit(False))


_ENTITY_SET = f"{contract.ENTITY} IS NOT NULL"

# --- fixed values: rules of the cleaned tables ------------------------------
SNAPSHOT_RULES = (
    Rule("valid_customer_id", _ENTITY_SET),
    Rule("valid_datevalue", "datevalue IS NOT NULL"),
    Rule("valid_speed", "speed > 0", DROP),
    Rule("valid_tenure", "tenure_days >= 0"),
)
USAGE_RULES = (
    Rule("valid_customer_id", _ENTITY_SET, FAIL),
    Rule("non_negative_download", "usage_download_mbs >= 0 OR usage_download_mbs IS NULL"),
    Rule("non_negative_upload", "usage_upload_mbs >= 0 OR usage_upload_mbs IS NULL"),
)
CALL_RULES = (
    Rule("valid_customer_id", _ENTITY_SET),
    Rule("valid_event_date", "event_date IS NOT NULL"),
)
CEASE_RULES = (
    Rule("valid_customer_id", _ENTITY_SET, FAIL),
    Rule("valid_placed_date", "cease_placed_date IS NOT NULL", FAIL),
)


@dataclass(frozen=True)
class Check:
    """One line of a batch report: rows that meet ``bad`` are violations."""

    name: str
    bad: str
    verdict: str = WARN        # verdict when there is at least one violation


# --- fixed values: checks of the batch report -------------------------------
SNAPSHOT_CHECKS = (
    Check("null_customer_id", f"{contract.ENTITY} IS NULL", FAIL),
    Check("null_datevalue", "datevalue IS NULL", FAIL),
    Check("negative_speed", "speed <= 0"),
    Check("negative_tenure", "tenure_days < 0"),
)
USAGE_CHECKS = (
    Check("null_download", "usage_download_mbs IS NULL"),
    Check("null_upload", "usage_upload_mbs IS NULL"),
    Check("negative_download", "usage_download_mbs < 0"),
)
CALL_CHECKS = (
    Check("null_call_type", "call_type IS NULL", FAIL),
    Check("null_event_date", "event_date IS NULL", FAIL),
)
CEASE_CHECKS = (
    Check("null_placed_date", "cease_placed_date IS NULL", FAIL),
)


def enforce(df: DataFrame, rules: Sequence[Rule], observation: str | Observation | None = None
            ) -> DataFrame:
    """Drop or fail by severity; violations of every rule are counted on the way.

    Works on batches and streams: the counts ride on the query itself as
    observed metrics, and a failing row raises inside the plan.
    """
    if observation is not None:
        df = df.observe(observation, F.count("*").alias("rows"),
                        *[F.count_if(~r.met).alias(r.name) for r in rules])
    # one expression decides, failures first: a row that would be dropped still fails
    verdict = F.lit(True)
    for rule in reversed([r for r in rules if r.severity == DROP]):
        verdict = F.when(~rule.met, F.lit(False)).otherwise(verdict)
    for rule in reversed([r for r in rules if r.severity == FAIL]):
        failed = F.raise_error(F.lit(f"rule {rule.name} failed")).cast("boolean")
        verdict = F.when(~rule.met, failed).otherwise(verdict)
    return df if not any(r.severity != WARN for r in rules) else df.where(verdict)


def recorded(spark, table: str, batch: str, rules: Sequence[Rule], metrics: Mapping[str, int]) -> DataFrame:
    """What an observation of ``enforce`` has counted, a row per rule:
    (table_name, batch, rule, severity, rows, violations)."""
    return spark.createDataFrame(
        [(table, batch, r.name, r.severity, metrics["rows"], metrics[r.name]) for r in rules],
        "table_name string, batch string, rule string, severity string, rows long, violations long")


def quarantine(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows a DROP rule removes, with the names of the rules they break."""
    broken = _names([(r.name, ~r.met) for r in rules if r.severity == DROP])
    return df.withColumn("broken_rules", broken).where(F.size("broken_rules") > 0)


def _names(cases: Sequence[tuple[str, Column]]) -> Column:
    return F.filter(F.array(*[F.when(bad, F.lit(name)) for name, bad in cases]),
                    lambda x: x.isNotNull())


def violations(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """One row per rule with its violations, from a single pass."""
    checks = [Check(r.name, f"NOT coalesce({r.condition}, false)", r.severity) for r in rules]
    return report(df, checks, table)


def report(df: DataFrame, checks: Sequence[Check], table: str) -> DataFrame:
    """(table, rule, total_rows, violations, status) from one pass over the table."""
    counts = df.agg(F.count("*").alias("_rows"),
                    *[F.count_if(F.expr(c.bad)).alias(f"_c{i}") for i, c in enumerate(checks)])
    lines = F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(c.name).alias("rule"),
                 F.col("_rows").alias("total_rows"), F.col(f"_c{i}").alias("violations"),
                 F.when(F.col(f"_c{i}") == 0, "PASS").otherwise(c.verdict.upper()).alias("status"))
        for i, c in enumerate(checks)])
    return counts.select(F.inline(lines))


def record_problems(df: DataFrame, entity: str = "customer_id") -> DataFrame:
    """Add ``problems``: the fields of each record that break its range, domain or length.

    Missing values take their defaults and are fine; the entity is required.
    """
    cases = [(entity, F.col(entity).isNull() | (F.length(entity) < 1)
              | (F.length(entity) > contract.RECORD_ID_MAX_LENGTH))]
    for name, (_, low, high) in contract.RECORD_RANGES.items():
        if name not in df.columns or (low is None and high is None):
            continue
        bad = F.lit(False)
        if low is not None:
            bad = bad | (F.col(name) < low)
        if high is not None:
            bad = bad | (F.col(name) > high)
        cases.append((name, bad))
    for name, allowed in contract.RECORD_ENUMS.items():
        if name in df.columns:
            cases.append((name, ~F.col(name).isin(*allowed)))
    return df.withColumn("problems", _names(cases))


def valid_records(df: DataFrame, entity: str = "customer_id") -> DataFrame:
    return record_problems(df, entity).where(F.size("problems") == 0).drop("problems")


def rejected_records(df: DataFrame, entity: str = "customer_id") -> DataFrame:
    return record_problems(df, entity).where(F.size("problems") > 0)


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that repeat or hold a null, with their row count."""
    some_null = F.lit(False)
    for k in keys:
        some_null = some_null | F.col(k).isNull()
    return (df.groupBy(*keys).agg(F.count("*").alias("rows"))
            .where((F.col("rows") > 1) | some_null))


def failed_casts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, failed): text that is no number and would silently become null."""
    counts = df.agg(*[F.count_if(F.col(c).isNotNull() & to_double(c).isNull()).alias(c)
                      for c in columns])
    return counts.unpivot([], list(columns), "column", "failed")


def contract_gaps(df: DataFrame,
                  numeric: Sequence[str] = contract.NUMERIC_FEATURES,
                  categorical: Sequence[str] = contract.CATEGORICAL_FEATURES) -> list[str]:
    """Model features a table lacks, or holds with the wrong kind of type."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    gaps = [f"missing: {c}" for c in (*numeric, *categorical) if c not in kinds]
    gaps += [f"not numeric: {c}" for c in numeric if kinds.get(c) == "string"]
    gaps += [f"not text: {c}" for c in categorical if kinds.get(c, "string") != "string"]
    gaps += [f"both kinds: {c}" for c in numeric if c in categorical]
    return gaps


def reconcile(tables: Mapping[str, DataFrame], expected: Mapping[str, int]) -> DataFrame:
    """Row counts against expected ones: PASS if equal, else WARN."""
    lines = [df.agg(F.count("*").alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count",
                     F.lit(expected[name]).cast("bigint").alias("expected"))
             for name, df in tables.items()]
    out = lines[0]
    for line in lines[1:]:
        out = out.unionByName(line)
    return out.withColumn("status", F.when(F.col("row_count") == F.col("expected"), "PASS")
                          .otherwise("WARN"))


def shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows, columns) per table."""
    lines = [df.agg(F.count("*").alias("rows"))
             .select(F.lit(name).alias("table_name"), "rows",
                     F.lit(len(df.columns)).alias("columns"))
             for name, df in tables.items()]
    out = lines[0]
    for line in lines[1:]:
        out = out.unionByName(line)
    return out


def schema_report(df: DataFrame, table: str) -> DataFrame:
    """One row per column of the table."""
    return df.sparkSession.createDataFrame(
        [(table, i, f.name, f.dataType.simpleString(), f.nullable)
         for i, f in enumerate(df.schema.fields)],
        "table_name string, position int, column_name string, data_type string, nullable boolean")
