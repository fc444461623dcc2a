"""Record rules, quarantine, and quality measures per dataset identity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(rules: Mapping[str, Column]) -> Column:
    """The names of the rules a row breaks, sorted as given; an unknown (null) outcome breaks a rule."""
    return F.array_compact(F.array(*(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items())))


def split(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, quarantined rows with ``violations``)."""
    judged = df.withColumn("violations", violations(rules))
    return judged.filter(F.size("violations") == 0).drop("violations"), judged.filter(F.size("violations") > 0)


def require(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``df`` unchanged, except that running it fails on the first row that breaks a rule."""
    broken = violations(rules)
    guard = F.when(F.size(broken) > 0, F.raise_error(F.concat(F.lit("rules broken: "), F.concat_ws(",", broken))))
    return df.withColumn("__guard", guard).filter(F.col("__guard").isNull()).drop("__guard")


def measures(df: DataFrame, identity: Sequence[str], key: Sequence[str], side: str | None = None) -> DataFrame:
    """Per identity (nulls are UNKNOWN): rows, duplicate rows of the key, rows of unknown side, and rates.

    Duplicates are counted over distinct keys, nulls being values. The inner step reduces each key
    to one row, so a key that repeats a billion times costs one row per task.
    """
    named = [F.coalesce(F.col(c).cast("string"), F.lit("UNKNOWN")).alias(c) for c in identity]
    unknown = F.lit(0) if side is None else F.when(F.coalesce(F.upper(side).isin("BUY", "SELL"), F.lit(False)), 0).otherwise(1)
    one = df.select(*named, F.struct(*key).alias("__key"), unknown.alias("__u")).groupBy(*identity, "__key").agg(F.count(F.lit(1)).alias("n"), F.sum("__u").alias("u"))
    out = one.groupBy(*identity).agg(F.sum("n").alias("rows"), (F.sum("n") - F.count(F.lit(1))).alias("duplicates"), F.sum("u").alias("unknown_sides"))
    rate = lambda c: F.round(F.col(c) / F.col("rows"), 9)
    return out.withColumns({"duplicate_rate": rate("duplicates"), "unknown_side_rate": rate("unknown_sides")})


def freshness(df: DataFrame, keys: Sequence[str], time_us: str, observed_us: int, threshold_s: int | None, event_driven: bool = False) -> DataFrame:
    """(keys..., last_us, age_seconds, status) against a fixed observation time.

    ACTIVE within the threshold, STALE_BY_POLICY beyond it, UNKNOWN without threshold or without any
    time (LOW_ACTIVITY_QUIET for event-driven feeds), CLOCK_ERROR if the last time lies ahead.
    """
    last = df.groupBy(*keys).agg(F.max(time_us).alias("last_us"))
    age = (F.lit(observed_us) - F.col("last_us")) / 1e6
    quiet = F.lit("LOW_ACTIVITY_QUIET" if event_driven else "UNKNOWN")
    judged = F.lit("UNKNOWN") if threshold_s is None else F.when(age <= threshold_s, "ACTIVE").otherwise("STALE_BY_POLICY")
    return last.withColumns({"age_seconds": F.round(age, 6), "status": F.when(F.col("last_us").isNull(), quiet).when(age < 0, "CLOCK_ERROR").otherwise(judged)})


def evaluate(metrics: DataFrame, policies: DataFrame) -> DataFrame:
    """Metrics (metric, value, applicable) judged by policies (metric, comparison, threshold): PASS, FAIL, UNKNOWN or NOT_APPLICABLE.

    Without policy, threshold or value the outcome is UNKNOWN; CATEGORICAL policies pass any value.
    """
    joined = metrics.join(policies.select("metric", "comparison", "threshold"), "metric", "left")
    outcome = (
        F.when(~F.col("applicable"), "NOT_APPLICABLE")
        .when(F.col("comparison").isNull() | F.col("value").isNull(), "UNKNOWN")
        .when(F.col("comparison") == "CATEGORICAL", "PASS")
        .when(F.col("threshold").isNull(), "UNKNOWN")
        .when(((F.col("comparison") == "MAX") & (F.col("value") <= F.col("threshold"))) | ((F.col("comparison") == "MIN") & (F.col("value") >= F.col("threshold"))), "PASS")
        .otherwise("FAIL")
    )
    return joined.withColumn("evaluation", outcome)


def exposure(gaps: DataFrame, keys: Sequence[str], column: str, values: Sequence[str]) -> DataFrame:
    """Counts per value of an enumeration, one column each, zeros included."""
    return gaps.groupBy(*keys).agg(*(F.count_if(F.col(column) == v).alias(v.lower()) for v in values), F.count(F.lit(1)).alias("total"))
