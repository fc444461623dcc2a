"""Per-period figures by event time that late records correct, up to a cut-off.

The state of a period is a multiset: how often each value occurred, counted apart for records
that were on time, late within the cut-off, and beyond it. A late record only changes counts;
medians, distinct counts and extremes are then derived anew from cumulative counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.operators import multiset

COUNTS = ("on_time", "late", "dropped")


def adjust(records: DataFrame, keys: Sequence[str], event_us: Column, arrival_us: Column, value: Column, period_us: int, cutoff_us: int) -> DataFrame:
    """The multiset state (keys..., period_us, value, on_time, late, dropped) that ``records`` make.

    Records without event or arrival time have no place and are ignored. A record is late if
    it arrived after its period's end, and dropped if that was more than ``cutoff_us`` ago. A
    null value is kept as a value of its own (it counts, but has no part in order statistics).
    """
    rows = records.select(*keys, event_us.alias("__event"), arrival_us.alias("__arrival"), value.alias("value")).filter("__event is not null and __arrival is not null")
    rows = rows.withColumn("period_us", F.col("__event") - F.pmod("__event", F.lit(period_us)))
    delay = F.col("__arrival") - (F.col("period_us") + period_us)
    return multiset.counted(
        rows, [*keys, "period_us"], "value",
        on_time=(delay <= 0).cast("int"),
        late=((delay > 0) & (delay <= cutoff_us)).cast("int"),
        dropped=(delay > cutoff_us).cast("int"),
    )


def merge(state: DataFrame, change: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The state after a batch: counts add up, whatever the order in which batches come."""
    return state.unionByName(change).groupBy(*keys, "period_us", "value").agg(*(F.sum(c).cast("bigint").alias(c) for c in COUNTS))


def outcomes(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., period_us, outcome) for periods with late records: ``corrected``, ``dropped`` or both."""
    sums = state.groupBy(*keys, "period_us").agg(F.sum("late").alias("late"), F.sum("dropped").alias("dropped"))
    kinds = F.array_compact(F.array(F.when(F.col("late") > 0, F.lit("corrected")), F.when(F.col("dropped") > 0, F.lit("dropped"))))
    return sums.select(*keys, "period_us", F.explode(kinds).alias("outcome"))


def corrected(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per period the figures as first published (first_...) and after correction (final_...)."""
    by = [*keys, "period_us"]
    first = multiset.figures(state, by, "value", "on_time", "first_")
    final = multiset.figures(state.withColumn("__all", F.col("on_time") + F.col("late")), by, "value", "__all", "final_")
    return final.join(first, by, "left")
