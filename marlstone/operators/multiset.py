"""Exact order statistics from value-count multisets.

A multiset is a frame of (keys, value, count) rows. Everything is derived from cumulative
counts, so copies of one value never travel as rows: the shuffle carries distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.functions.scalars import middle


def counted(df: DataFrame, keys: Sequence[str], value: str, **counts: Column) -> DataFrame:
    """The multiset of ``value`` per ``keys``; each of ``counts`` is summed (default: one a row)."""
    counts = counts or {"n": F.lit(1)}
    return df.groupBy(*keys, value).agg(*(F.sum(c).cast("bigint").alias(name) for name, c in counts.items()))


def figures(multiset: DataFrame, keys: Sequence[str], value: str, count: str, prefix: str = "") -> DataFrame:
    """One row per key: n, distinct, min, max and exact median of ``value`` under ``count``.

    Rows whose count is zero or negative don't exist for the result. Null values count in
    ``n`` alone. Keys without any positive count are absent. The median of an even number of
    values is the mean of the middle two: an exact decimal(38,19) of decimals, else a double.
    Extremes keep the decimals' type and are doubles otherwise.
    """
    exact = multiset.schema[value].dataType.typeName() == "decimal"
    shown = (lambda c: c) if exact else (lambda c: c.cast("double"))
    w = Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last())
    whole = Window.partitionBy(*keys)
    known = F.when(F.col(value).isNotNull(), F.col(count)).otherwise(0)
    live = multiset.filter(F.col(count) > 0).withColumns({
        "__upto": F.sum(known).over(w.rowsBetween(Window.unboundedPreceding, 0)),
        "__of": F.sum(known).over(whole),
    })
    low, high = F.floor((F.col("__of") + 1) / 2), F.floor(F.col("__of") / 2) + 1
    inside = lambda k: (F.col("__upto") >= k) & (F.col("__upto") - known < k) & F.col(value).isNotNull()
    at = lambda k: F.max(F.when(inside(k), shown(F.col(value))))
    median = middle(at(low), at(high)) if exact else (at(low) + at(high)) / 2
    return live.groupBy(*keys).agg(
        F.sum(count).cast("bigint").alias(f"{prefix}n"),
        F.count(value).cast("bigint").alias(f"{prefix}distinct"),
        shown(F.min(value)).alias(f"{prefix}min"),
        shown(F.max(value)).alias(f"{prefix}max"),
        median.alias(f"{prefix}median"),
    )


def quantiles(df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """(keys..., n, q0, q1, ...): exact quantiles of the known values, linear between neighbours, as doubles.

    Counts of coarse classes of size (64 to a doubling) say in which class a rank falls, and only
    the values of these classes are sorted; no key's values meet in one task.
    """
    v = F.col("__v")
    size = F.floor(F.log2(F.abs(v)) * 64)
    coarse = F.when(v == 0, F.lit(0)).when(v > 0, 100_000 + size).otherwise(-100_000 - size).cast("bigint")
    rows = df.select(*keys, F.col(value).cast("double").alias("__v")).filter("__v is not null").withColumn("__c", coarse).groupBy(*keys, "__c", "__v").agg(F.count(F.lit(1)).alias("__n"))
    classes = rows.groupBy(*keys, "__c").agg(F.sum("__n").alias("__n"))
    order, whole = Window.partitionBy(*keys).orderBy("__c"), Window.partitionBy(*keys)
    placed = classes.withColumns({"__upto": F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, 0)), "__of": F.sum("__n").over(whole)}).withColumn("__before", F.col("__upto") - F.col("__n"))
    ranks = [(i, side, f(F.lit(q) * (F.col("__of") - 1)).cast("bigint")) for i, q in enumerate(shares) for side, f in (("lo", F.floor), ("hi", F.ceil))]
    asked = placed.select(*keys, "__c", "__before", "__upto", "__of", F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), r.alias("rank")) for i, side, r in ranks))).alias("r"))
    asked = asked.filter((F.col("r.rank") >= F.col("__before")) & (F.col("r.rank") < F.col("__upto")))
    named = asked.select(*(F.col(k).alias(f"__k_{k}") for k in keys), F.col("__c").alias("__b"), "__before", "__of", "r")
    same = F.col("__c") == F.col("__b")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    inside = Window.partitionBy(*keys, "__c").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    met = rows.withColumn("__sum", F.sum("__n").over(inside)).join(named, same)
    local = F.col("r.rank") - F.col("__before")
    hit = met.filter((local < F.col("__sum")) & (local >= F.col("__sum") - F.col("__n")))
    pick = lambda i, side: F.max(F.when((F.col("r.i") == i) & (F.col("r.side") == side), F.col("__v")))
    ends = hit.groupBy(*keys).agg(F.max("__of").alias("n"), *(pick(i, s).alias(f"__{s}{i}") for i in range(len(shares)) for s in ("lo", "hi")))
    between = lambda i, q: F.col(f"__lo{i}") + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * (F.lit(q) * (F.col("n") - 1) - F.floor(F.lit(q) * (F.col("n") - 1)))
    return ends.select(*keys, "n", *(between(i, q).alias(f"q{i}") for i, q in enumerate(shares)))
