"""Order, gaps, continuity and latest states in sequences of rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How many numbers of an order one block spans.
BLOCK = 100_000


def gaps(df: DataFrame, keys: Sequence[str], time_us: str, step_us: int) -> DataFrame:
    """(keys..., gap_start_us, gap_end_us, missing): holes between consecutive times, ends excluded.

    Repeated times are one; null times are ignored. Leading and trailing holes have no end and
    aren't seen here (see the regular grid).
    """
    rows = df.filter(F.col(time_us).isNotNull()).select(*keys, F.col(time_us).alias("__t")).distinct()
    before = F.lag("__t").over(Window.partitionBy(*keys).orderBy("__t"))
    return rows.withColumn("__b", before).filter(F.col("__t") > F.col("__b") + step_us).select(
        *keys, (F.col("__b") + step_us).alias("gap_start_us"), F.col("__t").alias("gap_end_us"), F.expr(f"(__t - __b) div {step_us} - 1").alias("missing")
    )


def intervals(df: DataFrame, keys: Sequence[str], time_us: str) -> DataFrame:
    """``df`` with interval_minutes to the row before (half-even rounding; null on the first)."""
    before = F.lag(time_us).over(Window.partitionBy(*keys).orderBy(time_us))
    return df.withColumn("interval_minutes", F.bround((F.col(time_us) - before) / 60_000_000.0, 0).cast("bigint"))


def with_previous(df: DataFrame, keys: Sequence[str], order: str, values: Mapping[str, Column], name: str = "__previous", block: int = BLOCK) -> DataFrame:
    """``df`` with a struct ``name`` of ``values`` of the row before in the whole-number ``order``, null on a key's first row.

    Keys are cut into blocks of ``block`` numbers, so that one key, however large, spreads over
    many tasks; only the last row of each block travels to the next block that has any. Null keys
    are a key; rows without order come first and stand in a block of their own.
    """
    own = F.struct(F.col(order).alias("__order"), *(v.alias(n) for n, v in values.items()))
    at = F.coalesce(F.floor(F.col(order) / block).cast("bigint"), F.lit(-(2**62)))
    rows = df.withColumns({"__own": own, "__block": at})
    ends = rows.groupBy(*keys, "__block").agg(F.max_by("__own", F.coalesce(order, F.lit(-(2**62)))).alias("__end"))
    carried = ends.withColumn("__carry", F.lag("__end").over(Window.partitionBy(*keys).orderBy("__block"))).drop("__end")
    carried = carried.select("__carry", F.col("__block").alias("__b"), *(F.col(k).alias(f"__k_{k}") for k in keys))
    same = F.col("__block") == F.col("__b")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    inside = F.lag("__own").over(Window.partitionBy(*keys, "__block").orderBy(order))
    met = rows.withColumn("__inside", inside).join(carried, same)
    return met.withColumn(name, F.coalesce("__inside", "__carry")).select(*df.columns, name)


def out_of_order(df: DataFrame, keys: Sequence[str], order: str, value: Column, block: int = BLOCK) -> DataFrame:
    """Rows whose ``value`` isn't above that of the row before in the whole-number ``order`` (nulls included)."""
    seen = with_previous(df.withColumn("__v", value), keys, order, {"v": F.col("__v")}, block=block)
    return seen.filter("__previous is not null and not coalesce(__v > __previous.v, false)").drop("__v", "__previous")


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., copies) of natural keys that occur more than once; nulls are values."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def continuity(df: DataFrame, bounds: DataFrame, keys: Sequence[str], number: str, after: str, before: str) -> DataFrame:
    """Per row of ``bounds`` whether every whole number strictly between its two bounds occurs: (keys..., found, needed, proven).

    ``bounds`` has one row per key. Repeated numbers count once; keys without a number inside
    their bounds are proven only if none is needed, and never if a bound is unknown. Numbers
    are made distinct before they are counted, so one key's numbers need not fit in one task.
    """
    ends = bounds.select(*keys, F.col(after).alias("__a"), F.col(before).alias("__b"))
    numbers = df.select(*keys, F.col(number).alias("__n")).filter("__n is not null").distinct()
    inside = numbers.join(ends, list(keys)).filter("__n > __a and __n < __b").groupBy(*keys).agg(F.count(F.lit(1)).alias("found"))
    needed = F.when(F.col("__a").isNotNull() & F.col("__b").isNotNull(), F.greatest(F.col("__b") - F.col("__a") - 1, F.lit(0)))
    out = ends.join(inside, list(keys), "left").select(*keys, F.coalesce("found", F.lit(0)).cast("bigint").alias("found"), needed.alias("needed"))
    return out.withColumn("proven", F.coalesce(F.col("found") == F.col("needed"), F.lit(False)))


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the highest ``order`` of each key: one aggregate that combines on the map side.

    Ties in the order fall to the larger row, column by column, so the result is the same however
    the rows lie. Null orders come first.
    """
    rest = [c for c in df.columns if c not in keys and c not in order and df.schema[c].dataType.typeName() not in ("map", "variant")]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__r"))
    return best.select(*keys, *(F.col(f"__r.{c}").alias(c) for c in [*order, *rest]))


def validity(df: DataFrame, keys: Sequence[str], since: str) -> DataFrame:
    """``df`` with valid_to: the next ``since`` of the key, null for the current row."""
    return df.withColumn("valid_to", F.lead(since).over(Window.partitionBy(*keys).orderBy(since)))
