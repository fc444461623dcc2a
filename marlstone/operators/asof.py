"""Point-in-time joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def backward(left: DataFrame, right: DataFrame, keys: Sequence[str], left_us: str, right_us: str, values: Sequence[str], tolerance_us: int, prefix: str = "asof_", block_us: int = 86_400_000_000) -> DataFrame:
    """Each left row with the right values last known at its time.

    Adds <prefix><value> columns, <prefix>age_us and match_quality: ``exact_available`` (age 0),
    ``asof_fresh`` (within the tolerance), ``stale`` (older: values are null) or ``missing``. Of
    several right rows at one time the largest values count. Right rows without time are never
    known; left rows without time or key match nothing. Sides meet in blocks of time, so that a
    hot key spreads; a block starts from the last right row before it, found per block.
    """
    block = lambda c: F.floor(c / F.lit(block_us)).cast("bigint")
    point = F.struct(F.col(right_us).alias("t"), *values)
    known = right.filter(F.col(right_us).isNotNull())
    for k in keys:
        known = known.filter(F.col(k).isNotNull())
    known = known.groupBy(*keys, right_us).agg(F.max(F.struct(*values)).alias("__v")).select(*keys, right_us, *(F.col(f"__v.{v}").alias(v) for v in values))
    known = known.select(*keys, F.col(right_us).alias("__t"), block(F.col(right_us)).alias("__block"), point.alias("__p"))
    wanted_blocks = left.select(*keys, block(F.col(left_us)).alias("__block")).distinct()
    ends = known.groupBy(*keys, "__block").agg(F.max("__p").alias("__end"))
    w = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        ends.unionByName(wanted_blocks.withColumn("__end", F.lit(None).cast(ends.schema["__end"].dataType)))
        .groupBy(*keys, "__block").agg(F.max("__end").alias("__end"))
        .withColumn("__carry", F.last("__end", ignorenulls=True).over(w))
        .select(*keys, "__block", F.col("__carry").alias("__p"), F.lit(None).cast("bigint").alias("__t"))
    )
    rows = left.withColumns({"__t": F.col(left_us), "__block": block(F.col(left_us)), "__side": F.lit(1)})
    readings = known.unionByName(carried).withColumn("__side", F.lit(0))
    merged = rows.unionByName(readings, allowMissingColumns=True)
    order = Window.partitionBy(*keys, "__block").orderBy(F.col("__t").asc_nulls_first(), "__side").rowsBetween(Window.unboundedPreceding, 0)
    seen = merged.withColumn("__p", F.last(F.when(F.col("__side") == 0, F.col("__p")), ignorenulls=True).over(order)).filter("__side = 1")
    age = F.when(F.col(left_us).isNotNull(), F.col(left_us) - F.col("__p.t"))
    quality = F.when(age == 0, "exact_available").when(age <= tolerance_us, "asof_fresh").when(age.isNotNull(), "stale").otherwise("missing")
    fresh = age <= tolerance_us
    return seen.select(*left.columns, *(F.when(fresh, F.col(f"__p.{v}")).alias(f"{prefix}{v}") for v in values), F.when(fresh, age).alias(f"{prefix}age_us"), quality.alias("match_quality"))


def valid_at(left: DataFrame, states: DataFrame, keys: Sequence[str], left_us: str, since_us: str, values: Sequence[str]) -> DataFrame:
    """Each left row with the state whose half-open interval [since, next since) holds its time."""
    forever = 2**62
    return backward(left, states, keys, left_us, since_us, values, forever, "state_").drop("state_age_us", "match_quality")
