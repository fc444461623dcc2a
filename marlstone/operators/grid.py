"""Irregular readings onto a regular grid, by an as-of merge that looks both ways.

Per source, grid points and readings merge in time order; each grid point takes the nearest
reading on either side and, within a gap limit, the mean of the two weighted by the distances to
the times at which they were really taken. Sources
are cut into time blocks so that one source, however large, spreads over many tasks; what a
block needs from its neighbours is its last earlier and first later reading, which a small
table of block edges supplies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_STEPS = 1440


def slots(readings: DataFrame, source: str, time_us: Column, step_us: int, values: Sequence[str] = ()) -> DataFrame:
    """(source, slot_us, first, last) of every grid slot with a reading: its earliest and latest reading (at, values...).

    Of several readings at one time the one with the largest values counts. Rows without source
    or time carry no position and are left out.
    """
    rows = readings.select(F.col(source), time_us.alias("__at"), *values).filter(F.col(source).isNotNull() & F.col("__at").isNotNull())
    slot = (F.col("__at") - F.pmod(F.col("__at"), F.lit(step_us))).alias("slot_us")
    found = rows.groupBy(source, slot).agg(F.max(F.struct((-F.col("__at")).alias("at"), *values)).alias("f"), F.max(F.struct(F.col("__at").alias("at"), *values)).alias("last"))
    return found.select(source, "slot_us", F.struct((-F.col("f.at")).alias("at"), *(F.col(f"f.{v}").alias(v) for v in values)).alias("first"), "last")


def regular(
    readings: DataFrame,
    source: str,
    time_us: Column,
    step_us: int,
    values: Sequence[str] = (),
    gap_limit_us: int | None = None,
    block_steps: int = BLOCK_STEPS,
) -> DataFrame:
    """The regular series: (source, slot_us, status, values...) from first to last covered slot.

    A slot's value is that at its start, on the line between the last reading before or at it and
    the first one at or after it, in real times. status is ``observed`` (a reading lies in the
    slot), ``filled`` (none does, and the two neighbours lie at most ``gap_limit_us`` apart) or
    ``missing`` (they lie further apart: values are null). An observed slot whose neighbours
    lie further apart, or with none before it, has its own first reading's values. Without a
    limit every gap is filled; a null value on either side leaves that value null. Of several
    readings at one time the largest values count. Sources without any usable reading yield no
    rows; so does an empty table.
    """
    block_us = step_us * block_steps
    block = lambda c: F.floor(c / F.lit(block_us)).cast("bigint")
    slot_of = lambda c: c - F.pmod(c, F.lit(step_us))
    seen = slots(readings, source, time_us, step_us, values).withColumn("__block", block(F.col("slot_us")))
    edges = seen.groupBy(source, "__block").agg(F.min_by("first", "slot_us").alias("__first"), F.max_by("last", "slot_us").alias("__last"))
    by_block = Window.partitionBy(source).orderBy("__block")
    near = edges.withColumns({
        "__before": F.lag("__last").over(by_block),
        "__next_block": F.lead("__block").over(by_block),
        "__after": F.lead("__first").over(by_block),
    })
    # a block owns its own slots and the reading-free blocks that follow it
    spans = near.withColumn("__b", F.explode(F.when(F.col("__next_block").isNull(), F.array("__block")).otherwise(F.sequence("__block", F.col("__next_block") - 1))))
    own_low = F.when(F.col("__b") != F.col("__block"), F.col("__b") * block_us).when(F.col("__before").isNull(), slot_of(F.col("__first.at"))).otherwise(F.col("__block") * block_us)
    high = F.when(F.col("__next_block").isNull(), slot_of(F.col("__last.at"))).otherwise((F.col("__b") + 1) * block_us - step_us)
    point = edges.schema["__first"].dataType
    none = F.lit(None).cast(point)
    grid = spans.select(
        source,
        F.col("__b").alias("__block"),
        F.explode(F.sequence(own_low, high, F.lit(step_us))).alias("slot_us"),
        F.when(F.col("__b") == F.col("__block"), F.col("__before")).otherwise(F.col("__last")).alias("__before"),
        F.col("__after"),
        F.lit(0).alias("__real"),
        none.alias("first"),
        none.alias("last"),
    )
    merged = seen.select(source, "__block", "slot_us", none.alias("__before"), none.alias("__after"), F.lit(1).alias("__real"), "first", "last").unionByName(grid)
    # the as-of merge: within (source, block) in time order, a slot's readings before its grid point
    order = Window.partitionBy(source, "__block").orderBy("slot_us", F.col("__real").desc())
    back, earlier = order.rowsBetween(Window.unboundedPreceding, 0), order.rowsBetween(Window.unboundedPreceding, -1)
    reverse = Window.partitionBy(source, "__block").orderBy(F.col("slot_us").desc(), F.col("__real").desc()).rowsBetween(Window.unboundedPreceding, 0)
    met = merged.withColumn("__until", F.last("last", ignorenulls=True).over(earlier))
    here = F.when(F.col("__real") == 1, F.struct("slot_us", "first", "last", F.col("__until").alias("until")))
    both = met.withColumns({"__h": F.last(here, ignorenulls=True).over(back), "__n": F.last("first", ignorenulls=True).over(reverse)}).filter("__real = 0")
    observed = F.coalesce(F.col("__h.slot_us") == F.col("slot_us"), F.lit(False))
    before = F.when(observed & (F.col("__h.first.at") == F.col("slot_us")), F.col("__h.first")).when(observed, F.coalesce("__h.until", "__before")).otherwise(F.coalesce("__h.last", "__before"))
    both = both.select(source, "slot_us", observed.alias("__observed"), before.alias("__p"), F.coalesce("__n", "__after").alias("__n"))
    width = F.col("__n.at") - F.col("__p.at")
    near_enough = F.coalesce(F.lit(True) if gap_limit_us is None else width <= gap_limit_us, F.lit(False)) & F.col("__p").isNotNull()
    status = F.when(F.col("__observed"), "observed").when(near_enough, "filled").otherwise("missing")
    share = (F.col("slot_us") - F.col("__p.at")) / width
    between = lambda v: F.col(f"__p.{v}").cast("double") + (F.col(f"__n.{v}").cast("double") - F.col(f"__p.{v}").cast("double")) * share
    value = lambda v: F.when(width == 0, F.col(f"__p.{v}").cast("double")).when(near_enough, between(v)).when(F.col("__observed"), F.col(f"__n.{v}").cast("double"))
    return both.select(source, "slot_us", status.alias("status"), *(value(v).alias(v) for v in values))


def uncovered(readings: DataFrame, source: str, time_us: Column, step_us: int) -> DataFrame:
    """(source, slot_us) of the grid between a source's first and last reading that no reading covers."""
    return regular(readings, source, time_us, step_us).filter("status != 'observed'").select(source, "slot_us")
