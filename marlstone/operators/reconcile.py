"""Keyed dedup with conflicts, and reconciliation of up to three sources by natural key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.operators import multiset

SIDES = ("archive", "ws", "rest")


def conflicts(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(keys..., versions) of keys that occur with more than one set of values (nulls are values)."""
    return df.groupBy(*keys).agg(F.count_distinct(F.struct(*values)).alias("versions")).filter("versions > 1")


def overlap_conflicts(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(keys..., fields): keys on both sides of which some values differ, nulls equal to nulls."""
    other = right.select(*keys, *(F.col(v).alias(f"__r_{v}") for v in values))
    differing = F.array_compact(F.array(*(F.when(~F.col(v).eqNullSafe(F.col(f"__r_{v}")), F.lit(v)) for v in values)))
    return left.select(*keys, *values).join(other, list(keys)).select(*keys, F.concat_ws(",", differing).alias("fields")).filter("fields <> ''")


def natural_key(aliases: Sequence[str], columns: Sequence[str]) -> Column:
    """The first alias that has a value, as text; none of the columns existing is an error."""
    there = [a for a in aliases if a in columns]
    if not there:
        raise ValueError(f"none of {list(aliases)} is a column")
    return F.coalesce(*(F.col(a).cast("string") for a in there))


def three_way(sources: Mapping[str, DataFrame], tolerance_ms: int = 0) -> DataFrame:
    """One row per key of archive, ws and rest with presence and conflict flags.

    Each source needs key, price, quantity (decimals), side, time_ms and ordinal; of repeated keys
    the highest ordinal counts. A missing or empty source matches nothing. Flags: missing_in_ws,
    missing_in_archive (only if the archive has any row at all), missing_in_rest (likewise),
    field_conflict, side_conflict (both known), time_conflict (both positive, beyond the
    tolerance) and matched.
    """
    tagged = None
    for name in SIDES:
        if name not in sources:
            continue
        row = F.max(F.struct("ordinal", "price", "quantity", "side", "time_ms")).alias("r")
        one = sources[name].filter("key is not null").groupBy("key").agg(row).select("key", F.lit(name).alias("source"), "r")
        tagged = one if tagged is None else tagged.unionByName(one)
    pick = lambda name: F.max(F.when(F.col("source") == name, F.col("r"))).alias(name)
    keyed = tagged.groupBy("key").agg(*(pick(n) for n in SIDES))
    # whether a source has any row is one fact about the whole set: a scalar subquery of one row
    has = lambda n: tagged.agg(F.coalesce(F.bool_or(F.col("source") == n), F.lit(False))).scalar()
    keyed = keyed.withColumns({f"has_{n}": has(n) for n in ("archive", "rest")})
    there = {n: F.col(n).isNotNull() for n in SIDES}
    both = there["archive"] & there["ws"]
    a, w = (lambda f: F.col(f"archive.{f}")), (lambda f: F.col(f"ws.{f}"))
    field = both & (~a("price").eqNullSafe(w("price")) | ~a("quantity").eqNullSafe(w("quantity")))
    side = both & F.coalesce((a("side") != "") & (w("side") != "") & (a("side") != w("side")), F.lit(False))
    time = both & F.coalesce((a("time_ms") > 0) & (w("time_ms") > 0) & (F.abs(a("time_ms") - w("time_ms")) > tolerance_ms), F.lit(False))
    only_ws = there["ws"] & ~there["archive"]
    return keyed.select(
        "key",
        (there["archive"] & ~there["ws"]).alias("missing_in_ws"),
        (only_ws & F.col("has_archive")).alias("missing_in_archive"),
        (there["archive"] & ~there["rest"] & F.col("has_rest")).alias("missing_in_rest"),
        field.alias("field_conflict"), side.alias("side_conflict"), time.alias("time_conflict"),
        ((both & ~field & ~side & ~time) | (only_ws & ~F.col("has_archive"))).alias("matched"),
        there["archive"].alias("in_archive"),
    )


def summary(keyed: DataFrame) -> DataFrame:
    """One row: counts of every flag, the match rate in percent and whether coverage is proven."""
    flags = ("missing_in_ws", "missing_in_archive", "missing_in_rest", "field_conflict", "side_conflict", "time_conflict", "matched")
    out = keyed.agg(*(F.count_if(F.col(f)).alias(f) for f in flags), F.count_if("in_archive").alias("archive_keys"), F.count(F.lit(1)).alias("keys"))
    base = F.greatest(F.when(F.col("archive_keys") > 0, F.col("archive_keys")).otherwise(F.col("keys")), F.lit(1))
    proven = (F.col("missing_in_ws") + F.col("field_conflict") + F.col("side_conflict") + F.col("time_conflict")) == 0
    return out.withColumns({"match_rate": F.round(F.col("matched") * 100.0 / base, 2), "coverage_proven": proven})


def details(keyed: DataFrame, most: int = 50) -> DataFrame:
    """The first ``most`` keys with any discrepancy, in key order (a report, hence the limit)."""
    kinds = F.array_compact(F.array(*(F.when(F.col(f), F.lit(f)) for f in ("missing_in_ws", "missing_in_archive", "field_conflict", "side_conflict", "time_conflict"))))
    return keyed.select("key", F.concat_ws(",", kinds).alias("kinds")).filter("kinds <> ''").orderBy("key").limit(most)


def ratios(df: DataFrame, slot: str, group: str, left: str, right: str, value: str, keys: Sequence[str]) -> DataFrame:
    """Slots where both groups have a value, per ``keys``: their ratio's minimum, median, maximum, and slots in number."""
    mean = df.filter(F.col(group).isin(left, right)).groupBy(*keys, slot).agg(
        F.avg(F.when(F.col(group) == left, F.col(value))).alias("a"), F.avg(F.when(F.col(group) == right, F.col(value))).alias("b")
    )
    both = mean.filter("a is not null and b is not null and b <> 0").select(*keys, (F.col("a") / F.col("b")).alias("r"))
    ends = both.groupBy(*keys).agg(F.count("r").alias("slots"), F.min("r").alias("lowest"), F.max("r").alias("highest"))
    middle = multiset.quantiles(both, keys, "r", [0.5]).select(*keys, F.col("q0").alias("median"))
    return ends.join(middle, list(keys)).select(*keys, "slots", "lowest", "median", "highest")
