"""Fixed-interval trade buckets with exact decimals, split by taker side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.functions import scalars
from marlstone.operators import multiset

GRAINS = (1, 5, 60)


def trade_buckets(trades: DataFrame, keys: Sequence[str], seconds: Sequence[int] = GRAINS, median: bool = False) -> DataFrame:
    """One row per (keys, bucket_seconds, bucket_start_us) with any trade.

    ``trades`` needs event_us, price, quantity, side and the order columns source_ordinal and
    native_trade_id; open and close follow (event_us, source_ordinal, native_trade_id). Rows
    without time, price or quantity are left out; sides other than BUY and SELL count in the
    totals only. All grains come from one pass. The mean size and, if asked for, the median size
    (from counts of distinct sizes) are exact, rounded once to 18 digits, ties to the even digit.
    """
    quote = scalars.product(F.col("price"), F.col("quantity"))
    rows = trades.filter("event_us is not null and price is not null and quantity is not null").select(
        *keys, "event_us", "price", "quantity", "side",
        F.struct("event_us", "source_ordinal", "native_trade_id").alias("at"), quote.alias("quote"),
        F.explode(F.array(*map(F.lit, seconds))).alias("bucket_seconds"),
    )
    width = F.col("bucket_seconds").cast("bigint") * 1_000_000
    rows = rows.withColumn("bucket_start_us", F.col("event_us") - F.pmod("event_us", width))
    by = [*keys, "bucket_seconds", "bucket_start_us"]
    of = lambda side, c: F.coalesce(F.sum(F.when(F.col("side") == side, F.col(c))), F.lit(0).cast("decimal(38,18)"))
    out = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("trade_count"),
        F.count_if(F.col("side") == "BUY").alias("buy_count"),
        F.count_if(F.col("side") == "SELL").alias("sell_count"),
        F.min_by("price", "at").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "at").alias("close"),
        F.sum("quantity").alias("base_volume"),
        F.sum("quote").alias("quote_volume"),
        of("BUY", "quantity").alias("buy_base"), of("SELL", "quantity").alias("sell_base"),
        of("BUY", "quote").alias("buy_quote"), of("SELL", "quote").alias("sell_quote"),
        F.max("quantity").alias("max_size"),
    )
    out = out.withColumns({
        "base_delta": F.col("buy_base") - F.col("sell_base"),
        "quote_delta": F.col("buy_quote") - F.col("sell_quote"),
        "avg_size": scalars.mean_half_even(F.col("base_volume"), F.col("trade_count")),
    })
    if median:
        sizes = multiset.figures(multiset.counted(rows, by, "quantity"), by, "quantity", "n").select(*by, F.bround("median", 18).cast("decimal(38,18)").alias("median_size"))
        out = out.join(sizes, by)
    return out


def rollup(buckets: DataFrame, keys: Sequence[str], seconds: int) -> DataFrame:
    """Coarser buckets from finer ones of one grain: everything but the median rolls up exactly."""
    width = seconds * 1_000_000
    start = F.col("bucket_start_us") - F.pmod("bucket_start_us", F.lit(width))
    sums = ("trade_count", "buy_count", "sell_count", "base_volume", "quote_volume", "buy_base", "sell_base", "buy_quote", "sell_quote", "base_delta", "quote_delta")
    return buckets.withColumn("__start", start).groupBy(*keys, F.col("__start").alias("bucket_start_us")).agg(
        *(F.sum(c).alias(c) for c in sums),
        F.min_by("open", "bucket_start_us").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "bucket_start_us").alias("close"), F.max("max_size").alias("max_size"),
    )


def input_problems(trades: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per keys the rows that break what buckets assume: no time, unknown side, bad number, tied order."""
    order = F.struct("event_us", "source_ordinal", "native_trade_id")
    return trades.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("event_us").isNull()).alias("without_time"),
        F.count_if(~F.coalesce(F.col("side").isin("BUY", "SELL"), F.lit(False))).alias("unknown_side"),
        F.count_if(~F.coalesce((F.col("price") > 0) & (F.col("quantity") > 0), F.lit(False))).alias("bad_number"),
        (F.count(F.lit(1)) - F.count_distinct(order)).alias("tied_order"),
    )
