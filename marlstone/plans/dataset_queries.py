"""Queries for features, data sets and raw archives, each with the SQL that says the same."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions import normalize, scalars
from marlstone.operators import features, gapstates, merge, multiset, quality, reconcile
from marlstone.operators.compaction import file_system
from marlstone.plans.market_queries import BARS_SQL, TAPE, bars, dbl, rounded, tape
from marlstone.plans.registry import Registry
from marlstone.session import keep, scratch, tasks
from marlstone.sources import archives, pages, publish
from marlstone.sources.tables import table
from marlstone.streaming import jobs

registry = Registry()
query, QUERIES, ORACLE = registry.query, registry.queries, registry.sql
HOUR_US = 3_600_000_000

# Features ---------------------------------------------------------------------------------


@query(f"""with {BARS_SQL}, r as (select *, c / nullif(lag(c) over w, 0) - 1 as r, c - lag(c) over w as step from bars window w as (partition by instrument_id order by t))
  select instrument_id, t, round(4 * stddev_samp(c) over b / nullif(avg(c) over b, 0), 9) as bollinger_width, round(c / nullif(sum((h + l + c) / 3 * v) over b / nullif(sum(v) over b, 0), 0) - 1, 9) as vwap_distance, round(c / nullif(max(h) over b, 0) - 1, 9) as high_distance, round(c / nullif(min(l) over b, 0) - 1, 9) as low_distance,
    case when c > max(h) over p then 1 when c < min(l) over p then -1 else 0 end as breakout, round(abs(c - first(c) over b) / nullif(sum(abs(step)) over s, 0), 6) as trend_strength, round(max(h) over b - min(l) over b, 6) as realized_range
  from r window w as (partition by instrument_id order by t), b as (partition by instrument_id order by t rows between 19 preceding and current row), p as (partition by instrument_id order by t rows between 20 preceding and 1 preceding), s as (partition by instrument_id order by t rows between 18 preceding and current row)""")
def technical_features(spark: SparkSession, folder: str) -> DataFrame:
    made = features.technical(bars(spark, folder), ["instrument_id"], "t", "h", "l", "c", "v", 20)
    shown = rounded(rounded(made, "trend_strength", "realized_range"), "bollinger_width", "vwap_distance", "high_distance", "low_distance", digits=9)
    return shown.select("instrument_id", "t", "bollinger_width", "vwap_distance", "high_distance", "low_distance", F.col("breakout").cast("int").alias("breakout"), "trend_strength", "realized_range")


@query(f"""with {BARS_SQL}, r as (select *, c / nullif(lag(c) over (partition by instrument_id order by t), 0) - 1 as r from bars), q as (select *, list(r) over (partition by instrument_id order by t rows between 19 preceding and current row) as a from r),
  m as (select instrument_id, t, list_filter(a, lambda x: x is not null) as a from q), n as (select *, len(a) as n, list_avg(a) as mu from m), d as (select *, list_sum(list_transform(a, lambda x: (x - mu) ** 2)) / n as m2, list_sum(list_transform(a, lambda x: (x - mu) ** 3)) / n as m3, list_sum(list_transform(a, lambda x: (x - mu) ** 4)) / n as m4 from n)
  select instrument_id, t, round(m3 / m2 ** 1.5, 4) as skewness, round(m4 / m2 ** 2 - 3, 4) as kurtosis from d where n > 2 and m2 > 1e-16""")
def return_moments(spark: SparkSession, folder: str) -> DataFrame:
    """Skewness and excess kurtosis of the last twenty returns, wherever they vary."""
    rows = bars(spark, folder)
    from pyspark.sql import Window

    back = Window.partitionBy("instrument_id").orderBy("t").rowsBetween(-19, 0)
    made = features.technical(rows, ["instrument_id"], "t", "h", "l", "c", "v", 20)
    r = F.col("c") / F.nullif(F.lag("c").over(Window.partitionBy("instrument_id").orderBy("t")), F.lit(0.0)) - 1
    basis = made.withColumn("r", r).withColumns({"n": F.count("r").over(back), "m2": F.var_pop("r").over(back)}).filter("n > 2 and m2 > 1e-16")
    return rounded(basis.select("instrument_id", "t", "skewness", "kurtosis"), "skewness", "kurtosis", digits=4)


@query(f"""with {BARS_SQL}, d as (select *, c - lag(c) over w as change, stddev_samp(c) over b as sd, avg(c) over b as mu, list(c) over b as a from bars window w as (partition by instrument_id order by t), b as (partition by instrument_id order by t rows between 95 preceding and current row))
  select instrument_id, t, round(change, 6) as change, round(change - lag(change) over (partition by instrument_id order by t), 6) as acceleration, round((c - mu) / nullif(sd, 0), 6) as zscore, round(len(list_filter(a, lambda x: x <= c)) / len(a), 6) as percentile from d""")
def series_standing(spark: SparkSession, folder: str) -> DataFrame:
    """Change, acceleration, z-score and percentile of every close among the last 96."""
    made = features.standing(bars(spark, folder), ["instrument_id"], "t", "c", 96)
    return rounded(made.select("instrument_id", "t", "change", "acceleration", "zscore", "percentile"), "change", "acceleration", "zscore", "percentile")


@query("""with a as (select instrument_id, epoch_us(event_time) // 3600000000 as hour, coalesce(sum(try_cast(source_quantity as decimal(38,18))) filter (upper(source_side) = 'BUY'), 0)::double as b, coalesce(sum(try_cast(source_quantity as decimal(38,18))) filter (upper(source_side) = 'SELL'), 0)::double as s from liquidation where event_time is not null group by 1, 2)
  select instrument_id, hour, round(b, 6) as buy, round(s, 6) as sell, round((b - s) / nullif(b + s, 0), 6) as imbalance from a""")
def order_imbalance(spark: SparkSession, folder: str) -> DataFrame:
    """Forced orders' amounts by side and hour."""
    rows = table(spark, folder, "liquidation", "instrument_id", "event_time", "source_side", F.expr("try_cast(source_quantity as decimal(38,18))").alias("q")).filter("event_time is not null")
    found = features.imbalance(rows.withColumn("hour", F.expr(f"unix_micros(event_time) div {HOUR_US}")), ["instrument_id", "hour"], "source_side", "q")
    return rounded(found, "buy", "sell", "imbalance")


VENUE_SQL = f"""{TAPE}, v as (select t.market_type, t.native_symbol, t.exchange, event_us // 3600000000 as hour, p.price, p.quantity, p.side from tape p join (select distinct instrument_id, exchange, market_type, native_symbol from archive_trade) t using (instrument_id)),
  h as (select market_type, native_symbol, hour, exchange, cast(sum(price) as double) / count(*) as price, cast(sum(quantity) as double) as volume, cast(coalesce(sum(quantity) filter (side = 'BUY'), 0) - coalesce(sum(quantity) filter (side = 'SELL'), 0) as double) as delta from v group by 1, 2, 3, 4)"""


def _venue_hours(spark: SparkSession, folder: str) -> DataFrame:
    named = table(spark, folder, "archive_trade", "instrument_id", "exchange", "market_type", "native_symbol").distinct()
    rows = tape(spark, folder).join(named, "instrument_id").withColumn("hour", F.expr(f"event_us div {HOUR_US}"))
    signed = scalars.signed(F.col("quantity"), F.col("side"))
    return rows.groupBy("market_type", "native_symbol", "hour", "exchange").agg((F.sum("price").cast("double") / F.count(F.lit(1))).alias("price"), F.sum("quantity").cast("double").alias("volume"), F.sum(signed).cast("double").alias("delta"))


@query(f"""with {VENUE_SQL}, w as (select market_type, native_symbol, hour, max(price) filter (exchange = 'binance') as p1, max(price) filter (exchange = 'bybit') as p2, max(volume) filter (exchange = 'binance') as v1, max(volume) filter (exchange = 'bybit') as v2, max(delta) filter (exchange = 'binance') as d1, max(delta) filter (exchange = 'bybit') as d2 from h group by 1, 2, 3)
  select market_type, native_symbol, hour, round(p1 - p2, 5) as price_gap, round((p1 - p2) / nullif((p1 + p2) / 2, 0), 8) as price_relative, round(v1 - v2, 5) as volume_gap, round((v1 - v2) / nullif((v1 + v2) / 2, 0), 6) as volume_relative, round(d1 - d2, 5) as delta_gap from w where p1 is not null and p2 is not null""")
def venue_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """How far the two venues' hourly price, volume and signed volume lie apart."""
    found = features.divergence(_venue_hours(spark, folder), ["market_type", "native_symbol", "hour"], "exchange", "binance", "bybit", ["price", "volume", "delta"]).drop("delta_relative")
    return rounded(rounded(rounded(found, "price_gap", "volume_gap", "delta_gap", digits=5), "price_relative", digits=8), "volume_relative")


@query(f"""with {VENUE_SQL}, l as (select *, price - lag(price) over w as dp, volume - lag(volume) over w as dv from h window w as (partition by market_type, native_symbol, exchange order by hour))
  select exchange, market_type, case when dp = 0 or dv = 0 then 'FLAT' when dp > 0 and dv > 0 then 'LONG_BUILDUP' when dp > 0 and dv < 0 then 'SHORT_COVERING' when dp < 0 and dv > 0 then 'SHORT_BUILDUP' when dp < 0 and dv < 0 then 'LONG_UNWINDING' end as quadrant, count(*) as hours from l group by 1, 2, 3""")
def move_quadrants(spark: SparkSession, folder: str) -> DataFrame:
    """How often price and volume move together or apart, volume standing for interest."""
    from pyspark.sql import Window

    w = Window.partitionBy("market_type", "native_symbol", "exchange").orderBy("hour")
    moved = _venue_hours(spark, folder).withColumns({"dp": F.col("price") - F.lag("price").over(w), "dv": F.col("volume") - F.lag("volume").over(w)})
    return moved.groupBy("exchange", "market_type", features.quadrant(F.col("dp"), F.col("dv")).alias("quadrant")).agg(F.count(F.lit(1)).alias("hours"))


@query(f"""with {TAPE} select instrument_id, count(quantity) as n, round(quantile_cont(cast(quantity as double), 0.5), 6) as p50, round(quantile_cont(cast(quantity as double), 0.99), 6) as p99, round(quantile_cont(cast(quantity as double), 0.995), 6) as p995, round(quantile_cont(cast(quantity as double), 0.999), 6) as p999 from tape group by 1""")
def size_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Exact quantiles of trade sizes."""
    found = multiset.quantiles(tape(spark, folder), ["instrument_id"], "quantity", [0.5, 0.99, 0.995, 0.999]).withColumnsRenamed({"q0": "p50", "q1": "p99", "q2": "p995", "q3": "p999"})
    return rounded(found, "p50", "p99", "p995", "p999")


ALIGNED_SQL = f"""{BARS_SQL}, b as (select instrument_id, t - t % 300000000 as s, arg_max(c, t) as close, sum(v) as volume from bars group by 1, 2), k as (select instrument_id, s + 300000000 as t, close, volume from b),
  q as (select instrument_id, epoch_us(coalesce(knowledge_time, received_at)) as u, max(try_cast(source_price as double)) as price from liquidation where coalesce(knowledge_time, received_at) is not null and instrument_id is not null group by 1, 2),
  j as (select k.*, q.u, q.price from k asof left join q on k.instrument_id = q.instrument_id and k.t >= q.u),
  a as (select instrument_id, t, close, volume, case when t - u <= 1800000000 then price end as order_price, case when t - u <= 1800000000 then t - u end as order_age_us, case when t - u = 0 then 'exact_available' when t - u <= 1800000000 then 'asof_fresh' when u is not null then 'stale' else 'missing' end as order_quality from j)"""


def _aligned(spark: SparkSession, folder: str) -> DataFrame:
    """Five-minute bars at their ends, with the last forced order's price known by then."""
    rows = bars(spark, folder).withColumn("s", F.col("t") - F.pmod("t", F.lit(300_000_000)))
    base = rows.groupBy("instrument_id", "s").agg(F.max_by("c", "t").alias("close"), F.sum("v").alias("volume")).select("instrument_id", (F.col("s") + 300_000_000).alias("t"), "close", "volume")
    orders = table(spark, folder, "liquidation", "instrument_id", F.unix_micros(F.coalesce("knowledge_time", "received_at")).alias("t"), F.col("source_price").try_cast("double").alias("price")).filter("t is not null")
    return features.aligned(base, [(orders, ["price"], 1_800_000_000, "order_")], ["instrument_id"], "t")


@query(f"with {ALIGNED_SQL} select instrument_id, t, round(close, 6) as close, round(volume, 6) as volume, round(order_price, 6) as order_price, order_age_us, order_quality from a")
def dataset_aligned(spark: SparkSession, folder: str) -> DataFrame:
    """A data set without a look ahead: bars, and what was known by their ends."""
    return rounded(_aligned(spark, folder), "close", "volume", "order_price")


@query(f"with {ALIGNED_SQL} select count(*) as rows, true as same, true as changed from a")
def dataset_hashes(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the data set's fingerprint is that of the same rows laid out otherwise, and another once a row is gone."""
    made = keep(_aligned(spark, folder), "dataset")
    prints = [features.dataset_hash(df).first() for df in (made, made.repartition(5, "t"), made.subtract(made.orderBy("instrument_id", "t").limit(1)))]
    return spark.createDataFrame([(prints[0]["rows"], prints[0] == prints[1], prints[0]["fingerprint"] != prints[2]["fingerprint"])], "rows bigint, same boolean, changed boolean")


FIRST_US = 1_614_560_400_000_000


@query(f"""with {BARS_SQL}, f as (select b.instrument_id, b.t, b.t + 1800000000 as u, k as fold, {FIRST_US} + k * 7200000000 as x from bars b, (select unnest([0, 1, 2]) as k)),
  r as (select *, case when t >= x and t < x + 7200000000 then 'test' when t >= x - 14400000000 and u < x - 600000000 then 'train' end as role from f) select cast(fold as integer) as fold, role, instrument_id, count(*) as rows, min(t) as first_us, max(t) as last_us from r where role is not null group by 1, 2, 3""")
def walk_forward_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of three walk-forward folds, purged by half-hour labels and ten minutes of embargo."""
    rows = bars(spark, folder).select("instrument_id", "t", (F.col("t") + 1_800_000_000).alias("until"))
    made = features.walk_forward(rows, "t", "until", FIRST_US, 4 * HOUR_US, 2 * HOUR_US, 3, 600_000_000)
    return made.groupBy("fold", "role", "instrument_id").agg(F.count(F.lit(1)).alias("rows"), F.min("t").alias("first_us"), F.max("t").alias("last_us"))


GUESS_SQL = f"""{BARS_SQL}, f as (select instrument_id, t, lead(c, 30) over w / c - 1 as future, c / lag(c, 30) over w - 1 as past from bars window w as (partition by instrument_id order by t)),
  g as (select instrument_id, t, case when future > 0.001 then 'UP' when future < -0.001 then 'DOWN' when future is not null then 'NEUTRAL' end as label, case when past > 0.001 then 'UP' when past < -0.001 then 'DOWN' when past is not null then 'NEUTRAL' end as guess, case when past > 0.001 then future when past < -0.001 then -future end as profit from f)"""


def _guesses(spark: SparkSession, folder: str) -> DataFrame:
    """Each bar's label half an hour ahead, and the guess that the last half hour goes on."""
    from pyspark.sql import Window

    w = Window.partitionBy("instrument_id").orderBy("t")
    rows = bars(spark, folder).withColumns({"future": F.lead("c", 30).over(w) / F.col("c") - 1, "past": F.col("c") / F.lag("c", 30).over(w) - 1})
    named = lambda x: F.when(F.col(x) > 0.001, "UP").when(F.col(x) < -0.001, "DOWN").when(F.col(x).isNotNull(), "NEUTRAL")
    return rows.select("instrument_id", "t", named("future").alias("label"), named("past").alias("guess"), F.when(F.col("past") > 0.001, F.col("future")).when(F.col("past") < -0.001, -F.col("future")).alias("profit"))


@query(f"""with {GUESS_SQL}, p as (select label as l, guess as g, count(*) as n from g where label is not null and guess is not null group by 1, 2), k as (select l as class from p union select g from p),
  s as (select class, (select coalesce(sum(n), 0) from p where l = class) as support, (select coalesce(sum(n), 0) from p where g = class) as guessed, (select coalesce(sum(n), 0) from p where l = class and g = class) as hits from k)
  select class, cast(support as bigint) as support, cast(guessed as bigint) as guessed, cast(hits as bigint) as hits, round(hits / nullif(guessed, 0), 6) as precision, round(hits / nullif(support, 0), 6) as recall, round(2 * hits / nullif(support + guessed, 0), 6) as f1 from s""")
def label_confusion(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.confusion(_guesses(spark, folder), "label", "guess"), "precision", "recall", "f1")


@query(f"""with {GUESS_SQL} select instrument_id, count(profit) as trades, round(sum(profit), 6) as net, round(count(*) filter (profit > 0) / count(profit), 6) as hit_rate, round(sum(case when profit > 0 then profit else 0 end) / nullif(-sum(case when profit < 0 then profit else 0 end), 0), 4) as profit_factor, round(avg(profit), 8) as expectancy, round(avg(profit) / nullif(stddev_samp(profit), 0), 5) as sharpe
  from g where profit is not null group by 1""")
def trading_metrics(spark: SparkSession, folder: str) -> DataFrame:
    found = features.trading_metrics(_guesses(spark, folder), ["instrument_id"], "profit")
    return rounded(rounded(rounded(rounded(found, "net", "hit_rate"), "profit_factor", digits=4), "expectancy", digits=8), "sharpe", digits=5)


@query(f"""with l as (select instrument_id, symbol, epoch_us(received_at) as r, try_cast(source_price as double) as p from liquidation where received_at is not null and epoch_us(received_at) <= {FIRST_US}) select instrument_id, symbol, max(r) as recorded_us, round(max_by(p, (r, p)), 6) as price from l group by 1, 2""")
def journal_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """What a journal of prices said at a fixed time."""
    rows = table(spark, folder, "liquidation", "instrument_id", "symbol", F.unix_micros("received_at").alias("recorded_us"), F.col("source_price").try_cast("double").alias("price"))
    return rounded(features.journal_as_of(rows, ["instrument_id", "symbol"], "recorded_us", FIRST_US), "price")


# Scalars and normalisers ------------------------------------------------------------------


@query("""select distinct exchange, native_symbol, cast(event_time as date)::varchar as day, 'https://host.example/data/' || market_type || '/daily/trades/' || upper(native_symbol) || '/' || upper(native_symbol) || '-trades-' || strftime(event_time, '%Y-%m-%d') || '.zip' as url from archive_trade where event_time is not null""")
def archive_urls(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "archive_trade", "exchange", "market_type", "native_symbol", F.to_date("event_time").alias("d")).filter("d is not null").distinct()
    return rows.select("exchange", "native_symbol", F.col("d").cast("string").alias("day"), publish.archive_url("https://host.example/data/", F.col("market_type"), F.col("native_symbol"), F.col("d")).alias("url"))


def _texts(rows: DataFrame) -> DataFrame:
    """Candles as the twelve texts of an archive's line."""
    ms = lambda c: (F.expr(f"unix_micros({c}) div 1000")).cast("string")
    number = lambda c: F.col(c).cast("string")
    parts = [ms("open_time"), *map(number, ("open_price", "high_price", "low_price", "close_price", "base_volume")), ms("close_time"), *map(number, ("quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume")), F.lit("0")]
    return rows.select("instrument_id", *(p.alias(f"c{i}") for i, p in enumerate(parts)))


KLINE_SQL = "select instrument_id, count(*) as rows, round(cast(sum(close_price) as double), 4) as close, round(cast(sum(base_volume) as double), 4) as volume, cast(sum(trade_count) as bigint) as trades, min(epoch_us(open_time) // 1000) as first_ms, max(epoch_us(close_time) // 1000) as last_ms, count(*) filter (not (low_price <= least(open_price, close_price))) as low_problems from ohlcv_candle group by 1"


def _kline_totals(candles: DataFrame) -> DataFrame:
    judged = candles.withColumn("v", quality.violations(normalize.candle_rules()))
    return judged.groupBy("instrument_id").agg(
        F.count(F.lit(1)).alias("rows"), dbl(F.sum("close"), 4).alias("close"), dbl(F.sum("base_volume"), 4).alias("volume"), F.sum("trade_count").alias("trades"),
        F.min(F.unix_millis("open_time")).alias("first_ms"), F.max(F.unix_millis("close_time")).alias("last_ms"), F.count_if(F.array_contains("v", "low_lowest")).alias("low_problems"),
    )


@query(KLINE_SQL)
def kline_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Candles typed from the texts of archive lines, and their rules."""
    return _kline_totals(normalize.kline_rows(_texts(table(spark, folder, "ohlcv_candle")), "ms"))


@query("""select instrument_id, count(*) as rows, round(cast(sum(close_price) as double), 4) as close, count(*) filter (false) as with_trades, min(epoch_us(open_time) // 1000) as first_ms, max(epoch_us(open_time) // 1000 + 59999) as last_ms from ohlcv_candle group by 1""")
def short_kline_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Candles typed from a REST line of seven texts: what it lacks is null."""
    made = normalize.short_kline_rows(_texts(table(spark, folder, "ohlcv_candle")).drop("c6", "c8", "c9", "c10", "c11").withColumnRenamed("c7", "c6"))
    return made.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("rows"), dbl(F.sum("close"), 4).alias("close"), F.count("trade_count").alias("with_trades"), F.min(F.unix_millis("open_time")).alias("first_ms"), F.max(F.unix_millis("close_time")).alias("last_ms"))


@query("""select instrument_id, candle_interval, case when market_type = 'derivative' then 'perpetual' else market_type end as market_type, count(*) as rows, count(base_volume) as source_volumes, count(*) filter (candle_interval = '1m') as minutes, '2.1.0' as schema_version from ohlcv_candle group by 1, 2, 3""")
def candle_bridge(spark: SparkSession, folder: str) -> DataFrame:
    """Candles of the first schema version in the second."""
    rows = table(spark, folder, "ohlcv_candle").withColumnsRenamed({"open_price": "open", "high_price": "high", "low_price": "low", "close_price": "close"})
    made = normalize.second_version(rows, "candle_interval")
    found = made.groupBy("instrument_id", "candle_interval", "market_type").agg(F.count(F.lit(1)).alias("rows"), F.count("source_volume").alias("source_volumes"), F.count_if(F.col("interval") == "PT1M").alias("minutes"), F.max("schema_version").alias("schema_version"))
    return found


@query("""select instrument_id, count(*) filter (close_time < timestamptz '2021-03-01 02:00:00+00') as final, count(*) filter (open_time + interval 60 seconds <= timestamptz '2021-03-01 02:00:00+00') as whole, count(*) as rows from ohlcv_candle group by 1""")
def final_candles(spark: SparkSession, folder: str) -> DataFrame:
    """Candles that a cut-off lets through, by their close and by their open."""
    rows = table(spark, folder, "ohlcv_candle", "instrument_id", "open_time", "close_time")
    cut = F.lit("2021-03-01 02:00:00").cast("timestamp")
    return rows.groupBy("instrument_id").agg(F.count_if(normalize.closed_by(cut, close_time=F.col("close_time"))).alias("final"), F.count_if(normalize.closed_by(cut, open_time=F.col("open_time"))).alias("whole"), F.count(F.lit(1)).alias("rows"))


TRADES_SQL = """with t as (select *, case when is_buyer_maker then 'SELL' when not is_buyer_maker then 'BUY' end as side from archive_trade where is_buyer_maker is not null and event_time is not null)"""


def _trade_texts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "archive_trade", "instrument_id", "native_trade_id", "price", "quantity", "quote_quantity", "event_time", "is_buyer_maker", "is_best_match").filter("is_buyer_maker is not null and event_time is not null")
    word = lambda c: F.when(F.col(c), "True").when(~F.col(c), "False")
    return rows.select("instrument_id", F.col("native_trade_id").alias("id"), *(F.col(c).cast("string").alias(n) for c, n in (("price", "price"), ("quantity", "qty"), ("quote_quantity", "quote_qty"))), F.unix_micros("event_time").cast("string").alias("time"), word("is_buyer_maker").alias("is_buyer_maker"), word("is_best_match").alias("is_best_match"))


@query(TRADES_SQL + """ select instrument_id, side as taker_side, count(*) as rows, round(cast(sum(quantity) as double), 5) as quantity, round(cast(sum(case side when 'BUY' then quantity else -quantity end) as double), 5) as signed, min(epoch_us(event_time)) as first_us, count(*) filter (is_best_match) as best, count(*) filter (cast(event_time as date) <> date '2021-03-01') as other_day from t group by 1, 2""")
def archive_trade_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Individual trades typed from the texts of archive lines, by exact words and held against a requested day."""
    made = normalize.archive_trades(_trade_texts(spark, folder), "us", strict=True)
    late = ~normalize.trade_rules("2021-03-01")["of_the_day"]
    return made.groupBy("instrument_id", "taker_side").agg(
        F.count(F.lit(1)).alias("rows"), dbl(F.sum("quantity"), 5).alias("quantity"), dbl(F.sum("signed_quantity"), 5).alias("signed"), F.min(F.unix_micros("event_time")).alias("first_us"), F.count_if("is_best_match").alias("best"), F.count_if(late).alias("other_day"),
    )


@query("""select instrument_id, case upper(trim(taker_side)) when 'BUY' then 'BUY' when 'SELL' then 'SELL' else 'UNKNOWN' end as taker_side, count(*) as rows, round(cast(sum(case when try_cast(quantity as decimal(38,18)) > 0 then try_cast(quantity as decimal(38,18)) end) as double), 5) as quantity, count(*) filter (not coalesce(upper(trim(taker_side)) in ('BUY', 'SELL', 'B', 'S'), false)) as flagged, min(event_time_ms) as first_ms from ws_trade where not coalesce(upper(trim(taker_side)) in ('B', 'S'), false) group by 1, 2""")
def venue_trade_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Trades typed from the other venue's names, unknown sides flagged."""
    rows = table(spark, folder, "ws_trade", "instrument_id", F.col("native_trade_id").alias("trdMatchID"), "price", F.col("quantity").alias("size"), F.col("taker_side").alias("side"), F.col("event_time_ms").cast("string").alias("timestamp")).filter("not coalesce(upper(trim(side)) in ('B', 'S'), false)")
    made = normalize.venue_trades(rows, keep=["instrument_id"])
    return made.groupBy("instrument_id", "taker_side").agg(F.count(F.lit(1)).alias("rows"), dbl(F.sum("quantity"), 5).alias("quantity"), F.count_if(F.array_contains("dq_flags", "UNKNOWN_TAKER_SIDE")).alias("flagged"), F.min(F.unix_millis("event_time")).alias("first_ms"))


@query("""with e as (select payload::json as j from ws_envelope where payload like '%"aggTrade"%'), a as (select j->>'$.a' as id, try_cast(j->>'$.p' as decimal(38,18)) as p, try_cast(j->>'$.q' as decimal(38,18)) as q, cast(j->>'$.f' as bigint) as f, cast(j->>'$.l' as bigint) as l, j->>'$.m' as m, cast(j->>'$.T' as bigint) as t, j->>'$.s' as s from e where j->>'$.e' = 'aggTrade')
  select s as symbol, case m when 'true' then 'SELL' when 'false' then 'BUY' else 'UNKNOWN' end as taker_side, count(*) as rows, round(cast(sum(q) as double), 5) as quantity, cast(sum(l - f + 1) as bigint) as trades, min(t) as first_ms from a group by 1, 2""")
def aggregate_trade_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Exchange-aggregated trades typed from their fields."""
    got = lambda f: F.get_json_object("payload", f"$.{f}")
    raw = table(spark, folder, "ws_envelope", "payload").filter(got("e") == "aggTrade").select(got("s").alias("symbol"), got("a").alias("agg_id"), got("p").alias("price"), got("q").alias("qty"), got("f").alias("first_id"), got("l").alias("last_id"), got("T").alias("time"), got("m").alias("is_buyer_maker"))
    made = normalize.aggregate_trades(raw, "ms", keep=["symbol"])
    return made.groupBy("symbol", "taker_side").agg(F.count(F.lit(1)).alias("rows"), dbl(F.sum("quantity"), 5).alias("quantity"), F.sum(F.col("last_trade_id") - F.col("first_trade_id") + 1).alias("trades"), F.min(F.unix_millis("event_time")).alias("first_ms"))


@query("""select symbol, case when order_status = 'FILLED' then 'REGULAR' else upper(order_status) end as rate_type, count(*) as rows, round(cast(sum(try_cast(source_price as decimal(38,18))) as double), 4) as rate, count(*) filter (ingest_seq % 3 <> 0) as marks, min(epoch_us(event_time) // 1000) as first_ms from liquidation where event_time is not null group by 1, 2""")
def funding_rate_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Funding points typed from texts, made of the orders' prices: a blank type is REGULAR, a blank mark null."""
    rows = table(spark, folder, "liquidation", "symbol", "event_time", "source_price", "order_status", "ingest_seq").filter("event_time is not null")
    raw = rows.select("symbol", F.expr("unix_micros(event_time) div 1000").cast("string").alias("fundingTime"), F.col("source_price").alias("fundingRate"), F.when(F.col("ingest_seq") % 3 == 0, " ").otherwise("1.5").alias("markPrice"), F.when(F.col("order_status") != "FILLED", F.col("order_status")).otherwise("").alias("rateType"))
    made = normalize.funding_rates(raw)
    return made.groupBy("symbol", "rate_type").agg(F.count(F.lit(1)).alias("rows"), dbl(F.sum("funding_rate"), 4).alias("rate"), F.count("mark_price").alias("marks"), F.min(F.unix_millis("funding_time")).alias("first_ms"))


@query("""select symbol, 'sum' as form, count(*) as rows, round(cast(sum(try_cast(source_quantity as decimal(38,18))) as double), 5) as base, count(last_filled_quantity) as notionals, 0 as single_sides from liquidation where event_time is not null group by 1
  union all select symbol, 'both', count(*), round(cast(sum(try_cast(source_quantity as decimal(38,18))) as double), 5), 0, count(last_filled_quantity) from liquidation where event_time is not null group by 1""")
def open_interest_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Open interest typed from either venue's texts, made of the orders' quantities: both-sides and single-side figures stay apart."""
    rows = table(spark, folder, "liquidation", "symbol", F.expr("unix_micros(event_time) div 1000").cast("string").alias("timestamp"), "source_quantity", "last_filled_quantity").filter("timestamp is not null")
    one = normalize.open_interest(rows.select("symbol", "timestamp", F.col("source_quantity").alias("sumOpenInterest"), F.col("last_filled_quantity").alias("sumOpenInterestValue"))).withColumn("form", F.lit("sum"))
    two = normalize.open_interest(rows.select("symbol", "timestamp", F.col("source_quantity").alias("openInterest"), F.col("last_filled_quantity").alias("singleOpenInterest"))).withColumn("form", F.lit("both"))
    both = one.unionByName(two)
    return both.groupBy("symbol", "form").agg(F.count(F.lit(1)).alias("rows"), dbl(F.sum("open_interest_base"), 5).alias("base"), F.count("open_interest_notional").alias("notionals"), F.count("single_side_base").alias("single_sides"))


@query("""with l as (select *, row_number() over (order by ingest_seq) as k from liquidation where event_time is not null and source_quantity is not null), d as (select symbol, source_side, source_quantity as q, source_price as p, epoch_us(event_time) // 1000 as t from l)
  select symbol, case source_side when 'BUY' then 'LONG' when 'SELL' then 'SHORT' end as side, count(*) as rows, round(cast(sum(case when try_cast(q as decimal(38,18)) > 0 then try_cast(q as decimal(38,18)) end) as double), 5) as quantity, min(t) as first_ms from d group by 1, 2""")
def batch_liquidation_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Liquidations unpacked from batch messages, made of the forced orders, one message a batch of intake."""
    rows = table(spark, folder, "liquidation", "segment_no", "symbol", "event_time", "source_side", "source_quantity", "source_price", "received_at", "ingest_seq").filter("event_time is not null and source_quantity is not null")
    item = F.struct(F.expr("unix_micros(event_time) div 1000").alias("T"), F.col("symbol").alias("s"), F.initcap("source_side").alias("S"), F.col("source_quantity").alias("v"), F.col("source_price").alias("p"))
    chunk = F.expr("ingest_seq div 50")
    envelopes = rows.groupBy("segment_no", "symbol", chunk.alias("c")).agg(F.collect_list(item).alias("data"), F.max("received_at").alias("received_at"))
    named = envelopes.select(F.concat_ws("-", "segment_no", "symbol", "c").alias("envelope_id"), "received_at", F.to_json(F.struct(F.concat(F.lit("allLiquidation."), "symbol").alias("topic"), "data")).alias("payload")).withColumn("message_id", F.sha2("payload", 256))
    made = normalize.liquidation_batches(named)
    return made.groupBy("symbol", F.col("position_side_liquidated").alias("side")).agg(F.count(F.lit(1)).alias("rows"), dbl(F.sum("quantity"), 5).alias("quantity"), F.min(F.unix_millis("event_time")).alias("first_ms"))


@query("""with e as (select *, try_cast(source_quantity as decimal(38,18)) as q, try_cast(last_filled_quantity as decimal(38,18)) as l, try_cast(accumulated_filled_quantity as decimal(38,18)) as z from liquidation where event_time is not null and received_at is not null)
  select symbol, source_side, count(*) as rows, count(*) filter (not coalesce(l <= z and z <= q, false)) as relation, count(*) filter (epoch_us(event_time) // 1000 * 1000 > epoch_us(received_at) + 300000000) as future, 'UNKNOWN' as side from e group by 1, 2""")
def forced_order_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Forced orders unpacked from single-order messages: relations and future stamps are flagged, the liquidated side is never inferred."""
    rows = table(spark, folder, "liquidation", "ingest_seq", "symbol", "event_time", "received_at", "source_side", "source_quantity", "last_filled_quantity", "accumulated_filled_quantity", "source_price", "average_fill_price").filter("event_time is not null and received_at is not null")
    names = {"s": "symbol", "S": "source_side", "q": "source_quantity", "l": "last_filled_quantity", "z": "accumulated_filled_quantity", "p": "source_price", "ap": "average_fill_price"}
    pairs = [p for k, c in names.items() for p in (F.lit(k), F.col(c))] + [F.lit("T"), F.expr("cast(unix_micros(event_time) div 1000 as string)")]
    payload = F.concat(F.lit('{"e":"forceOrder","E":0,"o":'), F.to_json(F.create_map(*pairs)), F.lit("}"))
    made = normalize.forced_orders(rows.select(F.col("ingest_seq").cast("string").alias("envelope_id"), "received_at", payload.alias("payload")))
    flagged = lambda f: F.count_if(F.array_contains("dq_flags", f))
    return made.groupBy("symbol", "source_side").agg(F.count(F.lit(1)).alias("rows"), flagged("QUANTITY_RELATION").alias("relation"), flagged("FUTURE_TIMESTAMP").alias("future"), F.max("position_side_liquidated").alias("side"))


@query("""with d as (select *, ingest_seq % 5 = 0 as strange, case when ingest_seq % 7 = 0 then 'Hold' when source_side = 'BUY' then 'Buy' when source_side = 'SELL' then 'Sell' else source_side end as side, try_cast(source_quantity as decimal(38,18)) as q, try_cast(source_price as decimal(38,18)) as p from liquidation),
  r as (select 'batch' as kind, unnest(list_filter([case when strange or symbol is null then 'topic' end, case when not coalesce(side in ('Buy', 'Sell'), false) then 'side' end, case when not coalesce(q > 0, false) then 'quantity' end, case when not coalesce(p > 0, false) then 'price' end, case when event_time is null then 'time' end], lambda x: x is not null)) as rule from d
    union all select 'order', unnest(list_filter([case when symbol is null or symbol = '' then 'symbol' end, case when not coalesce(case when ingest_seq % 7 = 0 then 'HOLD' else source_side end in ('BUY', 'SELL'), false) then 'side' end, case when event_time is null then 'time' end, case when source_quantity is not null and not coalesce(q > 0, false) then 'quantity' end, case when source_price is not null and not coalesce(p > 0, false) then 'price' end], lambda x: x is not null)) from d
    union all select 'funding', unnest(list_filter([case when strange or symbol is null then 'symbol' end, case when event_time is null then 'time' end, case when p is null then 'rate' end], lambda x: x is not null)) from d)
  select kind, rule, count(*) as rows from r group by 1, 2""")
def message_rule_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What messages of three kinds break, every fifth one sent under another's name and every seventh without a side."""
    rows = table(spark, folder, "liquidation", "ingest_seq", "symbol", "event_time", "source_side", "source_quantity", "source_price", "received_at")
    seq, ms = F.col("ingest_seq"), F.expr("cast(unix_micros(event_time) div 1000 as string)")
    kept = {"ignoreNullFields": "false"}
    topic = F.concat(F.lit("allLiquidation."), F.when(seq % 5 == 0, "OTHER").otherwise(F.col("symbol")))
    item = F.struct(ms.alias("T"), F.col("symbol").alias("s"), F.when(seq % 7 == 0, "Hold").otherwise(F.initcap("source_side")).alias("S"), F.col("source_quantity").alias("v"), F.col("source_price").alias("p"))
    batch = rows.select(seq.cast("string").alias("envelope_id"), seq.cast("string").alias("message_id"), "received_at", F.to_json(F.struct(F.coalesce(topic, F.lit("none")).alias("topic"), F.array(item).alias("data")), kept).alias("payload"))
    order = rows.select("symbol", F.when(seq % 7 == 0, "HOLD").otherwise(F.col("source_side")).alias("source_side"), "event_time", "source_quantity", "source_price")
    asked = rows.select(F.when(seq % 5 == 0, "OTHER").otherwise(F.coalesce("symbol", F.lit("?"))).alias("asked"), "symbol", ms.alias("fundingTime"), F.col("source_price").alias("fundingRate"))
    points = normalize.funding_rates(asked, keep=["asked"])
    counted = lambda df, kind, rules: df.select(F.lit(kind).alias("kind"), F.explode(quality.violations(rules)).alias("rule"))
    every = counted(normalize.liquidation_batches(batch), "batch", normalize.batch_rules()).unionByName(counted(order, "order", normalize.order_rules())).unionByName(counted(points, "funding", normalize.funding_rules(F.col("asked"))))
    return every.groupBy("kind", "rule").agg(F.count(F.lit(1)).alias("rows"))


@query("""select source, count(*) as envelopes, count(distinct sha256(payload)) as message_ids from ws_envelope group by 1""")
def envelope_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Raw messages as envelopes, with the hashes of their text and of their sorted form."""
    made = normalize.envelopes(table(spark, folder, "ws_envelope", "source", "payload", "received_at"))
    return made.groupBy("source").agg(F.count("payload_hash").alias("envelopes"), F.count_distinct("message_id").alias("message_ids"))


# Archives and pages -----------------------------------------------------------------------


def _write_archives(rows: DataFrame, by: str, root: str, suffix: str, member: str, header: str | None = None, checksum: bool = True) -> DataFrame:
    """Write the rows' column ``line``, in the order of ``at``, as one ZIP (or gzip) file with a checksum per ``by``; (name) of each.

    For the test data only, which has the rows but no archives: a group is one archive.
    """
    target = root

    def write(part: pa.Table) -> pa.Table:
        import gzip
        import hashlib

        fs, base = file_system(target)
        name = part.column(by)[0].as_py()
        lines = part.sort_by([("at", "ascending"), ("line", "ascending")]).column("line").to_pylist()
        text = "\n".join([*([header] if header else []), *lines, ""]).encode()
        out = io.BytesIO()
        if suffix == ".zip":
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr(f"{name}-{member}.csv", text)
        else:
            out.write(gzip.compress(text, mtime=0))
        fs.create_dir(base)
        for end, content in ((suffix, out.getvalue()), *(((f"{suffix}.CHECKSUM", f"{hashlib.sha256(out.getvalue()).hexdigest()}  {name}{suffix}\n".encode()),) if checksum else ())):
            with fs.open_output_stream(f"{base}/{name}{end}", compression=None) as f:
                f.write(content)
        return pa.table({"name": [name]})

    return rows.select(by, "at", "line").groupBy(by).applyInArrow(write, "name string")


@query("""with c as (select instrument_id, count(*) as rows, round(cast(sum(close_price) as double), 4) as close, min(epoch_us(open_time) // 1000) as first_ms, count(*) as lines from ohlcv_candle group by 1) select c.*, 'ok' as state from c""")
def kline_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Candle archives written, verified against their checksums, read as a stream and typed."""
    root = scratch(spark, "klines")
    rows = _texts(table(spark, folder, "ohlcv_candle"))
    lines = rows.select("instrument_id", F.col("c0").cast("bigint").alias("at"), F.concat_ws(",", *(F.coalesce(F.col(f"c{i}"), F.lit("")) for i in range(12))).alias("line"))
    keep(_write_archives(lines, "instrument_id", root, ".zip", "1m-2021-03"), "written")
    read = archives.zip_csv(spark, f"{root}/*.zip", [f"c{i}" for i in range(12)], r"ins_[0-9a-f]+-1m-2021-03\.csv")
    name = F.regexp_extract("path", r"(ins_[0-9a-f]+)\.zip", 1)
    totals = normalize.kline_rows(read.withColumn("instrument_id", name), "ms").groupBy("instrument_id").agg(F.count(F.lit(1)).alias("rows"), dbl(F.sum("close"), 4).alias("close"), F.min(F.unix_millis("open_time")).alias("first_ms"), (F.max("ordinal") + 1).alias("lines"))
    checked = archives.verified(spark, root).select(name.alias("instrument_id"), "state")
    return keep(totals.join(checked, "instrument_id"), "klines")


@query(TRADES_SQL + """ select instrument_id, count(*) as rows, round(cast(sum(quantity) as double), 5) as quantity, count(*) filter (side = 'SELL') as sells, min(epoch_us(event_time)) as first_us, count(*) as last_ordinal from t group by 1""")
def trade_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Trade archives with a mandatory header written, read as a stream and typed; ordinals start behind the header."""
    root = scratch(spark, "trades")
    columns = ["id", "price", "qty", "quote_qty", "time", "is_buyer_maker", "is_best_match"]
    lines = _trade_texts(spark, folder).select("instrument_id", F.col("time").cast("bigint").alias("at"), F.concat_ws(",", *(F.coalesce(F.col(c), F.lit("")) for c in columns)).alias("line"))
    keep(_write_archives(lines, "instrument_id", root, ".zip", "trades-2021-03-01", ",".join(columns)), "written")
    read = archives.zip_csv(spark, f"{root}/*.zip", columns, header="mandatory").withColumn("instrument_id", F.regexp_extract("path", r"(ins_[0-9a-f]+)\.zip", 1))
    made = normalize.archive_trades(read, "us", strict=True)
    return keep(made.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("rows"), dbl(F.sum("quantity"), 5).alias("quantity"), F.count_if(F.col("taker_side") == "SELL").alias("sells"), F.min(F.unix_micros("event_time")).alias("first_us"), F.max("ordinal").alias("last_ordinal")), "trades")


@query("""select instrument_id, count(*) as rows, round(cast(sum(case when try_cast(quantity as decimal(38,18)) > 0 then try_cast(quantity as decimal(38,18)) end) as double), 5) as quantity from ws_trade where instrument_id is not null group by 1""")
def gzip_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The other venue's gzip archives written, read by their header and typed."""
    root = scratch(spark, "gzip")
    columns = ["timestamp", "symbol", "side", "size", "price", "trdMatchID"]
    rows = table(spark, folder, "ws_trade", "instrument_id", F.col("event_time_ms").cast("string").alias("timestamp"), F.col("native_symbol").alias("symbol"), F.col("taker_side").alias("side"), F.col("quantity").alias("size"), "price", F.col("native_trade_id").alias("trdMatchID")).filter("instrument_id is not null")
    quoted = lambda c: F.concat(F.lit('"'), F.regexp_replace(F.coalesce(F.col(c), F.lit("")), '"', '""'), F.lit('"'))
    lines = rows.select("instrument_id", F.lit(0).cast("bigint").alias("at"), F.concat_ws(",", *map(quoted, columns)).alias("line"))
    keep(_write_archives(lines, "instrument_id", root, ".csv.gz", "", ",".join(columns), checksum=False), "written")
    read = archives.gzip_csv(spark, f"{root}/*.csv.gz", columns).withColumn("instrument_id", F.regexp_extract("path", r"(ins_[0-9a-f]+)\.csv", 1))
    made = normalize.venue_trades(read, keep=["instrument_id"])
    return keep(made.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("rows"), dbl(F.sum("quantity"), 5).alias("quantity")), "gzip")


@query("""select source, count(*) as rows, count(distinct envelope_id) as envelopes, cast(sum(length(payload)) as bigint) as characters from ws_envelope group by 1""")
def json_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Raw messages written as a log of JSON lines and read by a declared schema."""
    root = scratch(spark, "log")
    table(spark, folder, "ws_envelope", "source", "envelope_id", "payload").write.option("ignoreNullFields", "false").json(root)
    read = archives.json_lines(spark, root, "source string, envelope_id string, payload string").filter("_corrupt_record is null")
    return keep(read.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("envelope_id").alias("envelopes"), F.sum(F.char_length("payload")).alias("characters")), "log")


@query("""with m as (select unnest(['forward', 'backward', 'cursor']) as mode) select mode, ingest_seq as time_ms, source_price as price from liquidation, m""")
def paged_records(spark: SparkSession, folder: str) -> DataFrame:
    """All forced orders recorded as an API's pages and read back page by page, forwards, backwards and by cursor."""
    root = scratch(spark, "pages")
    rows = table(spark, folder, "liquidation", "ingest_seq", "source_price")
    record = F.struct(F.col("ingest_seq").cast("string").alias("id"), F.col("source_price").alias("p"))
    page = rows.groupBy(F.expr("ingest_seq div 500").alias("n")).agg(F.collect_list(record).alias("list")).select("n", F.to_json(F.struct("list"), {"ignoreNullFields": "false"}).alias("value"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = file_system(root)
        fs.create_dir(base)
        for b in batches:
            for n, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with fs.open_output_stream(f"{base}/{n:08d}.json") as f:
                    f.write(value.encode())
            yield pa.RecordBatch.from_arrays([b.column(0)], names=["n"])

    keep(page.mapInArrow(write, "n bigint"), "pages")
    low, high = rows.agg(F.min("ingest_seq"), F.max("ingest_seq")).first()
    pages.register(spark)
    parts = None
    for mode in ("forward", "backward", "cursor"):
        options = {"path": root, "start_ms": str(low or 0), "end_ms": str((high or 0) + 1), "slices": "8", "limit": "97", "mode": mode, "time_field": "id"}
        one = spark.read.format("recorded_pages").options(**options).load().select(F.lit(mode).alias("mode"), "time_ms", F.get_json_object("record", "$.p").alias("price"))
        parts = one if parts is None else parts.unionByName(one)
    return parts


@query("""select raw_object_ref as ref, count(*) as rows, arg_min(native_trade_id, source_ordinal) as first_id, arg_max(native_trade_id, source_ordinal) as last_id, min(source_ordinal) as first_ordinal, max(source_ordinal) as last_ordinal from (select distinct on (raw_object_ref, source_ordinal) * from archive_trade order by raw_object_ref, source_ordinal, native_trade_id) where raw_object_ref is not null group by 1""")
def edge_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The first and last row of every stored file."""
    rows = table(spark, folder, "archive_trade", "raw_object_ref", "source_ordinal", "native_trade_id").filter("raw_object_ref is not null")
    one = rows.groupBy("raw_object_ref", "source_ordinal").agg(F.min("native_trade_id").alias("id"))
    return one.groupBy(F.col("raw_object_ref").alias("ref")).agg(F.count(F.lit(1)).alias("rows"), F.min_by("id", "source_ordinal").alias("first_id"), F.max_by("id", "source_ordinal").alias("last_id"), F.min("source_ordinal").alias("first_ordinal"), F.max("source_ordinal").alias("last_ordinal"))


# Sinks ------------------------------------------------------------------------------------


@query("""with d as (select coalesce(try_cast(source_quantity as decimal(38,18)) > 0.1, false) as good, * from liquidation), g as (select instrument_id, count(*) as k from (select distinct instrument_id, ingest_seq from d where good) group by 1)
  select 'accepted' as what, cast(sum(k) as bigint) as rows from g union all select 'quarantined', count(*) from d where not good union all select 'added', cast(sum(k) as bigint) from g union all select 'added again', 0 union all select 'stored', cast(sum(k) as bigint) from g union all select 'events', 1""")
def pipeline_runs(spark: SparkSession, folder: str) -> DataFrame:
    """A pipeline run over all forced orders, and the same run again, which changes nothing."""
    root = scratch(spark, "pipeline")
    rows = table(spark, folder, "liquidation", "instrument_id", "ingest_seq", "source_quantity", "event_time", "dedup_fingerprint")
    log = publish.EventLog(spark, f"{root}/events", "event_id string, source_dataset_id string, row_count bigint", "event_id")
    rules = {"large": F.expr("try_cast(source_quantity as decimal(38,18)) > 0.1")}
    run = lambda: publish.ingest(rows, root, rules, ["instrument_id", "ingest_seq"], F.pmod(F.col("ingest_seq"), F.lit(4)), log, {"source_dataset_id": "orders"})
    one, two = run(), run()
    stored = publish.GenerationTable(spark, f"{root}/data", rows.schema).read().count()
    found = [("accepted", one.accepted), ("quarantined", one.quarantined), ("added", one.added), ("added again", two.added), ("stored", stored), ("events", log.read().count())]
    return spark.createDataFrame(found, "what string, rows bigint")


@query("""with b as (select count(*) as n from lineitem) select 'rows' as what, n as value from b union all select 'files of too many rows', 0""")
def bounded_files(spark: SparkSession, folder: str) -> DataFrame:
    """Rows written to files of bounded size, and read again."""
    target = f"{scratch(spark, 'bounded')}/data"
    count = publish.write_rows(table(spark, folder, "lineitem"), target, 1000, ["l_orderkey", "l_linenumber"])
    sizes = spark.read.parquet(target).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.count(F.lit(1)).alias("n"))
    return spark.createDataFrame([("rows", count), ("files of too many rows", sizes.filter("n > 1000").count())], "what string, value bigint")


# Texts of logs ----------------------------------------------------------------------------


@query("""select lang, coalesce(case l when 'en' then 'report' when 'de' then 'Bericht' when 'es' then 'informe' when 'ru' then 'отчёт' end, 'report') as title, count(*) as texts from (select lang, lower(regexp_extract(coalesce(lang, ''), '^[A-Za-z]+')) as l from documents) group by 1, 2""")
def located_titles(spark: SparkSession, folder: str) -> DataFrame:
    """A message in each text's language, or the fallback's."""
    messages = spark.createDataFrame([("en", "title", "report"), ("de", "title", "Bericht"), ("es", "title", "informe"), ("ru", "title", "отчёт")], "locale string, key string, template string")
    rows = table(spark, folder, "documents", "lang").withColumns({"locale": F.lower(F.regexp_extract(F.coalesce("lang", F.lit("")), "^[A-Za-z]+", 0)), "key": F.lit("title")})
    return scalars.located(rows, messages, "en").groupBy("lang", F.col("message").alias("title")).agg(F.count(F.lit(1)).alias("texts"))


@query("""select envelope_id, '{"level":"INFO","component":"' || source || '","event":"message","at":' || epoch_us(received_at) || ',"session_id":"' || session_id || '"}' as line from ws_envelope where source is not null and received_at is not null and session_id is not null""")
def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Log events as JSON with fixed fields in a fixed order."""
    rows = table(spark, folder, "ws_envelope", "envelope_id", "source", "received_at", "session_id").filter("source is not null and received_at is not null and session_id is not null")
    fields = {"level": F.lit("INFO"), "component": F.col("source"), "event": F.lit("message"), "at": F.unix_micros("received_at"), "session_id": F.col("session_id")}
    return rows.select("envelope_id", scalars.log_line(fields).alias("line"))


@query("""select instrument_id, count(*) as messages, count(*) filter (payload like '%"p":"%') as with_price, 0 as shown from ws_envelope group by 1""")
def redacted_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """Payloads with every price masked, and how many still show one."""
    rows = table(spark, folder, "ws_envelope", "instrument_id", "payload").withColumn("masked", scalars.redacted(F.col("payload"), ["p"]))
    return rows.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("messages"), F.count_if(F.col("masked").contains('"p":"***"')).alias("with_price"), F.count_if(F.col("masked").rlike(r'"p":"[0-9]')).alias("shown"))


@query("""select i as attempt, round(least(60.0, power(2.0, i - 1)), 4) as plain, true as within from (select unnest(generate_series(1, 12)) as i)""")
def backoff_waits(spark: SparkSession, folder: str) -> DataFrame:
    """Waits before twelve attempts, which the seed's jitter moves by a fifth at most."""
    waits = spark.range(1, 13).select(F.col("id").alias("attempt"), F.round(F.least(F.lit(60.0), F.pow(F.lit(2.0), F.col("id") - 1)), 4).alias("plain"), gapstates.backoff_seconds(F.col("id"), seed=7).alias("wait"))
    return waits.select("attempt", "plain", F.col("wait").between(F.col("plain") * 0.8 - 0.0001, F.col("plain") * 1.2 + 0.0001).alias("within"))


# Scalars ----------------------------------------------------------------------------------


@query("""select instrument_id, count(*) as rows, cast(sum(event_time_ms * 1000) as hugeint)::varchar as total_us, count(*) filter (event_time_ms is null) as unknown from ws_trade group by 1""")
def fractional_seconds(spark: SparkSession, folder: str) -> DataFrame:
    """Times written as fractional seconds, read without passing through binary floats."""
    rows = table(spark, folder, "ws_trade", "instrument_id", "event_time_ms")
    text = F.concat(F.expr("event_time_ms div 1000").cast("string"), F.lit("."), F.lpad((F.col("event_time_ms") % 1000).cast("string"), 3, "0"))
    us = scalars.float_seconds_us(text)
    return rows.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("rows"), F.sum(us.cast("decimal(38,0)")).cast("string").alias("total_us"), F.count_if(us.isNull()).alias("unknown"))


@query("""select case when o_orderdate >= date '1995-01-01' then 'us' else 'ms' end as unit, count(*) as orders from orders group by 1""")
def archive_units(spark: SparkSession, folder: str) -> DataFrame:
    """The unit of an archive by its day, the switch set within the data's time."""
    return table(spark, folder, "orders", "o_orderdate").groupBy(scalars.archive_unit(F.col("o_orderdate"), "1995-01-01").alias("unit")).agg(F.count(F.lit(1)).alias("orders"))


@query(r"""with t as (select source, nullif(regexp_replace(text, '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'), '') as t from documents) select source, count(t) as texts, count(*) - count(t) as blank from t group by 1""")
def blank_texts(spark: SparkSession, folder: str) -> DataFrame:
    text = scalars.text_or_null(F.col("text"))
    return table(spark, folder, "documents", "source", "text").groupBy("source").agg(F.count(text).alias("texts"), F.count_if(text.isNull()).alias("blank"))


@query("""select exchange, count(distinct coalesce(native_trade_id, cast(source_ordinal as varchar))) as keys from archive_trade group by 1""")
def natural_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The natural key under the first of its names that has a value."""
    rows = table(spark, folder, "archive_trade", "exchange", "native_trade_id", "source_ordinal")
    return rows.groupBy("exchange").agg(F.count_distinct(reconcile.natural_key(["aggregate_trade_id", "native_trade_id", "source_ordinal"], rows.columns)).alias("keys"))


@query("""select case when order_status = 'PARTIALLY_FILLED' then 'PARTIAL_TRUNCATED_BY_PAGE_LIMIT' when source_side = 'BUY' then 'COMPLETE_OFFICIAL_WINDOW' else 'COMPLETE' end as coverage, count(*) as rows from liquidation group by 1""")
def coverage_states(spark: SparkSession, folder: str) -> DataFrame:
    """What is known of a range from why its paging ended."""
    reason = F.when(F.col("order_status") == "PARTIALLY_FILLED", pages.PAGE_LIMIT_REACHED).otherwise(pages.SOURCE_EMPTY)
    return table(spark, folder, "liquidation", "order_status", "source_side").groupBy(merge.coverage_status(reason, F.coalesce(F.col("source_side") == "BUY", F.lit(False))).alias("coverage")).agg(F.count(F.lit(1)).alias("rows"))


@query("""with i as (select distinct exchange, market_type, contract_type, native_symbol as s from archive_trade) select exchange, market_type, s as native_symbol, 'ins_' || left(sha256('{"base_asset":"' || left(s, -4) || '","contract_type":"' || contract_type || '","exchange":"' || exchange || '","expiry":null,"market_type":"' || market_type || '","native_symbol":"' || s || '","quote_asset":"USDT","settle_asset":' ||
  case when market_type = 'spot' then 'null' else '"USDT"' end || ',"venue_environment":"production"}'), 20) as identity from i""")
def instrument_identities(spark: SparkSession, folder: str) -> DataFrame:
    """Surrogate ids of all instruments, from fields written in other letter cases."""
    rows = table(spark, folder, "archive_trade", "exchange", "market_type", "contract_type", "native_symbol").distinct()
    base = F.expr("substring(native_symbol, 1, length(native_symbol) - 4)")
    made = scalars.instrument_id(F.upper("exchange"), F.lower("native_symbol"), F.col("market_type"), F.upper("contract_type"), F.concat(F.lit(" "), F.lower(base)), F.lit("usdt"), F.when(F.col("market_type") != "spot", F.lit("usdt")))
    return rows.select("exchange", "market_type", "native_symbol", made.alias("identity"))


@query("""select schema_version, count(*) as records, count(*) filter (split_part(schema_version, '.', 1) = '1') as compatible from active_artifact group by 1""")
def compatible_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Records whose schema version shares its major part with 1.9.0."""
    rows = table(spark, folder, "active_artifact", "schema_version")
    return rows.groupBy("schema_version").agg(F.count(F.lit(1)).alias("records"), F.count_if(scalars.compatible(F.col("schema_version"), F.lit("1.9.0"))).alias("compatible"))
