"""Queries for the engine's market-data operators, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions import normalize, scalars
from marlstone.operators import asof, audit, buckets, features, merge, quality, reconcile, retention, sequence
from marlstone.plans.registry import Registry
from marlstone.session import scratch
from marlstone.sources.tables import table
from marlstone.streaming import jobs

registry = Registry()
query, QUERIES, ORACLE = registry.query, registry.queries, registry.sql
HOUR = 3600


def dbl(c: str | Column, digits: int = 6) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), digits)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: dbl(c, digits) for c in columns})


# Trades -----------------------------------------------------------------------------------

TAPE = """tape as (select instrument_id, native_trade_id, min(source_ordinal) as source_ordinal, min(epoch_us(event_time)) as event_us, min(price) as price,
  min(quantity) as quantity, min(upper(coalesce(taker_side, 'UNKNOWN'))) as side from archive_trade group by 1, 2)"""


def tape(spark: SparkSession, folder: str) -> DataFrame:
    """Every archived trade once."""
    rows = table(spark, folder, "archive_trade", "instrument_id", "native_trade_id", "source_ordinal", "event_time", "price", "quantity", "taker_side")
    side = F.min(F.upper(F.coalesce("taker_side", F.lit("UNKNOWN")))).alias("side")
    return rows.groupBy("instrument_id", "native_trade_id").agg(F.min("source_ordinal").alias("source_ordinal"), F.min(F.unix_micros("event_time")).alias("event_us"), F.min("price").alias("price"), F.min("quantity").alias("quantity"), side)


def _bucket_sql(seconds: int, start: str = "event_us - event_us % {s}000000") -> str:
    at = start.replace("{s}", str(seconds))
    return f"""with {TAPE}, b as (select *, {at} as bucket_start_us, (event_us, source_ordinal, native_trade_id) as o, price * quantity as quote,
      cast(price as double) as p, cast(quantity as double) as q from (select * replace (cast(price as decimal(19,9)) as price, cast(quantity as decimal(19,9)) as quantity) from tape))
    select instrument_id, bucket_start_us, count(*) as trade_count, count(*) filter (side = 'BUY') as buy_count, count(*) filter (side = 'SELL') as sell_count,
      round(arg_min(p, o), 6) as open, round(max(p), 6) as high, round(min(p), 6) as low, round(arg_max(p, o), 6) as close, round(cast(sum(quantity) as double), 6) as base_volume,
      cast(cast(sum(quote) as decimal(38,10)) as varchar) as quote_volume, round(coalesce(cast(sum(quantity) filter (side = 'BUY') as double), 0) - coalesce(cast(sum(quantity) filter (side = 'SELL') as double), 0), 6) as base_delta,
      round(max(q), 6) as max_size from b group by 1, 2"""


BUCKET_COLUMNS = ("instrument_id", "bucket_start_us", "trade_count", "buy_count", "sell_count", "open", "high", "low", "close", "base_volume", "quote_volume", "base_delta", "max_size")


def _shown(df: DataFrame) -> DataFrame:
    numbers = ("open", "high", "low", "close", "base_volume", "base_delta", "max_size")
    exact = F.col("quote_volume").cast("decimal(38,10)").cast("string")  # products have at most ten decimals
    return rounded(df.select(*BUCKET_COLUMNS), *numbers).withColumn("quote_volume", exact)


def _grain(seconds: int) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: _shown(buckets.trade_buckets(tape(spark, folder), ["instrument_id"], [seconds]))


for _s in buckets.GRAINS:
    QUERIES[f"trade_bucket_{_s}s"] = _grain(_s)
    ORACLE[f"trade_bucket_{_s}s"] = _bucket_sql(_s)


@query(_bucket_sql(HOUR))
def bucket_rollup_1h(spark: SparkSession, folder: str) -> DataFrame:
    """Hours rolled up from one-minute buckets."""
    return _shown(buckets.rollup(buckets.trade_buckets(tape(spark, folder), ["instrument_id"], [60]), ["instrument_id"], HOUR))


UNITS_SQL = """cast({x} // 1000000000000000000 as varchar) || '.' || lpad(cast({x} % 1000000000000000000 as varchar), 18, '0')"""


@query(f"""with {TAPE}, h as (select instrument_id, event_us - event_us % 3600000000 as bucket_start_us, list_sort(list(cast(cast(quantity as decimal(19,9)) * 1000000000 as hugeint) * 1000000000)) as a from tape group by 1, 2),
  s as (select *, len(a) as n, a[(len(a) + 1) // 2] + a[len(a) // 2 + 1] as m, list_sum(a) as t from h),
  r as (select instrument_id, bucket_start_us, n as trade_count, m // 2 + case when m % 2 = 1 and m // 2 % 2 = 1 then 1 else 0 end as m, cast(t as hugeint) // n + case when 2 * (cast(t as hugeint) % n) > n or 2 * (cast(t as hugeint) % n) = n and cast(t as hugeint) // n % 2 = 1 then 1 else 0 end as a from s)
  select instrument_id, bucket_start_us, trade_count, {UNITS_SQL.replace("{x}", "m")} as median_size, {UNITS_SQL.replace("{x}", "a")} as avg_size from r""")
def bucket_sizes_1h(spark: SparkSession, folder: str) -> DataFrame:
    """Exact median and mean trade size per hour, to 18 digits."""
    made = buckets.trade_buckets(tape(spark, folder), ["instrument_id"], [HOUR], median=True)
    return made.select("instrument_id", "bucket_start_us", "trade_count", F.col("median_size").cast("string").alias("median_size"), F.col("avg_size").cast("string").alias("avg_size"))


@query(f"""with {TAPE} select instrument_id, count(*) as trades, round(cast(sum(quantity) as double), 6) as base, true as conserved from tape group by 1""")
def bucket_conservation(spark: SparkSession, folder: str) -> DataFrame:
    """What the buckets hold against what the tape holds."""
    rows = tape(spark, folder)
    held = buckets.trade_buckets(rows, ["instrument_id"], [60]).groupBy("instrument_id").agg(F.sum("trade_count").alias("t"), F.sum("base_volume").alias("b"))
    whole = rows.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("trades"), F.sum("quantity").alias("base"))
    return whole.join(held, "instrument_id").select("instrument_id", "trades", dbl("base").alias("base"), ((F.col("t") == F.col("trades")) & (F.col("b") == F.col("base"))).alias("conserved"))


@query("""select instrument_id, count(*) as rows, count(*) filter (event_time is null) as without_time, count(*) filter (not coalesce(upper(taker_side) in ('BUY', 'SELL'), false)) as unknown_side,
  count(*) filter (not coalesce(price > 0 and quantity > 0, false)) as bad_number, count(*) - count(distinct (epoch_us(event_time), source_ordinal, native_trade_id)) as tied_order from archive_trade group by 1""")
def bucket_input_problems(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "archive_trade", "instrument_id", "native_trade_id", "source_ordinal", "event_time", "price", "quantity", "taker_side")
    return buckets.input_problems(rows.withColumns({"event_us": F.unix_micros("event_time"), "side": F.upper("taker_side")}), ["instrument_id"])


@query(f"""with {TAPE}, h as (select instrument_id, event_us - event_us % 3600000000 as bucket_start_us, coalesce(sum(quantity) filter (side = 'BUY'), 0) - coalesce(sum(quantity) filter (side = 'SELL'), 0) as d from tape group by 1, 2)
  select instrument_id, bucket_start_us, round(cast(sum(d) over w as double), 6) as cvd, round(cast(d - lag(d) over w as double), 6) as cvd_acceleration from h window w as (partition by instrument_id order by bucket_start_us)""")
def cumulative_volume_delta(spark: SparkSession, folder: str) -> DataFrame:
    bars = buckets.trade_buckets(tape(spark, folder), ["instrument_id"], [HOUR]).select("instrument_id", "bucket_start_us", "base_delta")
    return rounded(features.cumulative_delta(bars, ["instrument_id"], "bucket_start_us", "base_delta").drop("base_delta"), "cvd", "cvd_acceleration")


@query(f"""with {TAPE}, l as (select instrument_id, quantile_cont(cast(quantity as double), 0.99) as t from tape group by 1)
  select instrument_id, round(t, 6) as threshold, count(*) as large_trades, round(coalesce(sum(cast(quantity as double)) filter (side = 'BUY'), 0), 5) as large_buy,
  round(coalesce(sum(cast(quantity as double)) filter (side = 'SELL'), 0), 5) as large_sell from tape join l using (instrument_id) where cast(quantity as double) >= t group by instrument_id, t""")
def large_trade_delta(spark: SparkSession, folder: str) -> DataFrame:
    flow = features.large_flow(tape(spark, folder), ["instrument_id"], "quantity", "side").drop("large_delta")
    return rounded(rounded(flow, "threshold"), "large_buy", "large_sell", digits=5)


@query(f"""with {TAPE} select instrument_id, side, count(*) as trades, round(cast(sum(case side when 'BUY' then quantity when 'SELL' then -quantity else 0 end) as double), 6) as signed_quantity from tape group by 1, 2""")
def signed_volume(spark: SparkSession, folder: str) -> DataFrame:
    signed = scalars.signed(F.col("quantity"), F.col("side"))
    return tape(spark, folder).groupBy("instrument_id", "side").agg(F.count(F.lit(1)).alias("trades"), dbl(F.sum(signed)).alias("signed_quantity"))


# Scalars ----------------------------------------------------------------------------------


@query("""select instrument_id, native_trade_id, count(*) as copies, min(case source_timestamp_unit when 'ms' then source_timestamp * 1000 when 'us' then source_timestamp end) as epoch_us,
  min(epoch_us(event_time) - epoch_us(event_time) % 5000000) as bucket_us, min(coalesce(upper(trim(taker_side)), 'UNKNOWN')) as side from archive_trade group by 1, 2""")
def epoch_and_side(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "archive_trade", "instrument_id", "native_trade_id", "event_time", "source_timestamp", "source_timestamp_unit", "taker_side")
    return rows.groupBy("instrument_id", "native_trade_id").agg(
        F.count(F.lit(1)).alias("copies"), F.min(F.unix_micros(scalars.epoch_by_unit(F.col("source_timestamp"), F.col("source_timestamp_unit")))).alias("epoch_us"),
        F.min(scalars.floor_us(F.unix_micros("event_time"), 5)).alias("bucket_us"), F.min(scalars.taker_side(F.col("taker_side"))).alias("side"),
    )


@query("""select taker_side, count(*) as rows, count(try_cast(price as decimal(38,18))) as numbers, count(*) filter (try_cast(quantity as decimal(38,18)) > 0) as positive,
  count(*) filter (lower(native_trade_id) = trim(native_trade_id)) as plain_ids from ws_trade group by 1""")
def lenient_numbers(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "ws_trade", "native_trade_id", "price", "quantity", "taker_side")
    return rows.groupBy("taker_side").agg(
        F.count(F.lit(1)).alias("rows"), F.count(scalars.number(F.col("price"))).alias("numbers"), F.count(scalars.positive(F.col("quantity"))).alias("positive"),
        F.count_if(F.lower("native_trade_id") == F.trim("native_trade_id")).alias("plain_ids"),
    )


@query("""select distinct instrument_id, 'key_' || left(sha256('{"exchange":"' || exchange || '","market_type":"' || market_type || '","native_symbol":"' || native_symbol || '","settle_asset":null}'), 20) as stable_id,
  sha256(exchange || '|' || market_type || '|' || native_symbol) as fingerprint from archive_trade""")
def stable_ids(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "archive_trade", "instrument_id", "exchange", "market_type", "native_symbol").distinct()
    fields = {c: F.col(c) for c in ("exchange", "market_type", "native_symbol")}
    return rows.select("instrument_id", scalars.stable_id("key_", fields | {"settle_asset": F.lit(None).cast("string")}).alias("stable_id"), scalars.fingerprint(list(fields.values())).alias("fingerprint"))


# The classes that occur in the test tables, their names and marks.
CLASS_ALIASES = {"individual_trade": "individual_trade", "ohlcv": "ohlcv", "trade_bucket": "derived_trade_bucket", "derived_trade_bucket": "derived_trade_bucket", "liquidation": "liquidations", "liquidations": "liquidations", "open_interest": "open_interest"}
CLASS_PATTERNS = [("individual_trade", "individual_trade"), ("bucket", "derived_trade_bucket"), ("ohlcv", "ohlcv"), ("liquidation", "liquidations"), ("open_interest", "open_interest")]
PLAIN_SQL = r"regexp_replace(regexp_replace(replace(relative_path, '\', '/'), '/+', '/', 'g'), '^(\./)+', '')"


@query(f"""with p as (select dataset_class as declared, {PLAIN_SQL} as path, epoch_us(published_at) as seen, schema_version from active_artifact),
  c as (select *, coalesce(case lower(trim(declared)) when 'individual_trade' then 'individual_trade' when 'ohlcv' then 'ohlcv' when 'trade_bucket' then 'derived_trade_bucket' when 'derived_trade_bucket' then 'derived_trade_bucket'
    when 'liquidation' then 'liquidations' when 'liquidations' then 'liquidations' when 'open_interest' then 'open_interest' end,
    case when path like '%individual_trade%' then 'individual_trade' when path like '%bucket%' then 'derived_trade_bucket' when path like '%ohlcv%' then 'ohlcv' when path like '%liquidation%' then 'liquidations' when path like '%open_interest%' then 'open_interest' end) as class from p)
  select class, regexp_extract(path, 'date=([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1) as day, count(*) as records, count(distinct path) as paths, max(seen) as last_us, cast(max(split_part(schema_version, '.', 1)) as integer) as major from c group by 1, 2""")
def dataset_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest records by inferred class and the day their paths speak of."""
    from marlstone.operators.compaction import plain_path

    rows = table(spark, folder, "active_artifact", "dataset_class", "relative_path", "published_at", "schema_version").withColumn("path", plain_path(F.col("relative_path")))
    day = F.coalesce(F.date_format(scalars.path_time(F.regexp_extract("path", "(.*/)", 1)), "yyyy-MM-dd"), F.lit(""))
    kind = scalars.dataset_class(F.col("dataset_class"), F.col("path"), CLASS_ALIASES, CLASS_PATTERNS)
    return rows.groupBy(kind.alias("class"), day.alias("day")).agg(F.count(F.lit(1)).alias("records"), F.count_distinct("path").alias("paths"), F.max(F.unix_micros("published_at")).alias("last_us"), F.max(scalars.version_part(F.col("schema_version"), 0)).alias("major"))


# Payloads ---------------------------------------------------------------------------------


@query(r"""with e as (select envelope_id, instrument_id, epoch_ms(received_at) as received_ms, payload::json as j from ws_envelope),
  s as (select instrument_id, j->>'$.e' = 'aggTrade' as agg, coalesce(j->>'$.t', j->>'$.a') as id, j->>'$.p' as p, j->>'$.q' as q, j->>'$.T' as t, case j->>'$.m' when 'true' then 'SELL' when 'false' then 'BUY' else 'UNKNOWN' end as side from e where j->>'$.e' in ('trade', 'aggTrade')),
  b as (select instrument_id, false as agg, d->>'$.i' as id, d->>'$.p' as p, d->>'$.v' as q, d->>'$.T' as t, case upper(trim(d->>'$.S')) when 'BUY' then 'BUY' when 'SELL' then 'SELL' else 'UNKNOWN' end as side from (select instrument_id, unnest(cast(j->'$.data' as json[])) as d from e where j->>'$.e' is null))
  select instrument_id, case when agg then 'exchange_aggregate_trade' else 'individual_trade' end as dataset_class, side as taker_side, count(*) as trades, count(distinct id) as ids, round(cast(sum(try_cast(q as decimal(38,18))) as double), 6) as quantity, min(cast(t as bigint)) as first_ms, max(cast(t as bigint)) as last_ms
  from (select * from s union all select * from b) group by 1, 2, 3""")
def payload_trades(spark: SparkSession, folder: str) -> DataFrame:
    """The trades inside the stream's payloads."""
    raw = table(spark, folder, "ws_envelope", "envelope_id", "instrument_id", "received_at", "payload")
    trades = normalize.stream_trades(raw).join(raw.select("envelope_id", "instrument_id"), "envelope_id")
    ms = F.expr("unix_millis(event_time)")
    return trades.groupBy("instrument_id", "dataset_class", "taker_side").agg(F.count(F.lit(1)).alias("trades"), F.count_distinct("native_trade_id").alias("ids"), dbl(F.sum("quantity")).alias("quantity"), F.min(ms).alias("first_ms"), F.max(ms).alias("last_ms"))


@query("""select source, count(*) as messages, count(*) filter (sha256(payload) = regexp_replace(lower(message_id), '^sha256:', '')) as text_hash_agrees, count(distinct sha256(payload)) as texts from ws_envelope group by 1""")
def envelope_hashes(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "ws_envelope", "source", "payload", "message_id")
    own = F.sha2("payload", 256)
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("messages"), F.count_if(own == F.regexp_replace(F.lower("message_id"), r"\Asha256:", "")).alias("text_hash_agrees"), F.count_distinct(own).alias("texts"))


# Order and gaps ---------------------------------------------------------------------------

MINUTE_SQL = "m as (select distinct instrument_id, epoch_us(open_time) - epoch_us(open_time) % 60000000 as t from ohlcv_candle where candle_interval = '1m' and is_closed)"


def minutes(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "ohlcv_candle", "instrument_id", "candle_interval", "is_closed", "open_time").filter("candle_interval = '1m' and is_closed")
    return rows.select("instrument_id", scalars.floor_us(F.unix_micros("open_time"), 60).alias("t")).distinct()


@query(f"""with {MINUTE_SQL}, l as (select *, lag(t) over (partition by instrument_id order by t) as b from m) select instrument_id, b + 60000000 as gap_start_us, t as gap_end_us, (t - b) // 60000000 - 1 as missing from l where t > b + 60000000""")
def candle_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return sequence.gaps(minutes(spark, folder), ["instrument_id"], "t", 60_000_000)


@query(f"""with {MINUTE_SQL} select instrument_id, t, cast(round_even((t - lag(t) over (partition by instrument_id order by t)) / 60000000.0, 0) as bigint) as interval_minutes from m""")
def observed_intervals(spark: SparkSession, folder: str) -> DataFrame:
    return sequence.intervals(minutes(spark, folder), ["instrument_id"], "t")


@query("""select l_orderkey, l_linenumber, count(*) as copies from lineitem group by 1, 2 having count(*) > 1""")
def natural_key_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return sequence.repeated_keys(table(spark, folder, "lineitem", "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query("""with l as (select instrument_id, ingest_seq, epoch_us(event_time) as t, row_number() over w as place, lag(epoch_us(event_time)) over w as b from liquidation window w as (partition by instrument_id order by ingest_seq))
  select instrument_id, ingest_seq from l where place > 1 and not coalesce(t > b, false)""")
def order_violations(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "liquidation", "instrument_id", "ingest_seq", "event_time")
    return sequence.out_of_order(rows, ["instrument_id"], "ingest_seq", F.unix_micros("event_time")).select("instrument_id", "ingest_seq")


@query("""with t as (select distinct instrument_id, exchange, try_cast(native_trade_id as bigint) as n from archive_trade), w as (select instrument_id, min(try_cast(trim(native_trade_id) as bigint)) - 2 as a, max(try_cast(trim(native_trade_id) as bigint)) + 1 as b from ws_trade group by 1),
  f as (select instrument_id, count(*) as found from t join w using (instrument_id) where n > a and n < b group by 1)
  select instrument_id, coalesce(found, 0) as found, case when b > a then greatest(b - a - 1, 0) end as needed, coalesce(coalesce(found, 0) = case when b > a then greatest(b - a - 1, 0) end, false) as proven from w left join f using (instrument_id)""")
def id_continuity(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the archive proves to hold every id that the stream spans; where ids aren't numbers, nothing is proven."""
    number = lambda c: F.trim(c).try_cast("bigint")
    archive = table(spark, folder, "archive_trade", "instrument_id", "native_trade_id").select("instrument_id", F.col("native_trade_id").try_cast("bigint").alias("n"))
    stream = table(spark, folder, "ws_trade", "instrument_id", "native_trade_id").groupBy("instrument_id").agg((F.min(number("native_trade_id")) - 2).alias("a"), (F.max(number("native_trade_id")) + 1).alias("b"))
    return sequence.continuity(archive, stream, ["instrument_id"], "n", "a", "b")


@query("""select candle_interval, source_method, count(*) as rows, count(*) filter (epoch_us(open_time) % 60000000 <> 0) as misaligned, count(*) filter (not (low_price <= least(open_price, close_price) and high_price >= greatest(open_price, close_price))) as bad_range,
  count(*) filter (taker_buy_base_volume > base_volume) as taker_above_total from ohlcv_candle group by 1, 2""")
def candle_rule_counts(spark: SparkSession, folder: str) -> DataFrame:
    names = {"open_price": "open", "high_price": "high", "low_price": "low", "close_price": "close"}
    rows = table(spark, folder, "ohlcv_candle", "candle_interval", "source_method", "open_time", "close_time", *names, "base_volume", "quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume").withColumnsRenamed(names)
    judged = rows.withColumn("v", quality.violations(normalize.candle_rules()))
    broken = lambda *rules: F.count_if(F.arrays_overlap("v", F.array(*map(F.lit, rules))))
    return judged.groupBy("candle_interval", "source_method").agg(F.count(F.lit(1)).alias("rows"), broken("aligned").alias("misaligned"), broken("low_lowest", "high_highest").alias("bad_range"), broken("taker_base").alias("taker_above_total"))


# Quality ----------------------------------------------------------------------------------

IDENTITY_SQL = "coalesce(exchange, 'UNKNOWN') as exchange, coalesce(market_type, 'UNKNOWN') as market_type, coalesce(instrument_id, 'UNKNOWN') as instrument_id"


@query(f"""select {IDENTITY_SQL}, count(*) as rows, count(*) - count(distinct (source_dataset_id, native_trade_id)) as duplicates, count(*) filter (not coalesce(upper(taker_side) in ('BUY', 'SELL'), false)) as unknown_sides,
  round((count(*) - count(distinct (source_dataset_id, native_trade_id))) / count(*), 9) as duplicate_rate, round(count(*) filter (not coalesce(upper(taker_side) in ('BUY', 'SELL'), false)) / count(*), 9) as unknown_side_rate from archive_trade group by 1, 2, 3""")
def quality_measures(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "archive_trade", "exchange", "market_type", "instrument_id", "source_dataset_id", "native_trade_id", "taker_side")
    return quality.measures(rows, ["exchange", "market_type", "instrument_id"], ["source_dataset_id", "native_trade_id"], "taker_side")


POLICIES = [("duplicate_rate", "MAX", 0.01), ("unknown_side_rate", "MAX", 0.005), ("rows", "MIN", 1000.0), ("freshness", None, None)]


@query(f"""with q as (select {IDENTITY_SQL}, count(*) as n, (count(*) - count(distinct (source_dataset_id, native_trade_id))) / count(*) as d, count(*) filter (not coalesce(upper(taker_side) in ('BUY', 'SELL'), false)) / count(*) as u from archive_trade group by 1, 2, 3)
  select exchange, market_type, instrument_id, metric, case when metric = 'freshness' then 'UNKNOWN' when metric = 'duplicate_rate' and d <= 0.01 or metric = 'unknown_side_rate' and u <= 0.005 or metric = 'rows' and n >= 1000 then 'PASS' else 'FAIL' end as evaluation
  from q cross join (values ('duplicate_rate'), ('unknown_side_rate'), ('rows'), ('freshness')) p(metric)""")
def policy_evaluation(spark: SparkSession, folder: str) -> DataFrame:
    found = quality_measures(spark, folder)
    names = [p[0] for p in POLICIES]
    pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("metric"), (F.col(n).cast("double") if n in found.columns else F.lit(None).cast("double")).alias("value")) for n in names)))
    metrics = found.select("exchange", "market_type", "instrument_id", pairs.alias("m")).select("exchange", "market_type", "instrument_id", "m.*", F.lit(True).alias("applicable"))
    policies = spark.createDataFrame(POLICIES, "metric string, comparison string, threshold double")
    return quality.evaluate(metrics, F.broadcast(policies)).select("exchange", "market_type", "instrument_id", "metric", "evaluation")


OBSERVED_US = 1_614_700_800_000_000


@query(f"""select instrument_id, max(epoch_us(event_time)) as last_us, case when max(event_time) is null then 'UNKNOWN' when {OBSERVED_US} < max(epoch_us(event_time)) then 'CLOCK_ERROR' when ({OBSERVED_US} - max(epoch_us(event_time))) / 1e6 <= 3600 then 'ACTIVE' else 'STALE_BY_POLICY' end as status from archive_trade group by 1""")
def freshness_status(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "archive_trade", "instrument_id", "event_time").withColumn("us", F.unix_micros("event_time"))
    return quality.freshness(rows, ["instrument_id"], "us", OBSERVED_US, 3600).select("instrument_id", "last_us", "status")


@query("""select dataset_class, count(*) filter (evaluation = 'PASS') as pass, count(*) filter (evaluation = 'FAIL') as fail, count(*) filter (evaluation = 'UNKNOWN') as unknown, count(*) as total from dq_metric_result group by 1""")
def exposure_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.exposure(table(spark, folder, "dq_metric_result", "dataset_class", "evaluation"), ["dataset_class"], "evaluation", ["PASS", "FAIL", "UNKNOWN"])


@query("""select l_returnflag, l_linestatus, grouping(l_returnflag) as g_flag, grouping(l_linestatus) as g_status, count(*) as rows, round(cast(sum(cast(l_quantity as decimal(18,2))) as double), 4) as quantity from lineitem group by cube (l_returnflag, l_linestatus)""")
def grouped_totals(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem", "l_returnflag", "l_linestatus", "l_quantity")
    return rows.cube("l_returnflag", "l_linestatus").agg(F.grouping("l_returnflag").cast("bigint").alias("g_flag"), F.grouping("l_linestatus").cast("bigint").alias("g_status"), F.count(F.lit(1)).alias("rows"), dbl(F.sum(F.col("l_quantity").cast("decimal(18,2)")), 4).alias("quantity"))


# Manifests and merges ---------------------------------------------------------------------


@query(f"""select {PLAIN_SQL} as path, max(manifest_record_number) as manifest_record_number, arg_max(parquet_sha256, manifest_record_number) as parquet_sha256, arg_max(n_rows, manifest_record_number) as n_rows from active_artifact group by 1""")
def latest_records(spark: SparkSession, folder: str) -> DataFrame:
    from marlstone.operators.compaction import plain_path

    rows = table(spark, folder, "active_artifact", "relative_path", "manifest_record_number", "parquet_sha256", "n_rows").withColumn("path", plain_path(F.col("relative_path"))).drop("relative_path")
    return sequence.latest(rows, ["path"], ["manifest_record_number"])


def _halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All orders as they were, and a changed copy of those that were filled since."""
    rows = table(spark, folder, "orders", "o_orderkey", "o_orderstatus", "o_custkey")
    return rows.withColumn("v", F.concat(F.lit("old-"), "o_orderstatus")), rows.filter("o_orderstatus = 'F'").withColumn("v", F.concat(F.lit("new-"), "o_orderstatus"))


MERGE_SQL = """with u as (select o_orderkey, 'old-' || o_orderstatus as v, 0 as side from orders union all select o_orderkey, 'new-' || o_orderstatus, 1 from orders where o_orderstatus = 'F')
  select o_orderkey, arg_{f}(v, side) as v from u group by 1"""


@query(MERGE_SQL.replace("{f}", "max"))
def merge_new_wins(spark: SparkSession, folder: str) -> DataFrame:
    return merge.keyed(*_halves(spark, folder), ["o_orderkey"], new_wins=True).select("o_orderkey", "v")


@query(MERGE_SQL.replace("{f}", "min"))
def merge_first_wins(spark: SparkSession, folder: str) -> DataFrame:
    return merge.keyed(*_halves(spark, folder), ["o_orderkey"], new_wins=False).select("o_orderkey", "v")


@query("""select count(*) as rows, true as same from archive_trade""")
def content_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the trades' fingerprint is that of the trades in another order."""
    rows = table(spark, folder, "archive_trade", "instrument_id", "native_trade_id", "price", "quantity")
    prints = merge.content_fingerprint(rows, rows.columns).unionByName(merge.content_fingerprint(rows.repartition(7, "native_trade_id"), rows.columns))
    return prints.agg(F.max("rows").alias("rows"), (F.count_distinct("rows", "fingerprint") == 1).alias("same"))


@query("""with d as (select raw_object_ref as source, count(*) as rows from archive_trade group by 1), a as (select distinct relative_path as source from active_artifact where dataset_class = 'individual_trade')
  select count(*) as derived, count(*) filter (source in (select source from a)) as active, cast(sum(rows) filter (source in (select source from a)) as bigint) as active_rows from d""")
def active_sources(spark: SparkSession, folder: str) -> DataFrame:
    derived = table(spark, folder, "archive_trade", "raw_object_ref").groupBy(F.col("raw_object_ref").alias("source")).agg(F.count(F.lit(1)).alias("rows"))
    sources = table(spark, folder, "active_artifact", "relative_path", "dataset_class").filter("dataset_class = 'individual_trade'")
    kept = merge.with_active_source(derived, sources, "source", "relative_path")
    whole = derived.agg(F.count(F.lit(1)).alias("derived"))
    # two one-row tables
    return whole.withColumn("k", F.lit(1)).join(kept.agg(F.count(F.lit(1)).alias("active"), F.sum("rows").alias("active_rows")).withColumn("k", F.lit(1)), "k").drop("k")


@query(f"""with m as (select {PLAIN_SQL} as ref, manifest_record_number as n from active_artifact), l as (select ref, max(n) as n from m group by 1), f as (select distinct raw_object_ref as ref from archive_trade)
  select ref, 'missing' as problem from l where ref like '%individual_trade%' and ref not in (select ref from f)""")
def missing_files(spark: SparkSession, folder: str) -> DataFrame:
    from marlstone.operators.compaction import plain_path

    listed = table(spark, folder, "active_artifact", "relative_path").select(plain_path(F.col("relative_path")).alias("ref"), F.lit(None).cast("string").alias("sha256")).distinct().filter("ref like '%individual_trade%'")
    files = table(spark, folder, "archive_trade", "raw_object_ref").select(F.col("raw_object_ref").alias("ref"), F.lit(None).cast("string").alias("sha256")).distinct()
    return merge.broken_references(listed, files)


# Reconciliation ---------------------------------------------------------------------------


def _three_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    archive = table(spark, folder, "archive_trade", "instrument_id", "native_trade_id", "price", "quantity", "taker_side", "event_time", "source_ordinal")
    stream = table(spark, folder, "ws_trade", "instrument_id", "native_trade_id", "price", "quantity", "taker_side", "event_time_ms")
    key = F.concat_ws(":", "instrument_id", F.lower(F.trim("native_trade_id"))).alias("key")
    side = F.coalesce(F.upper("taker_side"), F.lit("")).alias("side")
    ours = archive.select(key, "price", "quantity", side, F.expr("unix_micros(event_time) div 1000").alias("time_ms"), F.col("source_ordinal").alias("ordinal"))
    theirs = stream.select(key, scalars.number(F.col("price")).alias("price"), scalars.number(F.col("quantity")).alias("quantity"), side, F.col("event_time_ms").alias("time_ms"), F.lit(0).cast("bigint").alias("ordinal"))
    return {"archive": ours, "ws": theirs, "rest": ours.filter("time_ms % 5 <> 0")}


THREE_SQL = """with a as (select instrument_id || ':' || lower(trim(native_trade_id)) as key, arg_max((price, quantity, coalesce(upper(taker_side), ''), epoch_us(event_time) // 1000), source_ordinal) as r from archive_trade group by 1),
  w as (select instrument_id || ':' || lower(trim(native_trade_id)) as key, max((try_cast(price as decimal(38,18)), try_cast(quantity as decimal(38,18)), coalesce(upper(taker_side), ''), event_time_ms)) as r from ws_trade group by 1),
  j as (select coalesce(a.key, w.key) as key, a.key is not null as ia, w.key is not null as iw, a.r[1] as ap, w.r[1] as wp, a.r[2] as aq, w.r[2] as wq, a.r[3] as sa, w.r[3] as sw, a.r[4] as ta, w.r[4] as tw from a full join w on a.key = w.key),
  k as (select key, ia and not iw as missing_in_ws, iw and not ia as missing_in_archive, ia and ta % 5 = 0 as missing_in_rest, ia and iw and (ap is distinct from wp or aq is distinct from wq) as field_conflict,
    ia and iw and coalesce(sa <> '' and sw <> '' and sa <> sw, false) as side_conflict, ia and iw and coalesce(ta > 0 and tw > 0 and abs(ta - tw) > 0, false) as time_conflict, ia as in_archive from j),
  t as (select *, in_archive and not missing_in_ws and not field_conflict and not side_conflict and not time_conflict as matched from k)"""


@query(THREE_SQL + " select key, missing_in_ws, missing_in_archive, missing_in_rest, field_conflict, side_conflict, time_conflict, matched from t where not matched or missing_in_rest")
def reconcile_three_way(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.three_way(_three_sources(spark, folder)).filter("not matched or missing_in_rest").drop("in_archive")


@query(THREE_SQL + """ select count(*) filter (missing_in_ws) as missing_in_ws, count(*) filter (missing_in_archive) as missing_in_archive, count(*) filter (missing_in_rest) as missing_in_rest, count(*) filter (field_conflict) as field_conflict,
  count(*) filter (side_conflict) as side_conflict, count(*) filter (time_conflict) as time_conflict, count(*) filter (matched) as matched, count(*) filter (in_archive) as archive_keys, count(*) as keys,
  round(count(*) filter (matched) * 100.0 / count(*) filter (in_archive), 2) as match_rate, false as coverage_proven from t""")
def reconcile_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.summary(reconcile.three_way(_three_sources(spark, folder))).withColumn("match_rate", F.col("match_rate").cast("double"))


@query(THREE_SQL + """ select key, concat_ws(',', case when missing_in_ws then 'missing_in_ws' end, case when missing_in_archive then 'missing_in_archive' end, case when field_conflict then 'field_conflict' end, case when side_conflict then 'side_conflict' end, case when time_conflict then 'time_conflict' end) as kinds
  from t where missing_in_ws or missing_in_archive or field_conflict or side_conflict or time_conflict order by key limit 50""")
def reconcile_details(spark: SparkSession, folder: str) -> DataFrame:
    """The report's first fifty discrepancies."""
    return reconcile.details(reconcile.three_way(_three_sources(spark, folder)))


@query("""select instrument_id, epoch_ms(open_time) as open_ms, count(distinct (close_price, base_volume, trade_count)) as versions from ohlcv_candle where candle_interval = '1m' and is_closed group by 1, 2 having versions > 1""")
def candle_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "ohlcv_candle", "instrument_id", "candle_interval", "is_closed", "open_time", "close_price", "base_volume", "trade_count").filter("candle_interval = '1m' and is_closed")
    return reconcile.conflicts(rows.withColumn("open_ms", F.unix_millis("open_time")), ["instrument_id", "open_ms"], ["close_price", "base_volume", "trade_count"])


@query("""with a as (select instrument_id as i, epoch_ms(open_time) as t, max(close_price) as c, max(base_volume) as v, max(trade_count) as n from ohlcv_candle where candle_interval = '1m' and is_closed and source_method = 'archive' group by 1, 2),
  r as (select instrument_id as i, epoch_ms(open_time) as t, max(close_price) as c, max(base_volume) as v, max(trade_count) as n from ohlcv_candle where candle_interval = '1m' and is_closed and source_method <> 'archive' group by 1, 2)
  select i as instrument_id, t as open_ms, concat_ws(',', case when a.c is distinct from r.c then 'close_price' end, case when a.v is distinct from r.v then 'base_volume' end, case when a.n is distinct from r.n then 'trade_count' end) as fields from a join r using (i, t) where a.c is distinct from r.c or a.v is distinct from r.v or a.n is distinct from r.n""")
def overlap_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "ohlcv_candle", "instrument_id", "candle_interval", "is_closed", "source_method", "open_time", "close_price", "base_volume", "trade_count").filter("candle_interval = '1m' and is_closed")
    fields = ["close_price", "base_volume", "trade_count"]
    one = lambda df: df.groupBy("instrument_id", F.unix_millis("open_time").alias("open_ms")).agg(*(F.max(f).alias(f) for f in fields))
    return reconcile.overlap_conflicts(one(rows.filter("source_method = 'archive'")), one(rows.filter("source_method <> 'archive'")), ["instrument_id", "open_ms"], fields)


@query("""with m as (select market_type, native_symbol, epoch_us(event_time) // 300000000 as slot, avg(cast(price as double)) filter (exchange = 'binance') as a, avg(cast(price as double)) filter (exchange = 'bybit') as b from archive_trade group by 1, 2, 3)
  select market_type, native_symbol, count(*) as slots, round(min(a / b), 9) as lowest, round(median(a / b), 9) as median, round(max(a / b), 9) as highest from m where a is not null and b is not null and b <> 0 group by 1, 2""")
def venue_ratios(spark: SparkSession, folder: str) -> DataFrame:
    """How prices of the two venues relate, for every market and symbol."""
    rows = table(spark, folder, "archive_trade", "exchange", "market_type", "native_symbol", "event_time", "price")
    slot = F.expr("unix_micros(event_time) div 300000000")
    found = reconcile.ratios(rows.select("exchange", "market_type", "native_symbol", slot.alias("slot"), F.col("price").cast("double").alias("price")), "slot", "exchange", "binance", "bybit", "price", ["market_type", "native_symbol"])
    return rounded(found, "lowest", "median", "highest", digits=9)


# Point in time ----------------------------------------------------------------------------


@query("""with l as (select distinct instrument_id, epoch_us(event_time) as t from liquidation where event_time is not null),
  r as (select instrument_id, epoch_us(open_time) as t, max(close_price) as c from ohlcv_candle where candle_interval = '1m' and is_closed group by 1, 2),
  j as (select l.instrument_id, l.t, r.t as rt, r.c from l asof left join r on l.instrument_id = r.instrument_id and l.t >= r.t)
  select instrument_id, t, case when t - rt <= 90000000 then round(cast(c as double), 6) end as close, case when t - rt <= 90000000 then t - rt end as age_us,
  case when t - rt = 0 then 'exact_available' when t - rt <= 90000000 then 'asof_fresh' when rt is not null then 'stale' else 'missing' end as match_quality from j""")
def asof_candle(spark: SparkSession, folder: str) -> DataFrame:
    """Each forced order's time with the last candle known then, at most 90 seconds old."""
    left = table(spark, folder, "liquidation", "instrument_id", "event_time").filter("event_time is not null").select("instrument_id", F.unix_micros("event_time").alias("t")).distinct()
    rows = table(spark, folder, "ohlcv_candle", "instrument_id", "candle_interval", "is_closed", "open_time", "close_price").filter("candle_interval = '1m' and is_closed")
    right = rows.select("instrument_id", F.unix_micros("open_time").alias("r"), F.col("close_price").alias("close"))
    found = asof.backward(left, right, ["instrument_id"], "t", "r", ["close"], 90_000_000, prefix="")
    return rounded(found, "close")


@query("""with s as (select user_id, epoch_us(ts) as t, max(event_type) as state from events where event_type in ('signup', 'error') group by 1, 2), l as (select event_id, user_id, epoch_us(ts) as t from events where event_type = 'purchase')
  select event_id, state as state_state from l asof left join s on l.user_id = s.user_id and l.t >= s.t""")
def state_at_purchase(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events", "event_id", "user_id", "event_type", "ts").withColumn("t", F.unix_micros("ts"))
    states = rows.filter("event_type in ('signup', 'error')").select("user_id", F.col("t").alias("since"), F.col("event_type").alias("state"))
    return asof.valid_at(rows.filter("event_type = 'purchase'"), states, ["user_id"], "t", "since", ["state"]).select("event_id", "state_state")


@query("""select event_id, epoch_us(lead(ts) over (partition by user_id order by ts)) as valid_to_us from events""")
def validity_intervals(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events", "event_id", "user_id", "ts")
    return sequence.validity(rows, ["user_id"], "ts").select("event_id", F.unix_micros("valid_to").alias("valid_to_us"))


@query("""select instrument_id, count(*) filter (coalesce(knowledge_time <= timestamptz '2021-03-01 06:00:00+00', false)) as known, count(*) as rows from liquidation group by 1""")
def known_by_decision(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "liquidation", "instrument_id", "knowledge_time")
    known = scalars.knowable(F.col("knowledge_time"), F.lit("2021-03-01 06:00:00").cast("timestamp"))
    return rows.groupBy("instrument_id").agg(F.count_if(known).alias("known"), F.count(F.lit(1)).alias("rows"))


# Retention --------------------------------------------------------------------------------


@query(f"""with r as (select {PLAIN_SQL} as ref, manifest_path as m, manifest_record_number as n, epoch_us(published_at) as seen, n_rows from active_artifact),
  f as (select ref, max(seen) as seen from r group by 1), i as (select k as key, arg_max(seen, (m, n)) as covered from (select unnest([ref, regexp_extract(ref, '([^/]*)$', 1)]) as k, m, n, seen from r where n_rows > 4) group by 1),
  d as (select f.*, a.covered as by_path, b.covered as by_name, regexp_extract(ref, 'date=([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1) as day from f left join i a on a.key = f.ref left join i b on b.key = regexp_extract(f.ref, '([^/]*)$', 1)),
  a as (select ref, coalesce(by_path, by_name, case when day <> '' then epoch_us(cast(day as timestamp)) + 86399000000 end, seen) as aged_us, case when by_path is not null then 'MANIFEST_PATH' when by_name is not null then 'MANIFEST_NAME' when day <> '' then 'PATH_DATE' else 'MODIFIED' end as age_basis from d)
  select age_basis, case when aged_us < epoch_us(timestamp '2021-03-02 12:00:00') - 86400000000 then case when ref like 'normalized/individual_trade/v1/exchange=bybit/%' then 'HELD' else 'DELETE' end else 'KEEP' end as decision, count(*) as files from a group by 1, 2""")
def retention_plan(spark: SparkSession, folder: str) -> DataFrame:
    """Files older than a day on a fixed date, with one folder on hold; records of more than four rows state what their files cover."""
    from marlstone.operators.compaction import plain_path

    rows = table(spark, folder, "active_artifact", "relative_path", "published_at", "manifest_path", "manifest_record_number", "n_rows").withColumn("ref", plain_path(F.col("relative_path")))
    files = rows.groupBy("ref").agg(F.max("published_at").alias("published_at"))
    none = F.lit(None).cast("string")
    covered = rows.filter("n_rows > 4").select(F.col("manifest_path").alias("manifest"), F.col("manifest_record_number").alias("number"), F.col("ref").alias("object_id"), none.alias("raw_object_ref"), none.alias("artifact_ref"), F.col("published_at").alias("coverage_end"))
    holds = spark.createDataFrame([("normalized/individual_trade/v1/exchange=bybit/",)], "hold string")
    planned = retention.candidates(retention.aged(files, audit.coverage_index(covered), F.col("published_at")), holds, F.lit("2021-03-02 12:00:00").cast("timestamp"), 1)
    return planned.groupBy("age_basis", "decision").agg(F.count(F.lit(1)).alias("files"))


# Features ---------------------------------------------------------------------------------

BARS_SQL = """bars as (select instrument_id, epoch_us(open_time) // 60000000 * 60000000 as t, max(cast(close_price as double)) as c, max(cast(high_price as double)) as h, min(cast(low_price as double)) as l, max(cast(base_volume as double)) as v
  from ohlcv_candle where candle_interval = '1m' and is_closed group by 1, 2)"""


def bars(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "ohlcv_candle", "instrument_id", "candle_interval", "is_closed", "open_time", "close_price", "high_price", "low_price", "base_volume").filter("candle_interval = '1m' and is_closed")
    return rows.groupBy("instrument_id", scalars.floor_us(F.unix_micros("open_time"), 60).alias("t")).agg(
        F.max(F.col("close_price").cast("double")).alias("c"), F.max(F.col("high_price").cast("double")).alias("h"), F.min(F.col("low_price").cast("double")).alias("l"), F.max(F.col("base_volume").cast("double")).alias("v")
    )


@query(f"""with {BARS_SQL}, r as (select *, ln(c / lag(c) over w) as lr from bars window w as (partition by instrument_id order by t))
  select instrument_id, t, round(lr, 9) as log_return, round(avg(c) over b, 6) as sma, round(stddev_samp(lr) over b, 9) as volatility, round(c - lag(c, 20) over w, 6) as momentum, round(max(c) over b, 6) as rolling_high, round(min(c) over b, 6) as rolling_low
  from r window w as (partition by instrument_id order by t), b as (partition by instrument_id order by t rows between 19 preceding and current row)""")
def rolling_features(spark: SparkSession, folder: str) -> DataFrame:
    made = features.rolling(bars(spark, folder), ["instrument_id"], "t", "c", "v", 20).select("instrument_id", "t", "log_return", "sma", "volatility", "momentum", "rolling_high", "rolling_low")
    return rounded(rounded(made, "sma", "momentum", "rolling_high", "rolling_low"), "log_return", "volatility", digits=9)


@query(f"""with {BARS_SQL}, f as (select *, lead(c, 60) over w / c - 1 as future_return, case when lead(c, 60) over w is not null then max(h) over a / c - 1 end as best, case when lead(c, 60) over w is not null then min(l) over a / c - 1 end as worst
  from bars window w as (partition by instrument_id order by t), a as (partition by instrument_id order by t rows between 1 following and 60 following))
  select instrument_id, t, round(future_return, 9) as future_return, round(best, 9) as best, round(worst, 9) as worst, case when future_return > 0.001 then 'UP' when future_return < -0.001 then 'DOWN' when future_return is not null then 'NEUTRAL' end as label from f""")
def forward_labels(spark: SparkSession, folder: str) -> DataFrame:
    made = features.labels(bars(spark, folder), ["instrument_id"], "t", "c", "h", "l", 60, 0.001)
    return rounded(made.select("instrument_id", "t", "future_return", "best", "worst", "label"), "future_return", "best", "worst", digits=9)


@query(f"""with {BARS_SQL}, d as (select instrument_id, t, c, max(c) over (partition by instrument_id order by t) - c as fall from bars) select instrument_id, round(max(fall), 6) as max_drawdown, round(arg_max(c, t), 6) as final from d group by 1""")
def drawdown_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.drawdowns(bars(spark, folder), ["instrument_id"], "t", "c"), "max_drawdown", "final")


@query(f"""with recursive {BARS_SQL}, n as (select *, row_number() over w as k, c - lag(c) over w as step, h - lag(h) over w as up, lag(l) over w - l as down, lag(c) over w as p from bars window w as (partition by instrument_id order by t)),
  x as (select instrument_id as i, t, k, c, greatest(step, 0) * case when step is null then null else 1 end as g, greatest(-step, 0) * case when step is null then null else 1 end as d, greatest(h - l, coalesce(abs(h - p), 0), coalesce(abs(l - p), 0)) as r, case when up > down and up > 0 then up else 0.0 end as u, case when down > up and down > 0 then down else 0.0 end as v from n),
  y as (select i, t, k, c as ema, g, d, r, u, v, case when u + v > 0 then abs(u - v) / (u + v) end as s from x where k = 1
    union all select i, t, k, ema, g, d, r, u, v, case when z is null then s when s is null then z else 13 / 14.0 * s + z / 14 end from (select *, case when u + v > 0 then abs(u - v) / (u + v) end as z from (
      select x.i, x.t, x.k, 13 / 15.0 * y.ema + 2 / 15.0 * x.c as ema, case when y.g is null then x.g else 13 / 14.0 * y.g + x.g / 14 end as g, case when y.d is null then x.d else 13 / 14.0 * y.d + x.d / 14 end as d, 13 / 14.0 * y.r + x.r / 14 as r, 13 / 14.0 * y.u + x.u / 14 as u, 13 / 14.0 * y.v + x.v / 14 as v, y.s from y join x on x.i = y.i and x.k = y.k + 1)))
  select i as instrument_id, t, round(ema, 4) as ema, round(case when g + d > 0 then 100 * g / (g + d) end, 4) as rsi, round(r, 4) as atr, round(100 * s, 4) as adx from y""")
def recursive_indicators(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.recursive_indicators(bars(spark, folder), ["instrument_id"], "t", "h", "l", "c"), "ema", "rsi", "atr", "adx", digits=4)


@query(f"""with {BARS_SQL} select instrument_id, count(*) as kept from bars where not (t < 1614560400000000 + 600000000 and t + 3600000000 >= 1614558600000000) group by 1""")
def purged_training_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = bars(spark, folder).withColumn("until", F.col("t") + HOUR * 1_000_000)
    kept = features.purged(rows, [(1_614_558_600_000_000, 1_614_560_400_000_000)], "t", "until", 600_000_000)
    return kept.groupBy("instrument_id").agg(F.count(F.lit(1)).alias("kept"))


@query("""select (select count(*) from (select o_custkey from orders intersect select c_custkey from customer)) as in_both, (select count(*) from (select c_custkey from customer except select o_custkey from orders)) as without_orders, (select count(*) from (select o_custkey from orders union select c_custkey from customer)) as in_either""")
def key_sets(spark: SparkSession, folder: str) -> DataFrame:
    ours, theirs = table(spark, folder, "orders").select(F.col("o_custkey").alias("k")), table(spark, folder, "customer").select(F.col("c_custkey").alias("k"))
    sides = ours.distinct().withColumn("o", F.lit(1)).withColumn("c", F.lit(0)).unionByName(theirs.distinct().withColumn("o", F.lit(0)).withColumn("c", F.lit(1))).groupBy("k").agg(F.max("o").alias("o"), F.max("c").alias("c"))
    return sides.agg(F.count_if((F.col("o") == 1) & (F.col("c") == 1)).alias("in_both"), F.count_if(F.col("o") == 0).alias("without_orders"), F.count(F.lit(1)).alias("in_either"))


# Streams ----------------------------------------------------------------------------------

BATCHES, DELAY_US = 6, 1_800_000_000
#: Rows by intake batch, with the watermark under which a batch's late rows are dropped: that of the batch before, which knows all batches but the last two.
LATE_SQL = """b as (select *, cast(floor((o - (select min(o) from r)) * {n} / ((select max(o) - min(o) + 1 from r))) as bigint) as b from r),
  w as (select k, (select max(u) from b where b <= k - 2) - {d} as w, (select max(u) from b) - {d} as last from (select unnest(generate_series(0, {n} - 1)) as k)), l as (select b.*, w.w, w.last from b join w on b.b = w.k)""".replace("{n}", str(BATCHES)).replace("{d}", str(DELAY_US))
EVENTS_SQL = "r as (select event_id as o, event_type, user_id, value, epoch_us(ts) as u from events)"


def _staged(spark: SparkSession, rows: DataFrame, order: str, purpose: str) -> tuple[DataFrame, str]:
    """The rows as a stream of a few intake batches, one a trigger, and a folder for what is made of them."""
    root = scratch(spark, purpose)
    schema = jobs.staged(rows, order, BATCHES, f"{root}/in")
    return jobs.file_stream(spark, f"{root}/in", schema, 1), root


def _events(spark: SparkSession, folder: str, purpose: str) -> tuple[DataFrame, str]:
    return _staged(spark, table(spark, folder, "events", "event_id", "event_type", "user_id", "value", "ts"), "event_id", purpose)


@query(f"""with {EVENTS_SQL}, {LATE_SQL} select event_type, u - u % 3600000000 as window_us, count(*) as n, round(sum(value), 4) as total, min(value) as lowest, max(value) as highest from l where u - u % 3600000000 + 3600000000 > coalesce(w, 0) and u - u % 3600000000 + 3600000000 <= last group by 1, 2""")
def stream_tumbling(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly windows in append mode: late rows beyond the watermark are dropped, windows it hasn't passed stay open."""
    stream, root = _events(spark, folder, "tumbling")
    made = jobs.drained(jobs.tumbling(stream, "ts", ["event_type"], "value", "1 hour", "30 minutes"), f"{root}/out", f"{root}/checkpoint")
    return made.select("event_type", F.unix_micros("window.start").alias("window_us"), "n", dbl("total", 4).alias("total"), "lowest", "highest")


@query(f"""with {EVENTS_SQL}, {LATE_SQL}, x as (select l.*, unnest([u - u % 1800000000, u - u % 1800000000 - 1800000000]) as window_us from l) select event_type, window_us, count(*) as n from x where window_us + 3600000000 > coalesce(w, 0) and window_us + 3600000000 <= last group by 1, 2""")
def stream_sliding(spark: SparkSession, folder: str) -> DataFrame:
    stream, root = _events(spark, folder, "sliding")
    made = jobs.drained(jobs.sliding(stream, "ts", ["event_type"], "1 hour", "30 minutes", "30 minutes"), f"{root}/out", f"{root}/checkpoint")
    return made.select("event_type", F.unix_micros("window.start").alias("window_us"), "n")


ORDERS_STREAM_SQL = "r as (select ingest_seq as o, instrument_id, source_side as side, try_cast(source_price as decimal(38,18)) as price, try_cast(source_quantity as decimal(38,18)) as quantity, epoch_us(event_time) as u from liquidation where event_time is not null and try_cast(source_price as decimal(38,18)) is not null and try_cast(source_quantity as decimal(38,18)) is not null)"


@query(f"""with {ORDERS_STREAM_SQL}, {LATE_SQL} select instrument_id, u - u % 300000000 as bucket_us, count(*) as trade_count, count(*) filter (side = 'BUY') as buy_count, count(*) filter (side = 'SELL') as sell_count, round(cast(arg_min(price, (u, price, quantity)) as double), 6) as open, round(cast(max(price) as double), 6) as high, round(cast(min(price) as double), 6) as low,
  round(cast(arg_max(price, (u, price, quantity)) as double), 6) as close, round(cast(sum(quantity) as double), 6) as base_volume, round(cast(coalesce(sum(quantity) filter (side = 'BUY'), 0) - coalesce(sum(quantity) filter (side = 'SELL'), 0) as double), 6) as base_delta
  from l where u - u % 300000000 + 300000000 > coalesce(w, 0) and u - u % 300000000 + 300000000 <= last group by 1, 2""")
def stream_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """Five-minute buckets of forced orders as they come in, with what is too late left out."""
    number = lambda c: F.expr(f"try_cast({c} as decimal(38,18))")
    rows = table(spark, folder, "liquidation", "ingest_seq", "instrument_id", "event_time", F.col("source_side").alias("side"), number("source_price").alias("price"), number("source_quantity").alias("quantity")).filter("event_time is not null and price is not null and quantity is not null")
    stream, root = _staged(spark, rows, "ingest_seq", "buckets")
    made = jobs.drained(jobs.tumbling_buckets(stream, "event_time", ["instrument_id"], 300, "30 minutes"), f"{root}/out", f"{root}/checkpoint")
    shown = made.select("instrument_id", F.unix_micros("window.start").alias("bucket_us"), "trade_count", "buy_count", "sell_count", "open", "high", "low", "close", "base_volume", "base_delta")
    return rounded(shown, "open", "high", "low", "close", "base_volume", "base_delta")


@query("""select instrument_id, count(*) as raw, count(*) filter (event_time is not null and try_cast(source_quantity as decimal(38,18)) > 0) as normalised from liquidation group by 1""")
def stream_capture(spark: SparkSession, folder: str) -> DataFrame:
    """Every batch written raw, then normalised; a run that breaks off goes on from its checkpoint."""
    stream, root = _staged(spark, table(spark, folder, "liquidation", "ingest_seq", "instrument_id", "event_time", "source_quantity"), "ingest_seq", "capture")
    usable = lambda df: df.filter("event_time is not null and try_cast(source_quantity as decimal(38,18)) > 0")
    for _ in range(2):  # the second run finds nothing new
        jobs.capture(stream, f"{root}/raw", f"{root}/normalised", usable, f"{root}/checkpoint").awaitTermination()
    count = lambda name: spark.read.parquet(f"{root}/{name}").groupBy("instrument_id").agg(F.count(F.lit(1)).alias(name))
    return count("raw").join(count("normalised"), "instrument_id", "left").select("instrument_id", "raw", F.coalesce("normalised", F.lit(0)).alias("normalised"))


@query("""select strftime(received_at, '%Y-%m-%d') as date, strftime(received_at, '%H') as hour, count(*) as messages, count(distinct envelope_id) as envelopes from ws_envelope group by 1, 2""")
def stream_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Raw messages appended to segments by hour of receipt."""
    stream, root = _staged(spark, table(spark, folder, "ws_envelope", "ingest_seq", "envelope_id", "received_at", "payload"), "ingest_seq", "segments")
    jobs.segments(stream, "received_at", f"{root}/out", f"{root}/checkpoint").awaitTermination()
    read = spark.read.schema("envelope_id string, date string, hour string").json(f"{root}/out")
    none = lambda c: F.when(F.col(c) != "__HIVE_DEFAULT_PARTITION__", F.col(c))
    return read.groupBy(none("date").alias("date"), none("hour").alias("hour")).agg(F.count(F.lit(1)).alias("messages"), F.count_distinct("envelope_id").alias("envelopes"))


def _stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table's files as a stream; a single file is streamed from its folder under its own name."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    fs = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    single = fs.getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(path)).isFile()
    stream = spark.readStream.schema(schema)
    stream = stream.option("pathGlobFilter", f"{name}.parquet").parquet(folder) if single else stream.parquet(path)
    naive = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return stream.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else stream


def _drained(spark: SparkSession, made: DataFrame, purpose: str) -> DataFrame:
    """Run a stream to its end in complete batches, each replacing the result of the one before."""
    root = scratch(spark, purpose)
    save = lambda batch, number: batch.write.mode("overwrite").parquet(f"{root}/result-{number}")
    stream = made.writeStream.outputMode("complete").foreachBatch(save).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    stream.awaitTermination()
    last = stream.lastProgress["batchId"] if stream.lastProgress else 0
    return spark.read.parquet(f"{root}/result-{last}")


@query("""with l as (select user_id, ts, coalesce(epoch_us(ts) - epoch_us(lag(ts) over (partition by user_id order by ts)) >= 14400000000, true) as opens from events), s as (select *, sum(opens::int) over (partition by user_id order by ts) as no from l)
  select user_id, epoch_us(min(ts)) as start_us, count(*) as n from s group by user_id, no""")
def stream_sessions(spark: SparkSession, folder: str) -> DataFrame:
    made = jobs.sessions(_stream(spark, folder, "events"), "ts", ["user_id"], "4 hours", "60 days")
    return _drained(spark, made, "sessions").select("user_id", F.unix_micros("session_window.start").alias("start_us"), "n")


@query("""select dedup_fingerprint, count(*) as n from (select distinct dedup_fingerprint from liquidation where dedup_fingerprint is not null and received_at is not null) group by 1""")
def stream_replays(spark: SparkSession, folder: str) -> DataFrame:
    """Forced orders without exact replays, over several intake batches, within a watermark that spans the data."""
    rows = table(spark, folder, "liquidation", "ingest_seq", "dedup_fingerprint", "received_at").filter("dedup_fingerprint is not null and received_at is not null")
    stream, root = _staged(spark, rows, "ingest_seq", "replays")
    kept = jobs.drained(jobs.without_replays(stream, "received_at", ["dedup_fingerprint"], "400 days"), f"{root}/out", f"{root}/checkpoint")
    return kept.groupBy("dedup_fingerprint").agg(F.count(F.lit(1)).alias("n"))


@query("""with p as (select instrument_id, epoch_us(event_time) - epoch_us(event_time) % 300000000 as period_us, epoch_us(coalesce(knowledge_time, received_at)) - (epoch_us(event_time) - epoch_us(event_time) % 300000000) - 300000000 as delay from liquidation where event_time is not null and coalesce(knowledge_time, received_at) is not null)
  select instrument_id, period_us, count(*) filter (delay <= 0) as on_time, count(*) filter (delay > 0 and delay <= 1800000000) as late, count(*) filter (delay > 1800000000) as dropped from p group by 1, 2""")
def stream_late_state(spark: SparkSession, folder: str) -> DataFrame:
    """The multiset state after all deliveries came in as a stream (redeliveries counted)."""
    rows = _stream(spark, folder, "liquidation").select("instrument_id", F.unix_micros("event_time").alias("event_us"), F.unix_micros(F.coalesce("knowledge_time", "received_at")).alias("arrival_us"), F.expr("try_cast(source_price as decimal(38,18))").alias("value"))
    root = scratch(spark, "late")
    keeper = jobs.LateCorrections(spark, f"{root}/state", {"instrument_id": "string"}, "decimal(38,18)", 300_000_000, 1_800_000_000)
    keeper.run(rows, f"{root}/checkpoint").awaitTermination()
    return keeper.state().groupBy("instrument_id", "period_us").agg(*(F.sum(c).alias(c) for c in ("on_time", "late", "dropped")))
