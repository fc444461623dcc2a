"""Raw venue records to typed rows: one projection per record shape, and the rules rows must meet.

Each normaliser returns columns only; what breaks a rule is for the caller to refuse or to
quarantine (operators.quality). Numbers stay exact, times keep their stated unit, and what a
venue doesn't publish is null, never zero.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions import scalars as S

MINUTE_MS = 60_000


def kline_rows(rows: DataFrame, unit: str) -> DataFrame:
    """Twelve text fields c0..c11 of an archive kline (open time, o, h, l, c, volume, close time, quote, trades, taker base, taker quote, unused)."""
    return rows.select(
        *[c for c in rows.columns if not (c[:1] == "c" and c[1:].isdigit())],
        S.epoch(F.col("c0").try_cast("bigint"), unit).alias("open_time"), S.epoch(F.col("c6").try_cast("bigint"), unit).alias("close_time"),
        *(S.number(F.col(f"c{i}")).alias(n) for i, n in ((1, "open"), (2, "high"), (3, "low"), (4, "close"), (5, "base_volume"), (7, "quote_volume"))),
        F.col("c8").try_cast("bigint").alias("trade_count"),
        S.number(F.col("c9")).alias("taker_buy_base_volume"), S.number(F.col("c10")).alias("taker_buy_quote_volume"),
    )


def short_kline_rows(rows: DataFrame) -> DataFrame:
    """Seven text fields of a REST kline (start ms, o, h, l, c, volume, turnover); the fields it lacks are null."""
    start = F.col("c0").try_cast("bigint")
    none = lambda n, t: F.lit(None).cast(t).alias(n)
    return rows.select(
        *[c for c in rows.columns if not (c[:1] == "c" and c[1:].isdigit())],
        S.epoch(start, "ms").alias("open_time"), S.epoch(start + MINUTE_MS - 1, "ms").alias("close_time"),
        *(S.number(F.col(f"c{i}")).alias(n) for i, n in ((1, "open"), (2, "high"), (3, "low"), (4, "close"), (5, "base_volume"), (6, "quote_volume"))),
        none("trade_count", "bigint"), none("taker_buy_base_volume", "decimal(38,18)"), none("taker_buy_quote_volume", "decimal(38,18)"),
    )


def candle_rules(step_us: int = 60_000_000) -> Mapping[str, Column]:
    """What a candle must meet; optional fields may be null."""
    c = F.col
    optional = lambda ok, *fields: ok | F.coalesce(*(c(f).isNull() for f in fields))
    return {
        "aligned": F.pmod(F.unix_micros("open_time"), F.lit(step_us)) == 0,
        "closes_with_interval": F.unix_micros("close_time").between(F.unix_micros("open_time") + step_us - 1000, F.unix_micros("open_time") + step_us - 1),
        "prices_positive": F.least("open", "high", "low", "close") > 0,
        "low_lowest": c("low") <= F.least("open", "close"),
        "high_highest": c("high") >= F.greatest("open", "close"),
        "volumes": (c("base_volume") >= 0) & (c("quote_volume") >= 0),
        "taker_base": optional(c("taker_buy_base_volume").between(0, c("base_volume")), "taker_buy_base_volume"),
        "taker_quote": optional(c("taker_buy_quote_volume").between(0, c("quote_volume")), "taker_buy_quote_volume"),
        "trades": optional(c("trade_count") >= 0, "trade_count"),
    }


def archive_trades(rows: DataFrame, unit: str, strict: bool = False) -> DataFrame:
    """Individual trades (id, price, qty, quote_qty, time, is_buyer_maker[, is_best_match] as text): the buyer being maker is a SELL.

    With ``strict`` truth values must be exactly True or False; else any letter case will do.
    Others are null, and so is the side; :func:`trade_rules` says which rows to refuse.
    """
    truth = S.strict_boolean if strict else S.loose_boolean
    best = truth(F.col("is_best_match")) if "is_best_match" in rows.columns else F.lit(False)
    maker = truth(F.col("is_buyer_maker"))
    price, quantity = S.positive(F.col("price")), S.positive(F.col("qty"))
    quote = S.positive(F.col("quote_qty")) if "quote_qty" in rows.columns else S.product(price, quantity)
    side = F.when(maker, "SELL").when(~maker, "BUY").otherwise("UNKNOWN")
    stamp = F.col("time").try_cast("bigint")
    kept = [c for c in rows.columns if c not in ("id", "price", "qty", "quote_qty", "time", "is_buyer_maker", "is_best_match")]
    return rows.select(
        *kept, F.col("id").alias("native_trade_id"), S.epoch(stamp, unit).alias("event_time"), stamp.alias("source_timestamp"), F.lit(unit).alias("source_timestamp_unit"),
        price.alias("price"), quantity.alias("quantity"), quote.alias("quote_quantity"), side.alias("taker_side"), S.signed(quantity, side).alias("signed_quantity"),
        maker.alias("is_buyer_maker"), best.alias("is_best_match"),
    )


def trade_rules(day: str | None = None) -> Mapping[str, Column]:
    """What an individual trade must meet; with ``day`` its event must lie on that day (UTC)."""
    c = F.col
    rules = {
        "id": c("native_trade_id").isNotNull(), "price": c("price") > 0, "quantity": c("quantity") > 0, "quote": c("quote_quantity") > 0,
        "side": c("taker_side").isin("BUY", "SELL"), "time": c("event_time").isNotNull(),
    }
    return rules | ({"of_the_day": F.coalesce(F.to_date("event_time") == F.to_date(F.lit(day)), F.lit(False))} if day else {})


def closed_by(cutoff: Column, open_time: Column | None = None, close_time: Column | None = None, step_us: int = 60_000_000) -> Column:
    """Whether a candle is final at the cut-off: it closed before, or its whole step had passed by then."""
    if close_time is not None:
        return F.coalesce(close_time < cutoff, F.lit(False))
    return F.coalesce(F.unix_micros(open_time) + step_us <= F.unix_micros(cutoff), F.lit(False))


def second_version(candles: DataFrame, interval: str = "interval", schema_version: str = "2.1.0") -> DataFrame:
    """Candles of the first schema version in the second: what the venue stated goes to source_*, what it didn't is null.

    Intervals are ISO 8601, derivatives are perpetuals; the second version's own fields are added.
    """
    none = lambda t="string": F.lit(None).cast(t)
    iso = F.when(F.col(interval).rlike("^[0-9]+m$"), F.concat(F.lit("PT"), F.upper(interval))).when(F.col(interval).rlike("^[0-9]+h$"), F.concat(F.lit("PT"), F.upper(interval))).when(F.col(interval).rlike("^[0-9]+d$"), F.concat(F.lit("P"), F.upper(interval)))
    market = F.when(F.col("market_type") == "derivative", "perpetual").otherwise(F.col("market_type"))
    return candles.withColumns({
        "interval": iso, "market_type": market, "schema_version": F.lit(schema_version), "candle_source": F.lit("exchange"), "source_volume": F.col("base_volume"), "source_turnover": F.col("quote_volume"),
        "aggregation_version": none(), "source_revision_id": none(), "exchange_timestamp": none("timestamp"), "source_published_at": none("timestamp"), "clock_offset_ms": none("bigint"), "ingestion_run_id": none(),
        "dq_flags": F.array().cast("array<string>"),
    })


def venue_trades(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Trades under either set of names (id/trdMatchID, volume/size, ms or fractional seconds); unknown sides are flagged."""
    has = lambda *names: F.coalesce(*(F.col(n).cast("string") for n in names if n in rows.columns))
    price, quantity, side = S.positive(F.col("price")), S.positive(has("volume", "size")), S.taker_side(F.col("side"))
    stamp = F.col("timestamp").cast("string")
    us = F.when(stamp.contains("."), S.float_seconds_us(stamp)).otherwise(stamp.try_cast("bigint") * 1000)
    return rows.select(
        *keep, has("id", "trdMatchID").alias("native_trade_id"), F.timestamp_micros(us).alias("event_time"), price.alias("price"), quantity.alias("quantity"),
        S.product(price, quantity).alias("quote_quantity"), side.alias("taker_side"), S.signed(quantity, side).alias("signed_quantity"),
        F.array_compact(F.array(F.when(side == "UNKNOWN", F.lit("UNKNOWN_TAKER_SIDE")))).alias("dq_flags"),
    )


def aggregate_trades(rows: DataFrame, unit: str, keep: Sequence[str] = ()) -> DataFrame:
    """Exchange-aggregated trades (agg_id, price, qty, first_id, last_id, time, is_buyer_maker as text), a class of their own."""
    maker, price, quantity = S.loose_boolean(F.col("is_buyer_maker")), S.positive(F.col("price")), S.positive(F.col("qty"))
    return rows.select(
        *keep, F.lit("exchange_aggregate_trade").alias("dataset_class"), F.col("agg_id").alias("aggregate_trade_id"),
        F.col("first_id").try_cast("bigint").alias("first_trade_id"), F.col("last_id").try_cast("bigint").alias("last_trade_id"),
        S.epoch(F.col("time").try_cast("bigint"), unit).alias("event_time"), price.alias("price"), quantity.alias("quantity"), S.product(price, quantity).alias("quote_quantity"),
        F.when(maker, "SELL").when(~maker, "BUY").otherwise("UNKNOWN").alias("taker_side"),
    )


def funding_rates(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Funding points of either venue: a blank mark price is null, an absent type REGULAR (or NOT_PROVIDED where the venue has none)."""
    has = lambda *names: F.coalesce(*(F.col(n).cast("string") for n in names if n in rows.columns))
    typed = "rateType" in rows.columns or "fundingTime" in rows.columns
    kind = F.upper(F.coalesce(S.text_or_null(F.col("rateType")), F.lit("Regular"))) if "rateType" in rows.columns else F.lit("REGULAR" if typed else "NOT_PROVIDED")
    mark = S.number(S.text_or_null(F.col("markPrice").cast("string"))) if "markPrice" in rows.columns else F.lit(None).cast("decimal(38,18)")
    return rows.select(*keep, F.col("symbol"), S.epoch(has("fundingTime", "fundingRateTimestamp").try_cast("bigint"), "ms").alias("funding_time"), S.number(has("fundingRate")).alias("funding_rate"), mark.alias("mark_price"), kind.alias("rate_type"))


def open_interest(rows: DataFrame) -> DataFrame:
    """Open interest of either venue; both-sides and single-side figures stay apart and are never halved."""
    at = lambda n: S.number(F.col(n).cast("string")) if n in rows.columns else F.lit(None).cast("decimal(38,18)")
    base = F.coalesce(at("sumOpenInterest"), at("openInterest"))
    return rows.select("symbol", S.epoch(F.col("timestamp").try_cast("bigint"), "ms").alias("observation_time"), base.alias("open_interest_base"), at("sumOpenInterestValue").alias("open_interest_notional"), at("singleOpenInterest").alias("single_side_base"))


# Keys differ by letter case alone (e, E; s, S), which struct fields can't: payloads are read as maps.
OBJECT, OBJECTS = "map<string,string>", "array<map<string,string>>"


def _of(name: str, field: str) -> Column:
    return F.try_element_at(name, F.lit(field))


def stream_trades(envelopes: DataFrame) -> DataFrame:
    """Trades inside stream payloads of either shape, one row per trade with its place in the message.

    Needs envelope_id, payload, received_at. Malformed numbers and times are null and flagged;
    payloads that hold no trade yield no row. Equal trades at different places stay two rows.
    """
    parsed = envelopes.select("envelope_id", "received_at", F.from_json("payload", OBJECT).alias("one"), F.from_json(F.get_json_object("payload", "$.data"), OBJECTS).alias("many"))
    maker = S.loose_boolean(_of("one", "m"))
    single = F.when(_of("one", "e").isin("trade", "aggTrade"), F.array(F.struct(
        F.coalesce(_of("one", "t"), _of("one", "a")).alias("id"), _of("one", "s").alias("symbol"), _of("one", "p").alias("p"), _of("one", "q").alias("q"),
        _of("one", "T").alias("T"), F.when(maker, "SELL").when(~maker, "BUY").otherwise("UNKNOWN").alias("side"), (_of("one", "e") == "aggTrade").alias("aggregate"),
    )))
    batch = F.transform("many", lambda d: F.struct(
        d["i"].alias("id"), d["s"].alias("symbol"), d["p"].alias("p"), d["v"].alias("q"), d["T"].alias("T"), S.taker_side(d["S"]).alias("side"), F.lit(False).alias("aggregate"),
    ))
    rows = parsed.select("envelope_id", "received_at", F.posexplode(F.coalesce(single, batch)).alias("event_index", "t"))
    price, quantity, stamp = S.positive(F.col("t.p")), S.positive(F.col("t.q")), F.col("t.T").try_cast("bigint")
    flags = F.array_compact(F.array(
        F.when(price.isNull() | quantity.isNull() | stamp.isNull(), F.lit("MALFORMED_PAYLOAD")),
        F.when(F.col("t.side") == "UNKNOWN", F.lit("UNKNOWN_TAKER_SIDE")),
    ))
    return rows.select(
        "envelope_id", "event_index", F.when(F.col("t.aggregate"), "exchange_aggregate_trade").otherwise("individual_trade").alias("dataset_class"), F.col("t.id").alias("native_trade_id"), F.col("t.symbol").alias("native_symbol"),
        price.alias("price"), quantity.alias("quantity"), F.col("t.side").alias("taker_side"), F.coalesce(F.timestamp_millis(stamp), F.col("received_at")).alias("event_time"),
        F.col("received_at").alias("knowledge_time"), flags.alias("dq_flags"),
    )


def forced_orders(envelopes: DataFrame) -> DataFrame:
    """Forced orders inside single-order payloads; texts of numbers are kept as written, relations are flagged."""
    rows = envelopes.select("envelope_id", "received_at", F.get_json_object("payload", "$.e").alias("e"), F.get_json_object("payload", "$.E").try_cast("bigint").alias("sent"), F.from_json(F.get_json_object("payload", "$.o"), OBJECT).alias("o")).filter("e = 'forceOrder'")
    q, last, filled = (S.number(_of("o", c)) for c in ("q", "l", "z"))
    event = F.timestamp_millis(_of("o", "T").try_cast("bigint"))
    flags = F.array_compact(F.array(
        F.when(~F.coalesce((last <= filled) & (filled <= q), F.lit(False)), F.lit("QUANTITY_RELATION")),
        F.when(event > F.col("received_at") + F.expr("interval 5 minutes"), F.lit("FUTURE_TIMESTAMP")),
    ))
    return rows.select(
        "envelope_id", _of("o", "s").alias("symbol"), event.alias("event_time"), F.timestamp_millis("sent").alias("exchange_timestamp"), _of("o", "S").alias("source_side"),
        F.lit("UNKNOWN").alias("position_side_liquidated"), _of("o", "q").alias("source_quantity"), _of("o", "p").alias("source_price"), _of("o", "ap").alias("average_fill_price"), flags.alias("dq_flags"),
    )


def liquidation_batches(envelopes: DataFrame) -> DataFrame:
    """Liquidations inside batch payloads: a Buy liquidates a LONG, a Sell a SHORT; the place in the message is part of the identity.

    Other sides are null; :func:`batch_rules` says which rows to refuse.
    """
    topic = F.regexp_extract(F.coalesce(F.get_json_object("payload", "$.topic"), F.lit("")), r"\.([^.]+)\z", 1).alias("topic_symbol")
    parsed = envelopes.select("envelope_id", "message_id", "received_at", topic, F.posexplode(F.from_json(F.get_json_object("payload", "$.data"), OBJECTS)).alias("event_index", "d"))
    side = F.when(_of("d", "S") == "Buy", "LONG").when(_of("d", "S") == "Sell", "SHORT")
    return parsed.select(
        "envelope_id", "event_index", "topic_symbol", _of("d", "s").alias("symbol"), F.timestamp_millis(_of("d", "T").try_cast("bigint")).alias("event_time"), side.alias("position_side_liquidated"),
        S.positive(_of("d", "v")).alias("quantity"), S.positive(_of("d", "p")).alias("price"), F.col("received_at").alias("knowledge_time"),
        S.fingerprint([F.col("message_id"), F.col("event_index"), *(_of("d", f) for f in ("s", "T", "S", "v", "p"))]).alias("dedup_fingerprint"),
    )


def batch_rules() -> Mapping[str, Column]:
    """What a liquidation of a batch must meet: its topic's symbol, a side, a size, a price and a time."""
    c = F.col
    return {"topic": c("topic_symbol").eqNullSafe(c("symbol")), "side": c("position_side_liquidated").isNotNull(), "quantity": c("quantity") > 0, "price": c("price") > 0, "time": c("event_time").isNotNull()}


def order_rules(symbols: Sequence[str] | None = None) -> Mapping[str, Column]:
    """What a forced order must meet: a known symbol, BUY or SELL, a time, and positive numbers where they are stated."""
    c = F.col
    stated = lambda n: c(n).isNull() | (S.number(c(n)) > 0)
    known = c("symbol").isin(*symbols) if symbols is not None else F.nullif(c("symbol"), F.lit("")).isNotNull()
    return {"symbol": known, "side": c("source_side").isin("BUY", "SELL"), "time": c("event_time").isNotNull(), "quantity": stated("source_quantity"), "price": stated("source_price")}


def funding_rules(symbol: Column) -> Mapping[str, Column]:
    """What a funding point must meet: the symbol asked for, a time, a rate, and a positive mark price if any."""
    c = F.col
    return {"symbol": c("symbol").eqNullSafe(symbol), "time": c("funding_time").isNotNull(), "rate": c("funding_rate").isNotNull(), "mark": c("mark_price").isNull() | (c("mark_price") > 0)}


def envelopes(messages: DataFrame) -> DataFrame:
    """Raw messages (source, payload, received_at) with the hash of the payload's sorted form and the hash of its text."""
    canonical = F.to_json(F.expr("try_parse_json(payload)"))
    return messages.withColumns({"payload_hash": F.sha2(canonical, 256), "message_id": F.sha2("payload", 256)}).withColumn("envelope_id", F.concat(F.lit("env_"), F.substring("message_id", 1, 16)))
