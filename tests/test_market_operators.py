"""Market-data operators: golden cases, hard inputs and invariants."""

import datetime as dt
import decimal
import json
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions import normalize, scalars
from marlstone.operators import asof, buckets, features, merge, quality, reconcile, retention, sequence
from marlstone.session import scratch
from marlstone.sources import archives, catalog, pages
from marlstone.streaming import jobs

TRADES = "k string, event_us bigint, price decimal(38,18), quantity decimal(38,18), side string, source_ordinal bigint, native_trade_id string"
D = Decimal


def test_two_trades_in_a_bucket(spark):
    rows = spark.createDataFrame([("i", 600_000, D(7), D(4), "BUY", 0, "1"), ("i", 4_200_000, D(6), D(3), "SELL", 1, "2"), ("i", None, D(1), D(1), "BUY", 2, "3"), ("i", 9_000_000, D(5), D(1), None, 3, "4")], TRADES)
    got = {r["bucket_start_us"]: r for r in buckets.trade_buckets(rows, ["k"], [5], median=True).collect()}
    b = got[0]
    assert (b["trade_count"], b["base_volume"], b["quote_volume"], b["base_delta"], b["quote_delta"]) == (2, 7, 46, 1, 10)
    assert (b["open"], b["high"], b["low"], b["close"], b["avg_size"], b["median_size"], b["max_size"]) == (7, 7, 6, 6, D("3.5"), D("3.5"), 4)
    assert got[5_000_000]["buy_count"] == got[5_000_000]["sell_count"] == 0 and len(got) == 2
    assert buckets.trade_buckets(rows.limit(0), ["k"]).count() == 0
    p = buckets.input_problems(rows, ["k"]).first()
    assert (p["rows"], p["without_time"], p["unknown_side"], p["tied_order"]) == (4, 1, 1, 0)


def test_sizes_round_once_and_to_the_even_digit(spark):
    cases = [("5e-18", 2), ("7e-18", 2), ("1e-18", 3), ("2e-18", 3), ("-5e-18", 2), ("-7e-18", 2), ("10", 3), ("0", 7), ("1.0000000000000000005e9", 1)]
    cases += [("0.000000000000000001", 199), ("0.000000000000000100", 199), ("12345678.000000000000000001", 2)]
    data = [(D(t).quantize(D("1e-18")), n) for t, n in cases] + [(D(1), 0), (None, 2)]
    got = [r[0] for r in spark.createDataFrame(data, "t decimal(38,18), n bigint").select(scalars.mean_half_even(F.col("t"), F.col("n"))).collect()]
    with decimal.localcontext(decimal.Context(prec=80, rounding=decimal.ROUND_HALF_EVEN)):
        assert got == [(t / n).quantize(D("1e-18")) if n and t is not None else None for t, n in data]
    pairs = spark.createDataFrame([(D("2e-18"), D("3e-18")), (D("3e-18"), D("4e-18")), (D(1), D(4))], "a decimal(38,18), b decimal(38,18)")
    assert [r[0] for r in pairs.select(F.bround(scalars.middle(F.col("a"), F.col("b")), 18)).collect()] == [D("2e-18"), D("4e-18"), D("2.5")]


def test_rollup_equals_direct_buckets(spark, rows):
    data = [("ab"[i % 2], i * 700_000, D(100 + i % 7), D(1 + i % 3), ("BUY", "SELL", "UNKNOWN")[i % 3], i, str(i)) for i in range(400)]
    df = spark.createDataFrame(data, TRADES)
    names = ["k", "bucket_start_us", "trade_count", "open", "high", "low", "close", "base_volume", "quote_delta", "max_size"]
    assert rows(buckets.rollup(buckets.trade_buckets(df, ["k"], [5]), ["k"], 60).select(names)) == rows(buckets.trade_buckets(df, ["k"], [60]).select(names))


def test_scalars(spark):
    one = spark.range(1)
    at = lambda c: one.select(c).first()[0]
    s = F.lit
    assert at(scalars.float_seconds_us(s("1614556800.123456"))) == 1614556800123456
    assert at(scalars.floor_us(s(-1), 5)) == -5_000_000
    assert [at(scalars.taker_side(s(x))) for x in (" buy", "S", "x", None)] == ["BUY", "SELL", "UNKNOWN", "UNKNOWN"]
    assert at(scalars.product(s("58603.40").cast("decimal(38,18)"), s("0.001").cast("decimal(38,18)"))) == D("58.6034")
    assert [at(scalars.strict_boolean(s(x))) for x in ("True", "true", None)] == [True, None, None]
    assert at(scalars.number(s("1e3"))) == 1000 and at(scalars.number(s("x"))) is None and at(scalars.positive(s("-1"))) is None
    assert at(scalars.compatible(s("2.0.1"), s("2.9.0"))) and at(scalars.version_part(s("2.0"), 0)) is None
    assert at(scalars.path_time(s("a/date=2021-03-01/x.parquet"))) == dt.datetime(2021, 3, 1, 23, 59, 59)
    assert at(scalars.path_time(s("a/x-2021-03-01T04_05_06.parquet"))) == dt.datetime(2021, 3, 1, 4, 5, 6) and at(scalars.path_time(s("a/b"))) is None
    assert at(scalars.redacted(s('{"token": "s\\"ecret", "b": 1} key=abc&x=1'), ["token", "key"])) == '{"token": "***", "b": 1} key=***&x=1'
    assert at(scalars.archive_unit(s("2025-01-01"))) == "us" and at(scalars.archive_unit(s("2024-12-31"))) == "ms"
    assert at(scalars.knowable(s(None).cast("timestamp"), F.current_timestamp())) is False


def test_instrument_ids(spark):
    # The ids that the public hashing rule gives for these perpetuals.
    want = {("binance", "BTC"): "ins_dae8124762a847d14263", ("binance", "ETH"): "ins_13dce2c0972bec4044d9", ("bybit", "BTC"): "ins_843e0aeb9de581e61b56", ("bybit", "ETH"): "ins_c4c118aced7726321b3c"}
    df = spark.createDataFrame([(e.upper(), b.lower(), i) for (e, b), i in want.items()], "e string, b string, i string")
    made = scalars.instrument_id(F.col("e"), F.concat("b", F.lit("usdt")), F.lit("perpetual"), F.lit("linear_perpetual"), F.col("b"), F.lit("USDT"), F.lit("USDT"))
    assert df.filter(made == F.col("i")).count() == 4


def test_sequences(spark, rows):
    df = spark.createDataFrame([("a", 0), ("a", 60), ("a", 60), ("a", 240), ("b", None), ("b", 5)], "k string, t bigint")
    assert rows(sequence.gaps(df, ["k"], "t", 60)) == [("a", 120, 240, 2)]
    assert rows(sequence.repeated_keys(df, ["k", "t"])) == [("a", 60, 2)]
    log = spark.createDataFrame([("x", 1, "a"), ("x", 3, "c"), ("x", 3, "b"), (None, 2, None)], "k string, seq bigint, v string")
    assert rows(sequence.latest(log, ["k"], ["seq"])) == sorted([("x", 3, "c"), (None, 2, None)], key=repr)
    ids = spark.createDataFrame([("p", i) for i in (1, 2, 2, 3, 4)] + [("q", 1), ("q", 2), ("q", 4)], "k string, n bigint")
    bounds = spark.createDataFrame([("p", 1, 4), ("q", 1, 4), ("none", 1, 4), ("next", 7, 8), ("open", None, 3)], "k string, low bigint, high bigint")
    proofs = {r["k"]: (r["found"], r["needed"], r["proven"]) for r in sequence.continuity(ids, bounds, ["k"], "n", "low", "high").collect()}
    assert proofs == {"p": (2, 2, True), "q": (1, 2, False), "none": (0, 2, False), "next": (0, 0, True), "open": (0, None, False)}
    seqs = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, None), ("a", 4, 9), ("b", 1, None)], "k string, o int, v int")
    for block in (1, 3, 100):
        assert [r["o"] for r in sequence.out_of_order(seqs, ["k"], "o", F.col("v"), block).orderBy("o").collect()] == [2, 3, 4]


@pytest.mark.parametrize("block", [1, 7, 10**9])
def test_asof_looks_back_across_blocks(spark, block):
    left = spark.createDataFrame([("a", 10), ("a", 14), ("a", 40), ("a", 2), ("a", None), ("b", 9), (None, 10)], "k string, t bigint").withColumn("v", F.lit("left"))
    right = spark.createDataFrame([("a", 3, "x"), ("a", 10, "y"), ("a", 10, "z"), ("a", None, "n"), (None, 1, "w")], "k string, r bigint, v string")
    got = {(r["k"], r["t"]): (r["asof_v"], r["asof_age_us"], r["match_quality"], r["v"]) for r in asof.backward(left, right, ["k"], "t", "r", ["v"], 5, block_us=block).collect()}
    assert got == {("a", 10): ("z", 0, "exact_available", "left"), ("a", 14): ("z", 4, "asof_fresh", "left"), ("a", 40): (None, None, "stale", "left"), ("a", 2): (None, None, "missing", "left"),
                   ("a", None): (None, None, "missing", "left"), ("b", 9): (None, None, "missing", "left"), (None, 10): (None, None, "missing", "left")}
    assert asof.backward(left, right.limit(0), ["k"], "t", "r", ["v"], 5).count() == 7 and asof.backward(left.limit(0), right, ["k"], "t", "r", ["v"], 5).count() == 0


SIDE = "key string, price decimal(38,18), quantity decimal(38,18), side string, time_ms bigint, ordinal bigint"


def test_three_way_reconciliation(spark):
    make = lambda *x: spark.createDataFrame(x, SIDE)
    archive = make(("1", D("1.0"), D(1), "BUY", 5, 0), ("1", D(9), D(1), "BUY", 5, -1), ("2", D(1), D(1), "BUY", 5, 0), ("3", D(1), D(1), "BUY", 5, 0), (None, D(1), D(1), "", 0, 0))
    ws = make(("1", D(1), D(1), "BUY", 5, 0), ("2", D(2), D(1), "SELL", 5, 0), ("4", D(1), D(1), "", 0, 0))
    keyed = reconcile.three_way({"archive": archive, "ws": ws})
    s = reconcile.summary(keyed).first()
    assert (s["matched"], s["missing_in_ws"], s["missing_in_archive"], s["field_conflict"], s["side_conflict"], s["missing_in_rest"], s["coverage_proven"]) == (1, 1, 1, 1, 1, 0, False)
    assert float(s["match_rate"]) == 33.33
    assert [(r["key"], r["kinds"]) for r in reconcile.details(keyed, 2).collect()] == [("2", "field_conflict,side_conflict"), ("3", "missing_in_ws")]
    alone = reconcile.summary(reconcile.three_way({"archive": archive.limit(0), "ws": ws})).first()
    assert (alone["matched"], alone["missing_in_archive"]) == (3, 0)


def test_merges_are_idempotent_and_order_free(spark, rows):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c", 7), (3, "d", 8)], "k int, v string, w int")
    merged = merge.keyed(old, new, ["k"])
    assert rows(merged) == [(1, "a", None), (2, "c", 7), (3, "d", 8)] and rows(merge.keyed(merged, new, ["k"])) == rows(merged)
    assert rows(merge.keyed(old, new, ["k"], new_wins=False)) == [(1, "a", None), (2, "b", None), (3, "d", 8)]
    f = lambda df: rows(merge.content_fingerprint(df, ["k", "v"]))
    assert f(old) == f(old.repartition(3)) != f(old.distinct()) and f(old.limit(0))[0][0] == 0


def test_active_files(spark, rows):
    schema = "object_id string, created_parquets array<string>, hashes array<string>, action string, seq bigint, cls string"
    log = spark.createDataFrame([
        ("a.parquet", None, ["h1"], "NORMALIZED", 1, "t"), ("m", ["b.parquet", "c.parquet"], ["h2", "h3"], None, 2, "t"), ("a.parquet", None, ["h1"], "SUPERSEDED", 3, "t"),
        ("b.parquet", None, ["h4"], "INGESTED", 4, "t"), ("x/c.parquet", None, None, "QUARANTINED", 5, "t"), ("y=1/o.parquet", None, None, "COMPACTED", 6, "oi"), ("y=1/p.parquet", None, None, "COMPACTED", 7, "oi"), ("y=2/o2.parquet", None, None, "COMPACTED", 5, "oi"),
    ], schema)
    refs = merge.references(log)
    assert rows(refs.select("seq", "ref", "sha256").filter("seq <= 2")) == [(1, "a.parquet", "h1"), (2, "b.parquet", "h2"), (2, "c.parquet", "h3")]
    both = spark.createDataFrame([("a.parquet", ["b.parquet", "c.parquet", "d.parquet"], ["h1", "h2"])], "object_id string, created_parquets array<string>, hashes array<string>")
    assert rows(merge.references(both)) == sorted([("a.parquet", "h1"), ("b.parquet", "h2"), ("c.parquet", None), ("d.parquet", None)], key=repr)
    files = spark.createDataFrame([("b.parquet", "other")], "ref string, sha256 string")
    listed = spark.createDataFrame([("b.parquet", "h4"), ("y.parquet", None)], "ref string, sha256 string")
    assert rows(merge.broken_references(listed, files)) == [("b.parquet", "hash_mismatch"), ("y.parquet", "missing")]


def test_quality(spark, rows):
    df = spark.createDataFrame([("a", "1", "BUY"), ("a", "1", "sell"), ("a", None, None), (None, None, "x")], "k string, id string, side string")
    assert [tuple(r)[:4] for r in quality.measures(df, ["k"], ["id"], "side").orderBy("k").collect()] == [("UNKNOWN", 1, 0, 1), ("a", 3, 1, 1)]
    good, bad = quality.split(df, {"id": F.col("id").isNotNull(), "side": F.upper("side").isin("BUY", "SELL")})
    assert good.count() == 2 and rows(bad.select("violations")) == [(["id", "side"],), (["id", "side"],)]
    assert quality.require(good, {"id": F.col("id") == "1"}).count() == 2
    with pytest.raises(Exception, match="rules broken: id"):
        quality.require(df, {"id": F.col("id") == "1"}).count()
    m = spark.createDataFrame([("a", 1.0, True), ("a", None, True), ("b", 2.0, True), ("c", 1.0, False), ("d", 1.0, True)], "metric string, value double, applicable boolean")
    p = spark.createDataFrame([("a", "MAX", 1.0), ("b", "MIN", 3.0), ("d", "CATEGORICAL", None)], "metric string, comparison string, threshold double")
    assert rows(quality.evaluate(m, p).select("metric", "evaluation")) == [("a", "PASS"), ("a", "UNKNOWN"), ("b", "FAIL"), ("c", "NOT_APPLICABLE"), ("d", "PASS")]


def test_retention(spark, rows):
    now = F.lit("2021-04-30 00:00:00").cast("timestamp")
    day = lambda n: dt.datetime(2021, 4, 30) - dt.timedelta(days=n)
    objects = spark.createDataFrame([(f"d/{n}.parquet", day(n)) for n in (3, 44, 45, 46)] + [("held/x", day(99)), ("e/held.parquet", day(99)), ("n", None)], "ref string, modified timestamp")
    aged = retention.aged(objects, spark.createDataFrame([("z/46.parquet", day(46)), ("46.parquet", day(46))], "ref string, coverage_end timestamp"), F.col("modified"))
    assert dict(rows(aged.select("ref", "age_basis")))["d/46.parquet"] == "MANIFEST_NAME"
    holds = spark.createDataFrame([("held/",), ("e/held.parquet",), ("held",)], "hold string")
    got = dict(rows(retention.candidates(aged, holds, now, 45).select("ref", "decision")))
    assert got == {"d/3.parquet": "KEEP", "d/44.parquet": "KEEP", "d/45.parquet": "KEEP", "d/46.parquet": "DELETE", "held/x": "HELD", "e/held.parquet": "HELD", "n": "KEEP"}


def test_features(spark):
    bars = spark.createDataFrame([("a", i, 100.0 + i, 101.0 + i, 99.0 + i, 1.0) for i in range(30)] + [("b", 0, None, None, None, None)], "k string, t bigint, c double, h double, l double, v double")
    rolled = {r["t"]: r for r in features.rolling(bars, ["k"], "t", "c", "v", 5).filter("k = 'a'").collect()}
    assert rolled[10]["sma"] == 108.0 and rolled[10]["momentum"] == 5.0 and rolled[0]["return"] is None and rolled[10]["volume_z"] is None
    labelled = {r["t"]: r for r in features.labels(bars, ["k"], "t", "c", "h", "l", 3, 0.001).filter("k = 'a'").collect()}
    assert labelled[0]["label"] == "UP" and labelled[28]["label"] is None and labelled[28]["best"] is None
    found = features.recursive_indicators(bars, ["k"], "t", "h", "l", "c").filter("t = 29").first()
    assert found["rsi"] == 100.0 and found["adx"] > 90 and abs(found["atr"] - 2) < 1e-9


def test_indicators_in_blocks_equal_one_pass(spark):
    import math
    import random

    import pandas as pd

    r, data = random.Random(8), []
    for k in ("a", "b"):
        price = 100.0
        for t in range(60):
            price = price if t < 4 or 20 < t < 25 else price + r.gauss(0, 1)  # without a move at first, and for a while
            data.append((k, t * 10 + (0 if t % 9 else 3), price + 1, price - 1, price))
    data += [("a", 300, 101.0, 99.0, 100.0), ("a", 300, 102.0, 99.0, 101.0), ("a", None, 1.0, 1.0, 1.0), ("c", 5, 2.0, 1.0, 1.5)]
    df = spark.createDataFrame(data, "k string, t bigint, h double, l double, c double")

    def whole(x, n=14):
        x = x.sort_values(["t", "h", "l", "c"]).reset_index(drop=True)
        smooth = lambda s: s.ewm(alpha=1 / n, adjust=False, ignore_na=True).mean()
        step, up, down = x["c"].diff(), x["h"].diff(), -x["l"].diff()
        gain, loss = smooth(step.clip(lower=0)), smooth((-step).clip(lower=0))
        tr = pd.concat([x["h"] - x["l"], (x["h"] - x["c"].shift()).abs(), (x["l"] - x["c"].shift()).abs()], axis=1).max(axis=1)
        plus, minus = smooth(up.where((up > down) & (up > 0), 0.0)), smooth(down.where((down > up) & (down > 0), 0.0))
        spread = (plus - minus).abs() / (plus + minus).where(plus + minus > 0)
        return pd.DataFrame({"t": x["t"], "ema": x["c"].ewm(span=n, adjust=False).mean(), "rsi": 100 * gain / (gain + loss).where(gain + loss > 0), "atr": smooth(tr), "adx": 100 * smooth(spread)})

    for block in (35, 10_000):
        got = features.recursive_indicators(df, ["k"], "t", "h", "l", "c", block_us=block).toPandas()
        for k, rows_ in df.toPandas().dropna().groupby("k"):
            mine, want = got[got.k == k], whole(rows_)
            one, two = (sorted(tuple(-1.0 if math.isnan(v) else round(v, 8) for v in row) for row in f[["t", "ema", "rsi", "atr", "adx"]].astype(float).itertuples(index=False)) for f in (mine, want))
            assert one == two, (block, k)
    assert features.recursive_indicators(df.limit(0), ["k"], "t", "h", "l", "c").count() == 0


def test_normalisers(spark, rows):
    k = spark.createDataFrame([("1614556800000", "10", "12", "9", "11", "5", "1614556859999", "55", "3", "2", "22", "0"), ("1614556800001", "10", "9", "12", "11", "-1", "x", "55", "3", "9", "22", "0")], ", ".join(f"c{i} string" for i in range(12)))
    made = normalize.kline_rows(k, "ms").withColumn("bad", quality.violations(normalize.candle_rules()))
    assert rows(made.select("bad")) == [(["aligned", "closes_with_interval", "low_lowest", "high_highest", "volumes", "taker_base"],), ([],)]
    short = normalize.short_kline_rows(spark.createDataFrame([("1614556800000", "1", "2", "1", "2", "3", "4")], ", ".join(f"c{i} string" for i in range(7))))
    assert short.first()["trade_count"] is None and short.select(quality.violations(normalize.candle_rules())).first()[0] == []
    t = normalize.archive_trades(spark.createDataFrame([("1", "10", "2", "20", "1614556800000", "True"), ("2", "0", "2", "20", "1614556800000", "maybe")], "id string, price string, qty string, quote_qty string, time string, is_buyer_maker string"), "ms")
    assert [(r["taker_side"], r["signed_quantity"], r["price"]) for r in t.orderBy("native_trade_id").collect()] == [("SELL", -2, 10), ("UNKNOWN", 0, None)]
    v = normalize.venue_trades(spark.createDataFrame([("u", "1614556800.5", "10", "2", "Buy")], "trdMatchID string, timestamp string, price string, size string, side string")).first()
    assert v["event_time"] == dt.datetime(2021, 3, 1, 0, 0, 0, 500000) and v["quote_quantity"] == 20
    a = normalize.aggregate_trades(spark.createDataFrame([("7", "1", "2", "3", "5", "1614556800000", "false")], "agg_id string, price string, qty string, first_id string, last_id string, time string, is_buyer_maker string"), "ms").first()
    assert (a["first_trade_id"], a["last_trade_id"], a["taker_side"], a["dataset_class"]) == (3, 5, "BUY", "exchange_aggregate_trade")
    f = normalize.funding_rates(spark.createDataFrame([("B", "1614556800000", "0.0001", " ", None)], "symbol string, fundingTime string, fundingRate string, markPrice string, rateType string")).first()
    assert f["mark_price"] is None and f["rate_type"] == "REGULAR"
    assert normalize.funding_rates(spark.createDataFrame([("B", "1614556800000", "1")], "symbol string, fundingRateTimestamp string, fundingRate string")).first()["rate_type"] == "NOT_PROVIDED"
    o = normalize.open_interest(spark.createDataFrame([("B", "1614556800000", "5", "3")], "symbol string, timestamp string, openInterest string, singleOpenInterest string")).first()
    assert (o["open_interest_base"], o["single_side_base"], o["open_interest_notional"]) == (5, 3, None)


def test_payloads(spark, rows):
    at = dt.datetime(2021, 3, 1)
    one = {"e": "trade", "E": 2, "s": "X", "t": 9, "p": "1.5", "q": "2", "T": 1614556800000, "m": True}
    many = {"topic": "t", "ts": 1, "data": [{"T": 1, "s": "X", "S": "Buy", "v": "1", "p": "2", "i": "a", "seq": 1}] * 2 + [{"T": None, "s": "X", "S": "?", "v": "bad", "p": "2"}]}
    force = {"e": "forceOrder", "E": 5, "o": {"s": "X", "S": "SELL", "q": "1.0", "p": "2", "ap": "2", "l": "3", "z": "1", "T": 1714556800000}}
    df = spark.createDataFrame([("1", json.dumps(one), at, "m1"), ("2", json.dumps(many), at, "m2"), ("3", json.dumps(force), at, "m3"), ("4", "broken", at, "m4"), ("5", None, at, "m5")], "envelope_id string, payload string, received_at timestamp, message_id string")
    got = rows(normalize.stream_trades(df).select("envelope_id", "event_index", "taker_side", "price", "dq_flags"))
    assert got == [("1", 0, "SELL", D("1.5"), []), ("2", 0, "BUY", 2, []), ("2", 1, "BUY", 2, []), ("2", 2, "UNKNOWN", 2, ["MALFORMED_PAYLOAD", "UNKNOWN_TAKER_SIDE"])]
    assert rows(normalize.forced_orders(df).select("source_quantity", "dq_flags")) == [("1.0", ["QUANTITY_RELATION", "FUTURE_TIMESTAMP"])]
    batch = normalize.liquidation_batches(df)
    assert batch.count() == 3 and batch.select("dedup_fingerprint").distinct().count() == 3 and batch.first()["position_side_liquidated"] == "LONG"
    enveloped = normalize.envelopes(spark.createDataFrame([('{"b":1,"a":2}',), ('{"a":2, "b":1}',)], "payload string"))
    assert enveloped.select("payload_hash").distinct().count() == 1 and enveloped.select("message_id").distinct().count() == 2


def test_archives(spark, rows, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("X-trades-2021-03-01.csv", "id,price\n1,2\n3,4,5\n6,7\n")
    got = rows(archives.zip_csv(spark, str(tmp_path / "a.zip"), ["id", "price"], r"X-trades-.*\.csv").select("ordinal", "id", "price", "_corrupt"))
    assert got == [(1, "1", "2", None), (2, None, None, "3,4,5"), (3, "6", "7", None)]
    with pytest.raises(Exception, match="unexpected members"):
        archives.zip_lines(spark, str(tmp_path / "a.zip"), "other").count()
    (tmp_path / "log.jsonl").write_text('{"a": 1}\n\nnot json\n')
    assert rows(archives.json_lines(spark, str(tmp_path / "log.jsonl"), "a int").select("a", "_corrupt_record")) == sorted([(1, None), (None, "not json")], key=repr)
    spark.range(3).write.parquet(str(tmp_path / "p1"))
    spark.range(2).withColumn("x", F.lit("y")).write.parquet(str(tmp_path / "p2"))
    assert sorted(archives.parquet_union(spark, [str(tmp_path / "p1"), str(tmp_path / "p2")]).columns) == ["filename", "id", "x"]
    assert archives.parquet_union(spark, [], T.StructType([T.StructField("id", T.LongType())])).columns == ["id", "filename"]
    assert catalog.inventory(spark, str(tmp_path), "*.jsonl").count() == 1


def test_recorded_pages(spark, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps({"list": [[str(t), "x"] for t in range(9, 4, -1)]}))
    (tmp_path / "2.json").write_text(json.dumps({"list": [[str(t), "x"] for t in range(5, -1, -1)]}))
    pages.register(spark)
    df = spark.read.format("recorded_pages").options(path=str(tmp_path), start_ms="1", end_ms="9", slices="3", limit="2").load()
    assert sorted(r["time_ms"] for r in df.collect()) == list(range(1, 9))


def test_streams(spark, rows, tmp_path):
    spark.range(0, 20).selectExpr("timestamp_seconds(id * 60) as ts", "id % 2 as k", "cast(id as double) as v").repartition(4).write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = jobs.file_stream(spark, str(tmp_path / "in"), schema, 1)
    q = jobs.capture(stream, str(tmp_path / "raw"), str(tmp_path / "norm"), lambda df: df.filter("v >= 10"), str(tmp_path / "c1"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 20 and spark.read.parquet(str(tmp_path / "norm")).count() == 10
    keeper = jobs.LateCorrections(spark, scratch(spark, "k"), {"k": "bigint"}, "double", 300_000_000, 1_800_000_000)
    timed = jobs.file_stream(spark, str(tmp_path / "in"), schema, 1).selectExpr("k", "unix_micros(ts) as event_us", "unix_micros(ts) + 200000000 as arrival_us", "v as value")
    keeper.run(timed, str(tmp_path / "c2")).awaitTermination()
    whole = spark.read.parquet(str(tmp_path / "in")).selectExpr("k", "unix_micros(ts) as event_us", "unix_micros(ts) + 200000000 as arrival_us", "v as value")
    before = rows(keeper.state())
    assert sum(r[3] + r[4] for r in before) == 20 and any(r[4] for r in before)
    keeper.apply(whole, 0)  # a batch that comes again changes nothing
    assert rows(keeper.state()) == before


def test_venue_ratios_cover_every_market_and_symbol(spark, monkeypatch):
    from marlstone.plans import market_queries

    data = [(e, m, s, "2024-01-01 00:00:00", p) for m in ("spot", "perpetual") for s in ("BTCUSDT", "ETHUSDT") for e, p in (("binance", 2.0), ("bybit", 1.0))]
    trades = spark.createDataFrame(data, "exchange string, market_type string, native_symbol string, event_time string, price double").withColumn("event_time", F.to_timestamp("event_time"))
    monkeypatch.setattr(market_queries, "table", lambda *a: trades)
    got = market_queries.QUERIES["venue_ratios"](spark, "").collect()
    assert len(got) == 4 and all((r["slots"], r["median"]) == (1, 2.0) for r in got)
