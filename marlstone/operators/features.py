"""Rolling features, recursive indicators, forward labels and backtest measures over bars."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.operators import asof, merge, multiset
from marlstone.session import keep


def rolling(bars: DataFrame, keys: Sequence[str], time_us: str, close: str, volume: str, n: int = 20) -> DataFrame:
    """``bars`` with return, log_return, sma, volatility (sample), momentum, volume_z and drawn-in range over ``n`` bars.

    Windows that aren't full yet use the bars there are; a single bar has no deviation (null).
    """
    w = Window.partitionBy(*keys).orderBy(time_us)
    back = w.rowsBetween(-n + 1, 0)
    price, before = F.col(close).cast("double"), F.lag(F.col(close).cast("double")).over(w)
    positive = lambda x: F.when(x > 0, x)
    first = bars.withColumns({"return": price / F.nullif(before, F.lit(0.0)) - 1, "log_return": F.ln(positive(price) / positive(before))})
    size = F.col(volume).cast("double")
    return first.withColumns({
        "sma": F.avg(price).over(back),
        "volatility": F.stddev_samp("log_return").over(back),
        "momentum": price - F.lag(price, n).over(w),
        "volume_z": (size - F.avg(size).over(back)) / F.nullif(F.stddev_samp(size).over(back), F.lit(0.0)),
        "rolling_high": F.max(price).over(back),
        "rolling_low": F.min(price).over(back),
    })


def cumulative_delta(bars: DataFrame, keys: Sequence[str], time_us: str, delta: str) -> DataFrame:
    """``bars`` with cvd (running sum of the delta) and its acceleration (change of the delta)."""
    w = Window.partitionBy(*keys).orderBy(time_us)
    return bars.withColumns({"cvd": F.sum(delta).over(w.rowsBetween(Window.unboundedPreceding, 0)), "cvd_acceleration": F.col(delta) - F.lag(delta).over(w)})


def large_flow(trades: DataFrame, keys: Sequence[str], quantity: str, side: str, quantile: float = 0.99) -> DataFrame:
    """Per keys the exact size threshold of the quantile, and what trades at or above it bought and sold."""
    limit = multiset.quantiles(trades, keys, quantity, [quantile]).select(*keys, F.col("q0").alias("threshold"))
    large = trades.join(limit, list(keys)).filter(F.col(quantity).cast("double") >= F.col("threshold"))
    of = lambda s: F.coalesce(F.sum(F.when(F.col(side) == s, F.col(quantity).cast("double"))), F.lit(0.0))
    return large.groupBy(*keys).agg(F.max("threshold").alias("threshold"), F.count(F.lit(1)).alias("large_trades"), of("BUY").alias("large_buy"), of("SELL").alias("large_sell")).withColumn("large_delta", F.col("large_buy") - F.col("large_sell"))


def _smoothed(x: pd.Series, alpha: float, start: float | None) -> pd.Series:
    """x smoothed from the value ``start`` that went before it, or from its own first one; unknown values keep the last."""
    if start is None or start != start:
        return x.ewm(alpha=alpha, adjust=False, ignore_na=True).mean()
    return pd.concat([pd.Series([start]), x]).ewm(alpha=alpha, adjust=False, ignore_na=True).mean().iloc[1:]


def _carried(rows: DataFrame, keys: Sequence[str], series: Mapping[str, float], prepared: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """(keys..., __block, __in_<series>...): the smoothed value each block of rows starts from, null where a series hasn't begun.

    A block turns the value before it into (1 - alpha)^m of it plus what its own m values add, so
    blocks are summed up side by side, and only these sums are gone through in order.
    """
    types = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys]
    sums = ", ".join([*types, "__block bigint", *(f"`{p}_{s}` double" for s in series for p in ("m", "s", "f"))])

    def summed(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        made, out = prepared(pdf), dict(zip([*keys, "__block"], key))
        for name, alpha in series.items():
            x = made[name].reset_index(drop=True)
            known = x.dropna()
            out |= {f"m_{name}": len(known), f"s_{name}": _smoothed(x, alpha, 0.0).iloc[-1] if len(known) else 0.0, f"f_{name}": known.iloc[0] if len(known) else None}
        return pd.DataFrame([out])

    def chained(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__block").reset_index(drop=True)
        out = pdf[[*keys, "__block"]].copy()
        for name, alpha in series.items():
            value, starts = None, []
            for m, s, f in zip(pdf[f"m_{name}"], pdf[f"s_{name}"], pdf[f"f_{name}"]):
                starts.append(value)
                if m:
                    value = (1 - alpha) ** m * (f if value is None else value) + s
            out[f"__in_{name}"] = pd.Series(starts, dtype=float)
        return out

    ends = ", ".join([*types, "__block bigint", *(f"`__in_{s}` double" for s in series)])
    return rows.groupBy(*keys, "__block").applyInPandas(summed, sums).groupBy(*keys).applyInPandas(chained, ends)


def recursive_indicators(bars: DataFrame, keys: Sequence[str], time_us: str, high: str, low: str, close: str, n: int = 14, block_us: int = 7 * 86_400_000_000) -> DataFrame:
    """EMA, RSI, ATR and ADX (Wilder's smoothing, seeded with the first value) per keys.

    Where neither direction moved, ADX keeps its value (null until a first move); RSI is null until
    then. Bars at one time follow by high, low and close. Smoothing is linear, so a key's bars are
    cut into blocks of time that are computed side by side, each from the value that the sums of
    the blocks before it give. Rows with nulls in the inputs or without key are left out.
    """
    one, fast = 1 / n, 2 / (n + 1)
    rows = bars.select(*keys, F.col(time_us).cast("bigint").alias("__t"), *(F.col(c).cast("double").alias(a) for c, a in ((high, "h"), (low, "l"), (close, "c")))).dropna()
    rows = rows.withColumn("__block", F.floor(F.col("__t") / block_us).cast("bigint"))
    last = rows.groupBy(*keys, "__block").agg(F.max(F.struct("__t", "h", "l", "c")).alias("__end"))
    before = last.select(*keys, "__block", F.lag("__end").over(Window.partitionBy(*keys).orderBy("__block")).alias("__p"))
    rows = rows.join(before, [*keys, "__block"]).select(*keys, "__block", "__t", "h", "l", "c", *(F.col(f"__p.{x}").alias(f"__p{x}") for x in "hlc"))
    moves = {"close": fast, "gain": one, "loss": one, "range": one, "plus": one, "minus": one}

    def moved(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["__t", "h", "l", "c"], kind="stable").reset_index(drop=True)
        past = {x: pdf[x].shift().fillna(pdf[f"__p{x}"].iloc[0]) if pdf[f"__p{x}"].notna().iloc[0] else pdf[x].shift() for x in "hlc"}
        step, up, down = pdf["c"] - past["c"], pdf["h"] - past["h"], past["l"] - pdf["l"]
        out = pdf[[*keys, "__t"]].copy()
        out["close"], out["gain"], out["loss"] = pdf["c"], step.clip(lower=0), (-step).clip(lower=0)
        out["range"] = pd.concat([pdf["h"] - pdf["l"], (pdf["h"] - past["c"]).abs(), (pdf["l"] - past["c"]).abs()], axis=1).max(axis=1)
        out["plus"], out["minus"] = up.where((up > down) & (up > 0), 0.0), down.where((down > up) & (down > 0), 0.0)
        return out

    types = [f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys]

    def indicated(pdf: pd.DataFrame) -> pd.DataFrame:
        made = moved(pdf)
        smooth = {x: _smoothed(made[x], a, pdf[f"__in_{x}"].iloc[0]).reset_index(drop=True) for x, a in moves.items()}
        both, ways = smooth["gain"] + smooth["loss"], smooth["plus"] + smooth["minus"]
        out = made[[*keys, "__t"]].copy()
        out["__block"], out["__at"] = pdf["__block"].iloc[0], range(len(out))
        out["ema"], out["atr"] = smooth["close"], smooth["range"]
        out["rsi"] = 100 * smooth["gain"] / both.where(both > 0)
        out["__spread"] = (smooth["plus"] - smooth["minus"]).abs() / ways.where(ways > 0)
        return out

    first = rows.join(_carried(rows, keys, moves, moved), [*keys, "__block"])
    halves = keep(first.groupBy(*keys, "__block").applyInPandas(indicated, ", ".join([*types, "__t bigint", "__block bigint", "__at bigint", "ema double", "atr double", "rsi double", "__spread double"])), "indicators")
    spread = lambda pdf: pdf.sort_values("__at").rename(columns={"__spread": "spread"})

    def directed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__at").reset_index(drop=True)
        out = pdf[[*keys, "__t", "ema", "rsi", "atr"]].copy()
        out["adx"] = 100 * _smoothed(pdf["__spread"], one, pdf["__in_spread"].iloc[0]).reset_index(drop=True)
        return out

    second = halves.join(_carried(halves, keys, {"spread": one}, spread), [*keys, "__block"])
    found = second.groupBy(*keys, "__block").applyInPandas(directed, ", ".join([*types, "__t bigint", "ema double", "rsi double", "atr double", "adx double"]))
    return found.select(*keys, F.col("__t").alias(time_us), "ema", "rsi", "atr", "adx")


def labels(bars: DataFrame, keys: Sequence[str], time_us: str, close: str, high: str, low: str, horizon: int, band: float) -> DataFrame:
    """``bars`` with future_return over ``horizon`` bars, best and worst excursion until then, and UP, DOWN or NEUTRAL.

    The last ``horizon`` bars of a key have no label (null), not a shortened one.
    """
    w = Window.partitionBy(*keys).orderBy(time_us)
    ahead = w.rowsBetween(1, horizon)
    now = F.nullif(F.col(close).cast("double"), F.lit(0.0))
    future = F.lead(F.col(close).cast("double"), horizon).over(w)
    change = future / now - 1
    whole = future.isNotNull()
    return bars.withColumns({
        "future_return": change,
        "best": F.when(whole, F.max(F.col(high).cast("double")).over(ahead) / now - 1),
        "worst": F.when(whole, F.min(F.col(low).cast("double")).over(ahead) / now - 1),
        "label": F.when(change > band, "UP").when(change < -band, "DOWN").when(change.isNotNull(), "NEUTRAL"),
    })


def drawdowns(curve: DataFrame, keys: Sequence[str], time_us: str, value: str) -> DataFrame:
    """Per keys the deepest fall from a running maximum, and the final value."""
    w = Window.partitionBy(*keys).orderBy(time_us).rowsBetween(Window.unboundedPreceding, 0)
    fall = curve.withColumn("__fall", F.max(value).over(w) - F.col(value))
    return fall.groupBy(*keys).agg(F.max("__fall").alias("max_drawdown"), F.max_by(value, time_us).alias("final"))


def purged(train: DataFrame, tests: list[tuple[int, int]], start_us: str, end_us: str, embargo_us: int) -> DataFrame:
    """Training rows whose label interval meets no test interval, nor the embargo after one."""
    meets = F.lit(False)
    for low, high in tests:
        meets = meets | ((F.col(start_us) < high + embargo_us) & (F.col(end_us) >= low))
    return train.filter(~F.coalesce(meets, F.lit(True)))


def technical(bars: DataFrame, keys: Sequence[str], time_us: str, high: str, low: str, close: str, volume: str, n: int = 20) -> DataFrame:
    """``bars`` with band width, skewness and kurtosis of returns, distances from VWAP and local extremes, breakout, trend strength and realized range over ``n`` bars.

    bollinger_width is four sample deviations over the mean; skewness and kurtosis (in excess)
    are those of the population; breakout is 1 above the highest and -1 below the lowest of the
    n bars before, else 0; trend_strength is the net change over the path walked. Windows
    that aren't full use the bars there are; what has no basis (no deviation, no path) is null.
    """
    w = Window.partitionBy(*keys).orderBy(time_us)
    back, before = w.rowsBetween(-n + 1, 0), w.rowsBetween(-n, -1)
    price, top, bottom, size = (F.col(c).cast("double") for c in (close, high, low, volume))
    none = lambda x: F.nullif(x, F.lit(0.0))
    step = price - F.lag(price).over(w)
    first = bars.withColumns({"__r": price / none(F.lag(price).over(w)) - 1, "__step": step})
    typical = (top + bottom + price) / 3
    vwap = F.sum(typical * size).over(back) / none(F.sum(size).over(back))
    oldest = F.first(price).over(back)
    out = first.withColumns({
        "bollinger_width": 4 * F.stddev_samp(price).over(back) / none(F.avg(price).over(back)),
        "skewness": F.skewness("__r").over(back), "kurtosis": F.kurtosis("__r").over(back),
        "vwap_distance": price / none(vwap) - 1,
        "high_distance": price / none(F.max(top).over(back)) - 1, "low_distance": price / none(F.min(bottom).over(back)) - 1,
        "breakout": F.when(price > F.max(top).over(before), 1).when(price < F.min(bottom).over(before), -1).otherwise(0),
        "trend_strength": F.abs(price - oldest) / none(F.sum(F.abs("__step")).over(w.rowsBetween(-n + 2, 0))),
        "realized_range": F.max(top).over(back) - F.min(bottom).over(back),
    })
    return out.drop("__r", "__step")


def standing(df: DataFrame, keys: Sequence[str], time_us: str, value: str, n: int = 96) -> DataFrame:
    """``df`` with change, acceleration, zscore and percentile of a series (funding, open interest, ...) among its last ``n`` values, its own included.

    percentile is the share of those values that are at most this one. Null values have none and
    count for none; a series without deviation has no zscore.
    """
    w = Window.partitionBy(*keys).orderBy(time_us)
    back, v = w.rowsBetween(-n + 1, 0), F.col(value).cast("double")
    seen = F.collect_list(v).over(back)  # at most n numbers a row
    moved = df.withColumn("change", v - F.lag(v).over(w))
    return moved.withColumns({
        "acceleration": F.col("change") - F.lag("change").over(w),
        "zscore": (v - F.avg(v).over(back)) / F.nullif(F.stddev_samp(v).over(back), F.lit(0.0)),
        "percentile": F.when(v.isNotNull(), F.size(F.filter(seen, lambda x: x <= v)) / F.size(seen)),
    })


def quadrant(price_change: Column, interest_change: Column) -> Column:
    """How price and open interest move together: LONG_BUILDUP, SHORT_COVERING, SHORT_BUILDUP, LONG_UNWINDING or FLAT; null if unknown."""
    up, more = price_change > 0, interest_change > 0
    flat = (price_change == 0) | (interest_change == 0)
    return F.when(flat, "FLAT").when(up & more, "LONG_BUILDUP").when(up & ~more, "SHORT_COVERING").when(~up & more, "SHORT_BUILDUP").when(~up & ~more, "LONG_UNWINDING")


def imbalance(df: DataFrame, keys: Sequence[str], side: str, amount: str) -> DataFrame:
    """(keys..., buy, sell, imbalance): amounts by side and their difference over their sum, null where both are 0."""
    of = lambda s: F.coalesce(F.sum(F.when(F.upper(side) == s, F.col(amount))), F.lit(0)).cast("double")
    out = df.groupBy(*keys).agg(of("BUY").alias("buy"), of("SELL").alias("sell"))
    return out.withColumn("imbalance", (F.col("buy") - F.col("sell")) / F.nullif(F.col("buy") + F.col("sell"), F.lit(0.0)))


def divergence(df: DataFrame, slot: Sequence[str], group: str, left: str, right: str, values: Sequence[str]) -> DataFrame:
    """(slot..., <value>_gap, <value>_relative): each value of ``left`` less that of ``right`` where both groups have the slot, and over their mean."""
    side = lambda g, v: F.max(F.when(F.col(group) == g, F.col(v).cast("double")))
    wide = df.filter(F.col(group).isin(left, right)).groupBy(*slot).agg(F.count_if(F.col(group) == left).alias("__l"), F.count_if(F.col(group) == right).alias("__r"), *(side(g, v).alias(f"__{m}_{v}") for v in values for m, g in (("l", left), ("r", right))))
    both = wide.filter("__l > 0 and __r > 0")
    gap = lambda v: F.col(f"__l_{v}") - F.col(f"__r_{v}")
    mean = lambda v: F.nullif((F.col(f"__l_{v}") + F.col(f"__r_{v}")) / 2, F.lit(0.0))
    return both.select(*slot, *(c for v in values for c in (gap(v).alias(f"{v}_gap"), (gap(v) / mean(v)).alias(f"{v}_relative"))))


def aligned(base: DataFrame, others: Sequence[tuple[DataFrame, Sequence[str], int, str]], keys: Sequence[str], time_us: str) -> DataFrame:
    """``base`` with the values each of ``others`` (frame, values, tolerance_us, prefix) had become known with by its time, never later.

    The frames have the keys and ``time_us``, the time at which a row was known. Ages and match
    qualities are named by the prefix.
    """
    out = base
    for frame, values, tolerance, prefix in others:
        right = frame.select(*keys, F.col(time_us).alias("__known"), *values)
        out = asof.backward(out, right, keys, time_us, "__known", list(values), tolerance, prefix).withColumnRenamed("match_quality", f"{prefix}quality")
    return out


def dataset_hash(df: DataFrame) -> DataFrame:
    """(rows, fingerprint) of a data set, the same however its rows lie."""
    return merge.content_fingerprint(df, sorted(df.columns))


def walk_forward(df: DataFrame, start_us: str, end_us: str, first_us: int, train_us: int, test_us: int, folds: int, embargo_us: int = 0) -> DataFrame:
    """(fold, role, columns...): each row as ``train`` or ``test`` of every fold it belongs to.

    Fold k trains on the ``train_us`` before and tests on the ``test_us`` from its boundary,
    first_us + k * test_us. A training row whose label interval [start, end] reaches the test, or
    lies within ``embargo_us`` of it, is purged; a test row counts by its start.
    """
    k = F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("fold")
    rows = df.select("*", k)
    boundary = F.lit(first_us) + F.col("fold") * test_us
    start, end = F.col(start_us), F.col(end_us)
    test = (start >= boundary) & (start < boundary + test_us)
    train = (start >= boundary - train_us) & (end < boundary - embargo_us)
    return rows.withColumn("role", F.when(test, "test").when(train, "train")).filter("role is not null").select("fold", "role", *df.columns)


def confusion(df: DataFrame, label: str, guess: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys..., class, support, guessed, hits, precision, recall, f1) per class; rows without label or guess are left out; what has no basis is null."""
    pairs = df.filter(F.col(label).isNotNull() & F.col(guess).isNotNull()).groupBy(*keys, F.col(label).alias("l"), F.col(guess).alias("g")).agg(F.count(F.lit(1)).alias("n"))
    sides = pairs.select(*keys, F.col("n"), F.explode(F.array(F.struct(F.col("l").alias("class"), F.lit(1).alias("own"), F.lit(0).alias("said")), F.struct(F.col("g").alias("class"), F.lit(0).alias("own"), F.lit(1).alias("said")))).alias("s"), (F.col("l") == F.col("g")).alias("hit"))
    out = sides.groupBy(*keys, F.col("s.class").alias("class")).agg(F.sum(F.col("n") * F.col("s.own")).alias("support"), F.sum(F.col("n") * F.col("s.said")).alias("guessed"), F.sum(F.when(F.col("hit"), F.col("n") * F.col("s.own")).otherwise(0)).alias("hits"))
    share = lambda c: F.col("hits") / F.nullif(F.col(c), F.lit(0))
    return out.withColumns({"precision": share("guessed"), "recall": share("support"), "f1": 2 * F.col("hits") / F.nullif(F.col("support") + F.col("guessed"), F.lit(0))})


def trading_metrics(trades: DataFrame, keys: Sequence[str], profit: str) -> DataFrame:
    """(keys..., trades, net, hit_rate, profit_factor, expectancy, sharpe): sums and ratios of closed trades' results; ratios without a basis are null."""
    p = F.col(profit).cast("double")
    rows = trades.filter(p.isNotNull())
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trades"), F.sum(p).alias("net"), (F.count_if(p > 0) / F.count(F.lit(1))).alias("hit_rate"),
        (F.sum(F.when(p > 0, p).otherwise(0.0)) / F.nullif(-F.sum(F.when(p < 0, p).otherwise(0.0)), F.lit(0.0))).alias("profit_factor"), F.avg(p).alias("expectancy"),
        (F.avg(p) / F.nullif(F.stddev_samp(p), F.lit(0.0))).alias("sharpe"),
    )


def journal_as_of(journal: DataFrame, keys: Sequence[str], recorded_us: str, decision_us: int) -> DataFrame:
    """The last entry of every key that was recorded by the decision's time: what the journal said then."""
    rest = [c for c in journal.columns if c not in keys and c != recorded_us]
    known = journal.filter(F.col(recorded_us) <= decision_us)
    best = known.groupBy(*keys).agg(F.max(F.struct(recorded_us, *rest)).alias("__r"))
    return best.select(*keys, *(F.col(f"__r.{c}").alias(c) for c in [recorded_us, *rest]))
