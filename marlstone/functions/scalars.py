"""Scalar expressions for market data: time units, exact numbers, sides, identities, paths.

All are built-in column expressions; nothing leaves the JVM. Null arguments yield null unless
a docstring says otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def epoch(value: Column, unit: str) -> Column:
    """A timestamp from an integer epoch in ``ms`` or ``us``; the unit is never guessed."""
    if unit not in ("ms", "us"):
        raise ValueError(f"unknown epoch unit {unit!r}")
    return F.timestamp_millis(value.cast("bigint")) if unit == "ms" else F.timestamp_micros(value.cast("bigint"))


def epoch_by_unit(value: Column, unit: Column) -> Column:
    """The same with the unit in a column; other units yield null."""
    return F.when(unit == "ms", F.timestamp_millis(value)).when(unit == "us", F.timestamp_micros(value))


def float_seconds_us(text: Column) -> Column:
    """Microseconds from a text of fractional seconds, without passing through binary floats."""
    return (text.try_cast("decimal(20,6)") * F.lit(1_000_000).cast("decimal(7,0)")).cast("bigint")


def archive_unit(day: Column, switch: str = "2025-01-01") -> Column:
    """The epoch unit that archives of a day use: microseconds from the switch on."""
    return F.when(F.to_date(day) >= F.to_date(F.lit(switch)), "us").otherwise("ms")


def floor_us(time_us: Column, seconds: int) -> Column:
    """The start of the bucket of ``seconds`` that holds a microsecond time (also before 1970)."""
    return time_us - F.pmod(time_us, F.lit(seconds * 1_000_000))


def number(text: Column, precision: int = 38, scale: int = 18) -> Column:
    """An exact decimal from text, null if it is none (or doesn't fit)."""
    return text.try_cast(f"decimal({precision},{scale})")


def positive(text: Column, precision: int = 38, scale: int = 18) -> Column:
    """An exact decimal above zero, else null."""
    n = number(text, precision, scale)
    return F.when(n > 0, n)


def strict_boolean(text: Column) -> Column:
    """True or False for exactly these words, else null."""
    return F.when(text == "True", True).when(text == "False", False)


def loose_boolean(text: Column) -> Column:
    """True or false in any letter case, else null."""
    return F.when(F.lower(text) == "true", True).when(F.lower(text) == "false", False)


def taker_side(text: Column) -> Column:
    """BUY, SELL or UNKNOWN; null is UNKNOWN too."""
    side = F.upper(F.trim(text))
    return F.when(side.isin("BUY", "B"), "BUY").when(side.isin("SELL", "S"), "SELL").otherwise("UNKNOWN")


def signed(quantity: Column, side: Column) -> Column:
    """+quantity for BUY, -quantity for SELL, 0 otherwise."""
    return F.when(side == "BUY", quantity).when(side == "SELL", -quantity).otherwise(F.lit(0))


def text_or_null(text: Column) -> Column:
    """The text without outer blanks of any kind, null if nothing remains."""
    return F.nullif(F.regexp_replace(text, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""), F.lit(""))


def product(a: Column, b: Column) -> Column:
    """An exact product of two market decimals, as decimal(38,18).

    Spark cuts the scale of wide products, so the factors are narrowed first: up to 12 digits
    before and 9 after the point each, which covers exchange prices and sizes.
    """
    return (a.cast("decimal(19,9)") * b.cast("decimal(19,9)")).cast("decimal(38,18)")


def middle(low: Column, high: Column) -> Column:
    """The exact mean of two decimal(38,18) of up to 18 digits before the point, as decimal(38,19)."""
    narrow = lambda c: c.cast("decimal(36,18)")  # noqa: E731  (wider sums and quotients would lose digits)
    return ((narrow(low) + narrow(high)) / F.lit(2).cast("decimal(1,0)")).cast("decimal(38,19)")


def mean_half_even(total: Column, count: Column) -> Column:
    """total / count rounded once to 18 digits after the point, ties to the even digit, as decimal(38,18).

    The quotient has 20 digits, itself rounded; where these end in a tie, the remainder tells on
    which side the true quotient lies. Exact for means of up to 8 digits before the point and counts
    below a thousand million; beyond, the tie is taken as one. No count yields null.
    """
    of = F.nullif(count, F.lit(0)).cast("decimal(10,0)")
    q = (total.cast("decimal(36,18)") / of).cast("decimal(38,20)")
    unit, half = F.lit("0.000000000000000001").cast("decimal(18,18)"), F.lit("0.00000000000000000050").cast("decimal(38,20)")
    down = F.when(q < 0, F.ceil(q, F.lit(18))).otherwise(F.floor(q, F.lit(18))).cast("decimal(38,18)")
    away = (down.cast("decimal(36,18)") + F.when(q < 0, -unit).otherwise(unit)).cast("decimal(38,18)")
    again, whole = (q.try_cast("decimal(28,20)") * of.try_cast("decimal(9,0)")).try_cast("decimal(37,20)"), total.try_cast("decimal(37,20)")
    rest = F.when(q < 0, again - whole).otherwise(whole - again)
    tied = F.coalesce((F.abs(q.try_cast("decimal(37,20)") - down.try_cast("decimal(35,18)"))).cast("decimal(38,20)") == half, F.lit(False))  # narrowed, or the difference would lose digits
    return F.when(tied & (rest > 0), away).when(tied & (rest < 0), down).otherwise(F.bround(q, 18)).cast("decimal(38,18)")


def stable_id(prefix: str, fields: Mapping[str, Column], digits: int = 20) -> Column:
    """``prefix`` and the first hex digits of the SHA-256 of the fields' JSON, keys sorted, nulls kept."""
    body = F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})
    return F.concat(F.lit(prefix), F.substring(F.sha2(body, 256), 1, digits))


def instrument_id(exchange: Column, native_symbol: Column, market_type: Column, contract_type: Column, base_asset: Column, quote_asset: Column, settle_asset: Column | None = None, expiry: Column | None = None, environment: Column | None = None) -> Column:
    """The surrogate id of an instrument from its nine immutable fields; ticks and steps are no part of it.

    Venue fields are compared in lower case, symbols and assets in upper case, without outer blanks.
    """
    none = F.lit(None).cast("string")
    low, up = (lambda c: F.lower(F.trim(c))), (lambda c: F.upper(F.trim(c)))
    return stable_id("ins_", {
        "exchange": low(exchange), "venue_environment": low(environment) if environment is not None else F.lit("production"), "native_symbol": up(native_symbol),
        "market_type": low(market_type), "contract_type": low(contract_type), "base_asset": up(base_asset), "quote_asset": up(quote_asset),
        "settle_asset": up(settle_asset) if settle_asset is not None else none, "expiry": expiry if expiry is not None else none,
    })


def fingerprint(parts: Sequence[Column], separator: str = "|") -> Column:
    """SHA-256 of the parts' texts joined by ``separator``; null parts count as empty."""
    return F.sha2(F.concat_ws(separator, *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256)


def version_part(version: Column, part: int) -> Column:
    """Part 0, 1 or 2 of a ``major.minor.patch`` version, null for other texts."""
    return F.when(version.rlike(r"\A[0-9]+\.[0-9]+\.[0-9]+\z"), F.try_element_at(F.split(version, r"\."), F.lit(part + 1)).try_cast("int"))


def compatible(version: Column, other: Column) -> Column:
    """Whether two versions share their major part."""
    return version_part(version, 0) == version_part(other, 0)


def knowable(knowledge_time: Column, decision_time: Column) -> Column:
    """Whether a row was known at the decision; unknown times never were."""
    return F.coalesce(knowledge_time <= decision_time, F.lit(False))


def path_time(path: Column) -> Column:
    """The time a path speaks of: a date (and time) in its file name, else its ``date=`` folder.

    A date alone means its last second. Null if there is none.
    """
    name = F.regexp_extract(path, r"([^/]*)\z", 1)
    full = F.try_to_timestamp(F.regexp_replace(F.regexp_extract(name, r"([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}[_:-][0-9]{2}[_:-][0-9]{2})", 1), r"T([0-9]{2})[_:-]([0-9]{2})[_:-]([0-9]{2})", "T$1:$2:$3"))
    end_of = lambda day: F.try_to_timestamp(F.concat(F.nullif(day, F.lit("")), F.lit("T23:59:59")))
    return F.coalesce(full, end_of(F.regexp_extract(name, r"([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)), end_of(F.regexp_extract(path, r"date=([0-9]{4}-[0-9]{2}-[0-9]{2})", 1)))


def redacted(text: Column, keys: Sequence[str], mask: str = "***", known: Sequence[str] = ()) -> Column:
    """JSON or key=value text with the values of the named keys, at any depth, and every known secret masked.

    Keys are compared in any letter case; of JSON values texts and numbers are masked.
    """
    import re

    names = "|".join(re.escape(k) for k in keys)
    out = text
    if keys:
        out = F.regexp_replace(out, rf'(?i)("(?:{names})"\s*:\s*")(?:[^"\\]|\\.)*"', f'$1{mask}"')
        out = F.regexp_replace(out, rf'(?i)("(?:{names})"\s*:\s*)-?[0-9][0-9.eE+-]*', f'$1"{mask}"')
        out = F.regexp_replace(out, rf"(?i)\b({names})=[^\s&,;]+", f"$1={mask}")
    for secret in known:
        out = F.replace(out, F.lit(secret), F.lit(mask))
    return out


def log_line(fields: Mapping[str, Column]) -> Column:
    """A log event as JSON with exactly these fields in this order, nulls included."""
    return F.to_json(F.struct(*(c.alias(n) for n, c in fields.items())), {"ignoreNullFields": "false"})


def located(rows: DataFrame, messages: DataFrame, fallback: str) -> DataFrame:
    """``rows`` (locale, key, ...) with the ``message`` of their locale, else of the fallback's, else null.

    ``messages`` (locale, key, template) is a small table; of several templates the largest counts.
    """
    one = messages.groupBy("locale", "key").agg(F.max("template").alias("template"))
    own = one.select("locale", "key", F.col("template").alias("__own"))
    other = one.filter(F.col("locale") == fallback).select("key", F.col("template").alias("__other"))
    return rows.join(F.broadcast(own), ["locale", "key"], "left").join(F.broadcast(other), "key", "left").withColumn("message", F.coalesce("__own", "__other")).drop("__own", "__other")


def dataset_class(declared: Column, path: Column, aliases: Mapping[str, str], patterns: Sequence[tuple[str, str]]) -> Column:
    """The declared class under its canonical name, else the first class whose pattern the path matches."""
    known = F.lower(F.trim(declared))
    out = F.lit(None).cast("string")
    for pattern, name in reversed(patterns):
        out = F.when(path.rlike(pattern), name).otherwise(out)
    for alias, name in aliases.items():
        out = F.when(known == alias, name).otherwise(out)
    return out
