"""Gaps as records: how they arise, what recovers them, and what is left open."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Gap types and states, endpoint limits, reasons of failures.
TYPES = ("LOCAL_COLLECTOR_GAP", "SOURCE_GAP", "SEQUENCE_GAP", "ARCHIVE_GAP", "UNKNOWN_GAP")
STATES = ("OPEN", "RECOVERED", "PARTIAL", "UNRECOVERABLE", "UNKNOWN")
RECOVERABLE = ("individual_trade", "exchange_aggregate_trade")
OLD_TYPES = {"RECOVERED_GAP": "LOCAL_COLLECTOR_GAP", "PARTIALLY_RECOVERED_GAP": "LOCAL_COLLECTOR_GAP"}
FAILURES = [("timeout|timed out", "TIMEOUT"), ("dns|name resolution|getaddrinfo", "DNS"), ("ack|subscri", "SUBSCRIPTION"), ("schema|json|decode|parse", "MALFORMED"), ("disk|space", "STORAGE"), ("close|reset|disconnect", "DISCONNECTED")]
SESSION_STEPS = {"CREATED": ["CONNECTING", "FAILED"], "CONNECTING": ["ACTIVE", "FAILED"], "ACTIVE": ["DRAINING", "FAILED"], "DRAINING": ["CLOSED", "FAILED"]}


def records(gaps: DataFrame, instrument: str, kind: str = "UNKNOWN_GAP", status: str = "OPEN") -> DataFrame:
    """``gaps`` (with gap_start_us and gap_end_us) as records: gap_id from instrument and start, gap_type and status."""
    if kind not in TYPES or status not in STATES:
        raise ValueError(f"no such gap: {kind}, {status}")
    start = F.expr("gap_start_us div 1000").cast("string")
    return gaps.withColumns({"gap_id": F.concat(F.lit("gap_"), F.col(instrument), F.lit("_"), start), "gap_type": F.lit(kind), "status": F.lit(status)})


def between_sessions(sessions: DataFrame, keys: Sequence[str], started_us: str, ended_us: str, after: str | None = None) -> DataFrame:
    """(keys..., gap_start_us, gap_end_us[, session_before, session_after]) between consecutive sessions of a stream that don't touch.

    A session that ends before an earlier one did opens no gap: the furthest end so far counts.
    ``after`` names the column with the sessions' ids.
    """
    w = Window.partitionBy(*keys).orderBy(started_us, ended_us)
    until = F.max(F.struct(F.col(ended_us).alias("e"), *([F.col(after).alias("id")] if after else []))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = sessions.withColumn("__until", until).filter(F.col("__until.e") < F.col(started_us))
    return rows.select(*keys, F.col("__until.e").alias("gap_start_us"), F.col(started_us).alias("gap_end_us"), *([F.col("__until.id").alias("session_before"), F.col(after).alias("session_after")] if after else []))


def at_disconnect(streams: DataFrame, last_event_us: str, now_us: Column, slack_us: int = 10_000_000) -> DataFrame:
    """``streams`` with the gap a disconnect opens: from the last event, or some seconds ago without one, until now."""
    return streams.withColumns({"gap_start_us": F.coalesce(F.col(last_event_us), now_us - slack_us), "gap_end_us": now_us})


def endpoint_limit(exchange: Column, market_type: Column) -> Column:
    return F.when((exchange == "bybit") & (market_type == "spot"), 60).otherwise(1000)


def recovery(gaps: DataFrame) -> DataFrame:
    """``gaps`` with status and note after an attempt to fetch what they miss.

    Needs dataset_class, exchange, market_type, fetched (records that came back) and proven
    (whether they prove to reach both ends without a hole). Without rows, or for another class of
    data, nothing can be recovered; a full page without proof may have been cut off.
    """
    limit = endpoint_limit(F.col("exchange"), F.col("market_type"))
    proven, fetched = F.coalesce(F.col("proven"), F.lit(False)), F.coalesce(F.col("fetched"), F.lit(0))
    unsupported = ~F.coalesce(F.col("dataset_class").isin(*RECOVERABLE), F.lit(False))
    status = F.when(unsupported | (fetched == 0), "UNRECOVERABLE").when(proven, "RECOVERED").otherwise("PARTIAL")
    note = F.when(unsupported, "UNSUPPORTED_CLASS").when(fetched == 0, "NO_RECORDS").when(proven, "PROVEN").when(fetched == limit, "TRUNCATION_RISK").otherwise("UNPROVEN")
    return gaps.withColumns({"status": status, "note": note})


def failure_reason(text: Column) -> Column:
    """The reason code of an error's text, the first that fits; UNKNOWN for others, null for none."""
    out = F.when(text.isNotNull(), "UNKNOWN")
    for pattern, code in reversed(FAILURES):
        out = F.when(F.lower(text).rlike(pattern), code).otherwise(out)
    return out


def backoff_seconds(attempt: Column, initial: float = 1.0, factor: float = 2.0, most: float = 60.0, jitter: float = 0.2, seed: int = 0) -> Column:
    """How long to wait before an attempt (from 1): exponential up to ``most``, plus or minus a share that the seed and attempt decide, at least 0.1, to four digits."""
    plain = F.least(F.lit(most), F.lit(initial) * F.pow(F.lit(factor), attempt - 1))
    part = F.pmod(F.xxhash64(F.lit(seed), attempt), F.lit(20001)) / 10000.0 - 1
    return F.round(F.greatest(F.lit(0.1), plain * (1 + part * jitter)), 4)


def exposure(registry: DataFrame, identity: Sequence[str]) -> DataFrame:
    """Per identity the gaps in each state and of each type, zeros included."""
    states = [F.count_if(F.col("status") == s).alias(s.lower()) for s in STATES]
    kinds = [F.count_if(F.col("gap_type") == t).alias(t.lower()) for t in TYPES]
    return registry.groupBy(*identity).agg(F.count(F.lit(1)).alias("total"), *states, *kinds)


def latest(log: DataFrame, renamed: Mapping[str, str] = OLD_TYPES) -> DataFrame:
    """The present state of every gap of an append-only log (gap_id, seq, ...), old types under their present name."""
    from marlstone.operators import contracts, sequence

    return sequence.latest(contracts.upgraded(log, {}, {"gap_type": renamed}), ["gap_id"], ["seq"])
