"""Queries over the market-data tables for the data-processing problems 1 to 7."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions import scalars
from marlstone.operators import compaction, dedup, diff, drift, grid, lateness, profile
from marlstone.session import keep, keep_at, scratch, tasks
from marlstone.sources.tables import bounded, table

MINUTE_US = 60_000_000


def _trade_sides(spark: SparkSession, folder: str) -> tuple:
    archive = table(spark, folder, "archive_trade", "instrument_id", "native_trade_id", "price", "quantity", "taker_side", "event_time")
    stream = table(spark, folder, "ws_trade", "instrument_id", "native_trade_id", "price", "quantity", "taker_side", "event_time_ms")
    key = {"instrument_id": F.col("instrument_id"), "native_trade_id": F.lower(F.regexp_replace("native_trade_id", r"^\s+|\s+$", ""))}
    number = lambda c: F.expr(f"try_cast({c} as decimal(38,18))")
    side = F.upper("taker_side")
    ours = {"price": F.col("price"), "quantity": F.col("quantity"), "taker_side": side, "event_time": F.floor(F.unix_micros("event_time") / 1000).cast("bigint")}
    theirs = {"price": number("price"), "quantity": number("quantity"), "taker_side": side, "event_time": F.col("event_time_ms")}
    return archive, stream, key, key, ours, theirs


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Trades missing in one copy, and trades whose fields differ."""
    return diff.differences(*_trade_sides(spark, folder), missing_left="missing_in_archive", missing_right="missing_in_ws")


def p7_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Per instrument, the number of trades of each kind of difference."""
    found = p7_found(spark, folder)
    count = lambda kind: F.sum((F.col("difference") == kind).cast("bigint"))
    return found.groupBy("instrument_id").agg(
        count("missing_in_ws").alias("ws_missing_count"),
        count("missing_in_archive").alias("archive_missing_count"),
        (count("price") + count("quantity") + count("event_time")).alias("field_mismatch_count"),
        count("taker_side").alias("side_mismatch_count"),
    )


def _candles(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    rows = table(spark, folder, "ohlcv_candle", "instrument_id", "candle_interval", "is_closed", "open_time", *more)
    return rows.filter("candle_interval = '1m' and is_closed")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Minutes between an instrument's first and last covered minute that no closed candle covers."""
    missing = grid.uncovered(_candles(spark, folder), "instrument_id", F.unix_micros("open_time"), MINUTE_US)
    return missing.select("instrument_id", F.expr("slot_us div 1000").alias("open_time_ms"))


def p6_series(spark: SparkSession, folder: str) -> DataFrame:
    """The one-minute close and volume of every instrument, gaps of up to ten minutes filled."""
    rows = _candles(spark, folder, "close_price", "base_volume")
    series = grid.regular(rows, "instrument_id", F.unix_micros("open_time"), MINUTE_US, ["close_price", "base_volume"], gap_limit_us=10 * MINUTE_US)
    return series.select("instrument_id", F.expr("slot_us div 1000").alias("open_time_ms"), "status", F.round("close_price", 6).alias("close_price"), F.round("base_volume", 6).alias("base_volume"))



def _messages(spark: SparkSession, folder: str) -> DataFrame:
    envelope = table(spark, folder, "ws_envelope", "ingest_seq", "segment_no", "payload_hash", "message_id")
    orders = table(spark, folder, "liquidation", "ingest_seq", "segment_no", "dedup_fingerprint", "message_id")

    def shaped(df: DataFrame, dataset: str, content: str) -> DataFrame:
        return df.select(
            F.lit(dataset).alias("dataset"), F.col("ingest_seq").alias("seq"), F.col("segment_no").alias("segment"),
            dedup.token(dataset, content, dedup.plain_identifier(content)).alias("first"),
            dedup.token(dataset, "message_id", dedup.plain_identifier("message_id")).alias("second"),
        )

    return shaped(envelope, "ws_envelope", "payload_hash").unionByName(shaped(orders, "liquidation", "dedup_fingerprint"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Surplus deliveries of stream messages and forced orders."""
    rows = _messages(spark, folder)
    # history up to the last eighth of the intake batches, then that eighth as incoming messages
    last = rows.agg(F.max("segment")).first()[0]
    store = dedup.intake(spark, rows, ["ws_envelope", "liquidation"], [last - last // 8] if last else [])
    return store.surplus().select("dataset", F.col("seq").alias("ingest_seq"))


PERIOD_US, CUTOFF_US = 5 * MINUTE_US, 30 * MINUTE_US


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    """One row per forced order: copies merged, with the earliest arrival and the kept copy's values."""
    rows = table(spark, folder, "liquidation", "ingest_seq", "instrument_id", "event_time", "received_at", "knowledge_time", "source_price", "dedup_fingerprint", "message_id")
    shaped = rows.select(
        F.col("ingest_seq").alias("node"), F.col("ingest_seq").alias("winner"), "instrument_id",
        F.unix_micros("event_time").alias("event_us"),
        F.unix_micros(F.coalesce("knowledge_time", "received_at")).alias("arrival_us"),
        F.expr("try_cast(source_price as decimal(38,18))").alias("price"),
        dedup.token("liquidation", "dedup_fingerprint", dedup.plain_identifier("dedup_fingerprint")).alias("first"),
        dedup.token("liquidation", "message_id", dedup.plain_identifier("message_id")).alias("second"),
    )
    found = dedup.winners(shaped)
    kept = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("node"))).alias(c)
    return found.groupBy("winner").agg(kept("instrument_id"), kept("event_us"), F.min("arrival_us").alias("arrival_us"), kept("price"))


def _order_state(spark: SparkSession, folder: str) -> DataFrame:
    """The multiset state of the orders that came in time, adjusted by those that came late."""
    orders = keep(_orders(spark, folder), "orders")
    late = F.col("arrival_us") > F.col("event_us") - F.pmod("event_us", F.lit(PERIOD_US)) + PERIOD_US
    state = lambda rows: lateness.adjust(rows, ["instrument_id"], F.col("event_us"), F.col("arrival_us"), F.col("price"), PERIOD_US, CUTOFF_US)
    return lateness.merge(state(orders.filter(~late)), state(orders.filter(late)), ["instrument_id"])


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Periods that late orders corrected, and periods with orders beyond the cut-off."""
    found = lateness.outcomes(_order_state(spark, folder), ["instrument_id"])
    return found.select("instrument_id", F.expr("period_us div 1000").alias("period_start_ms"), "outcome")


def p2_figures(spark: SparkSession, folder: str) -> DataFrame:
    """Orders, distinct prices, extremes and median price per period, before and after correction."""
    found = lateness.corrected(_order_state(spark, folder), ["instrument_id"])
    shown = {c: F.col(c).cast("decimal(38,19)").cast("string") for c in found.columns if c.endswith(("_median", "_min", "_max"))}
    return found.withColumns(shown).withColumn("period_start_ms", F.expr("period_us div 1000")).drop("period_us")


CATALOG_BOUND = 10_000


def _graded(spark: SparkSession, folder: str) -> DataFrame:
    """Every result once, with its metric's kind (null if unknown) and whether its value fits."""
    rows = table(spark, folder, "dq_metric_result", "result_id", "load_no", "metric", "observed_value", "evaluation")
    known = rows.filter("result_id is not null").dropDuplicates(["result_id"]).unionByName(rows.filter("result_id is null"))
    catalog = table(spark, folder, "dq_metric_catalog").filter("metric is not null").dropDuplicates(["metric"])
    kind = F.col("value_kind")
    fit = profile.fits(F.col("observed_value"), kind, F.col("min_value"), F.col("max_value"), F.col("allowed"))
    graded = known.join(bounded(catalog, CATALOG_BOUND), "metric", "left").withColumn("fit", fit)
    return graded.select(
        "result_id", "load_no", "metric", "evaluation", kind.alias("kind"), F.col("observed_value").alias("value"), "fit",
        F.when(F.col("fit") & kind.isin("rate", "seconds", "count"), F.col("observed_value").try_cast("double")).alias("number"),
    )


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Misnamed metrics, values that break their metric's form, and shifts from load to load."""
    graded = keep(_graded(spark, folder), "graded")
    broken = F.when(F.col("kind").isNull(), "unknown_metric").when(F.col("value").isNotNull() & ~F.col("fit"), "bad_value")
    single = graded.withColumn("finding", broken).filter("finding is not null").select("finding", "metric", "load_no", "result_id")
    moved = profile.shifts(graded.filter("kind is not null and load_no is not null"), "metric", "load_no")
    return single.unionByName(moved.select("finding", "metric", "load_no", F.lit(0).cast("bigint").alias("result_id")))


def p4_drift(spark: SparkSession, folder: str) -> DataFrame:
    """How well a classifier tells each load of a metric from the one before, and by which column."""
    graded = _graded(spark, folder).filter("kind is not null and load_no is not null")
    sized = F.when(F.col("kind") == "label", F.when(F.col("fit"), F.col("value"))).otherwise(profile.level(F.col("number")))
    cells = graded.groupBy("metric", "load_no", F.col("value").isNull().alias("missing"), "fit", sized.alias("size"), "evaluation").agg(F.count(F.lit(1)).alias("n"))
    tested = profile.two_sample(cells, "metric", "load_no", ["missing", "fit", "size", "evaluation"])
    return tested.select("metric", "load_no", *(F.round(c, 6).alias(c) for c in tested.columns if c not in ("metric", "load_no")))


#: What texts of a column must look like (fixed values of the data's formats).
PATTERNS = {
    "instrument_id": r"\Ains_[0-9a-f]{20}\z", "parquet_sha256": r"\A[0-9a-f]{64}\z", "payload_hash": r"\A[0-9a-f]{64}\z", "message_id": r"\A[0-9a-f]{64}\z", "dedup_fingerprint": r"\A[0-9a-f]{64}\z",
    "schema_version": r"\A[0-9]+\.[0-9]+\.[0-9]+\z", "taker_side": r"\A(BUY|SELL|UNKNOWN)\z", "candle_interval": r"\A[0-9]+[smhd]\z", "relative_path": r"\A[^\\]+\z",
    "price": r"\A[0-9]+(\.[0-9]+)?\z", "quantity": r"\A[0-9]+(\.[0-9]+)?\z", "evaluation": r"\A(PASS|FAIL|UNKNOWN|NOT_APPLICABLE)\z",
}


def _profiled(rows: DataFrame, load: str) -> DataFrame:
    return profile.columns_by_load(rows, load, patterns={c: p for c, p in PATTERNS.items() if c in rows.columns})


def p4_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Nulls, distinct values, ranges and pattern violations of every column of the quality results, load by load."""
    return _profiled(table(spark, folder, "dq_metric_result"), "load_no")


def p4_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Ranges of every column of the quality results in its own type, load by load."""
    return profile.column_ranges(table(spark, folder, "dq_metric_result"), "load_no")


def p4_trade_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The same for the archive of trades, a day of receipt being a load."""
    trades = table(spark, folder, "archive_trade").withColumn("day", F.to_date("received_at").cast("string"))
    return _profiled(trades, "day")


#: What a load of each large table is: a day of receipt, or the table's own number.
LOADS = {
    "dq_metric_result": "load_no", "archive_trade": "to_date(received_at)", "ws_trade": "to_date(received_at)", "ws_envelope": "to_date(received_at)",
    "liquidation": "to_date(received_at)", "ohlcv_candle": "to_date(retrieved_at)", "active_artifact": "to_date(published_at)",
}


def p4_table_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Nulls, distinct values and typed ranges of every column of the large tables, load by load."""
    parts = []
    for name, load in LOADS.items():
        rows = table(spark, folder, name).withColumn("__load", F.expr(load).cast("string"))
        parts.append(_profiled(rows, "__load").select(F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, parts)


def p4_column_drift(spark: SparkSession, folder: str) -> DataFrame:
    """How well a classifier tells each load of every large table from the one before, by every column."""
    parts = []
    for name, load in LOADS.items():
        found = profile.drift_by_column(table(spark, folder, name).withColumn("__load", F.expr(load)), "__load")
        parts.append(found.select(F.lit(name).alias("table_name"), "column_name", F.col("load").cast("string").alias("load"), F.round("separation", 6).alias("separation"), F.round("auc", 6).alias("auc")))
    return reduce(DataFrame.unionByName, parts)


ALIAS_BOUND = 10_000
CANDLE_FIELDS = {
    "open_time": "time", "open": "number", "high": "number", "low": "number", "close": "number", "base_volume": "number", "quote_volume": "number",
    "trade_count": "whole", "taker_buy_base_volume": "number", "taker_buy_quote_volume": "number", "is_closed": "flag", "schema_version": "text",
    "native_symbol": "text", "source_method": "text", "received_at": "time", "clock_offset_ms": "number", "candle_source": "text",
    "source_volume": "number", "source_volume_unit": "text", "source_turnover": "number", "ingestion_run_id": "text", "aggregation_version": "text",
}


def _candle_files(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The files with their versions, and each file's fields."""
    records = table(spark, folder, "raw_candle_record", "source_dataset_id", "file_seq", "payload")
    aliases = bounded(table(spark, folder, "field_alias").filter("alias is not null").dropDuplicates(["alias"]), ALIAS_BOUND)
    fields = keep(drift.file_fields(records, "source_dataset_id", "file_seq", "payload", aliases), "fields")
    return keep(drift.chain(records, fields, "source_dataset_id", "file_seq"), "chain"), fields


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Every change of a field from one file of a source to the next: the migration steps between versions."""
    steps = drift.migrations(*_candle_files(spark, folder), "source_dataset_id", "file_seq")
    return steps.select("source_dataset_id", "file_seq", F.col("canonical").alias("canonical_field"), "change_kind")


def p5_versions(spark: SparkSession, folder: str) -> DataFrame:
    """The schema fingerprint and version of every file."""
    return _candle_files(spark, folder)[0].select("source_dataset_id", "file_seq", "fingerprint", "version")


def p5_table(spark: SparkSession, folder: str) -> DataFrame:
    """All raw candle records, repeated ones once, routed by their file's version into the one target schema."""
    kept = ["source_dataset_id", "file_seq", "record_no"]
    routes = drift.rules(*_candle_files(spark, folder), "source_dataset_id", "file_seq")
    records = table(spark, folder, "raw_candle_record", *kept, "payload").dropDuplicates()
    found = drift.migrate(records, "payload", kept, bounded(routes, ALIAS_BOUND), kept[:2], CANDLE_FIELDS, {"schema_version": "2.0.0"})
    plain = {f: F.unix_micros(f) if kind == "time" else F.col(f).cast("string") for f, kind in CANDLE_FIELDS.items() if kind in ("time", "number")}
    return found.withColumns(plain)


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """The fate of every listed file that doesn't stay as it is."""
    return compaction.plan(table(spark, folder, "active_artifact")).filter("fate != 'keep'").select("relative_path", "fate")


STAGED_ROWS = 20_000


def _write_files(spark: SparkSession, folder: str, root: str) -> DataFrame:
    """The files that hold the archive's trades, one Parquet file per raw_object_ref below ``root``."""
    trades = table(spark, folder, "archive_trade").filter("raw_object_ref is not null")
    buckets = max(8, trades.count() // STAGED_ROWS)

    def write(part: pa.Table) -> pa.Table:
        target, base = compaction.file_system(root)
        part = part.drop_columns(["__bucket"]).sort_by([("raw_object_ref", "ascending"), ("source_ordinal", "ascending")]).combine_chunks()
        refs = part.column("raw_object_ref").to_pylist()
        done, first = [], 0
        for i in range(1, len(refs) + 1):
            if i == len(refs) or refs[i] != refs[first]:
                path = f"{base}/{refs[first]}"
                target.create_dir(path.rpartition("/")[0])
                with target.open_output_stream(path) as out:
                    pq.write_table(part.slice(first, i - first), out, compression="zstd", use_dictionary=False)
                done.append((refs[first], i - first))
                first = i
        return pa.table({"relative_path": pa.array([d[0] for d in done], pa.string()), "n_rows": pa.array([d[1] for d in done], pa.int64())})

    bucket = F.pmod(F.xxhash64("raw_object_ref"), F.lit(buckets)).alias("__bucket")
    return trades.select("*", bucket).repartition(tasks(spark), "__bucket").groupBy("__bucket").applyInArrow(write, "relative_path string, n_rows bigint")


def _compacted(spark: SparkSession, folder: str, root: str) -> DataFrame:
    """The report of joining the small trade files below ``root``/in into files below ``root``/out."""
    there = keep_at(_write_files(spark, folder, f"{root}/in"), f"{root}/written")
    kind = scalars.dataset_class(F.col("dataset_class"), F.col("relative_path"), {}, [("individual_trade", "individual_trade")])
    planned = compaction.plan(table(spark, folder, "active_artifact"), kind=kind)
    listed = planned.filter("relative_path like '%individual_trade%'").select("relative_path", "directory", "kind", "bin", "fate", "n_rows")
    report = compaction.execute(planned.join(there, "relative_path", "left_semi"), f"{root}/in", f"{root}/out")
    return keep_at(report.unionByName(compaction.absent(listed, there)), f"{root}/report")


def p1_compact(spark: SparkSession, folder: str) -> DataFrame:
    """Per directory the small trade files joined block by block, and what the joined files hold when they are read again.

    The test data has the files' rows but not the files: they are first written to the shared
    folder, under the paths that the manifest gives them. The manifest's own row counts are what
    the joined files are held against; trade files that the manifest lists with rows but that
    aren't there count as missing.
    """
    root = scratch(spark, "files")
    report = _compacted(spark, folder, root)
    done = report.groupBy("directory").agg(
        *(F.sum(F.when(F.col("problem").isNull(), F.col(c)).otherwise(0)).cast("bigint").alias(c) for c in ("files", "blocks", "rows", "listed_rows")),
        F.count_if(F.col("problem").isNotNull()).alias("missing"), F.count("output_path").alias("outputs"),
    )
    home = F.regexp_replace(F.substring_index(F.col("_metadata.file_path"), f"{root.rpartition('/')[2]}/out/", -1), r"[^/]*\z", "")
    joined = spark.read.schema("source_ordinal bigint").option("recursiveFileLookup", True).parquet(f"{root}/out") if done.filter("outputs > 0").limit(1).count() else spark.createDataFrame([], "source_ordinal bigint").withColumn("_metadata", F.struct(F.lit("").alias("file_path")))
    read = joined.groupBy(home.alias("directory")).agg(F.count(F.lit(1)).alias("read_rows"), F.sum("source_ordinal").alias("read_ordinals"))
    return done.join(read, "directory", "left").select("directory", "files", "blocks", "rows", "listed_rows", "missing", F.coalesce("read_rows", F.lit(0)).cast("bigint").alias("read_rows"), F.coalesce("read_ordinals", F.lit(0)).cast("bigint").alias("read_ordinals"))


QUERIES = {"p1_found": p1_found, "p1_compact": p1_compact, "p2_found": p2_found, "p2_figures": p2_figures, "p3_found": p3_found, "p4_found": p4_found, "p4_drift": p4_drift, "p4_profile": p4_profile, "p4_ranges": p4_ranges, "p4_table_profile": p4_table_profile, "p4_column_drift": p4_column_drift, "p4_trade_profile": p4_trade_profile, "p5_found": p5_found, "p5_versions": p5_versions, "p5_table": p5_table, "p6_found": p6_found, "p6_series": p6_series, "p7_found": p7_found, "p7_totals": p7_totals}

PLAIN_SQL = r"regexp_replace(regexp_replace(replace(relative_path, '\', '/'), '/+', '/', 'g'), '^(\./)+', '')"
COVERED_SQL = "m as (select instrument_id, epoch_ms(open_time) // 60000 * 60000 as t, max((epoch_us(open_time), close_price, base_volume)) as r from ohlcv_candle where candle_interval = '1m' and is_closed group by 1, 2)"
#: Copies of messages: identifiers that occur twice link their rows, and links are followed to their end.
WINNERS_SQL = r"""with recursive r as (
    select 'ws_envelope' as d, ingest_seq as s, regexp_replace(lower(payload_hash), '^sha256:', '') as a, regexp_replace(lower(message_id), '^sha256:', '') as b from ws_envelope
    union all select 'liquidation', ingest_seq, regexp_replace(lower(dedup_fingerprint), '^sha256:', ''), regexp_replace(lower(message_id), '^sha256:', '') from liquidation),
  t as (select d, s, 'a' || a as k from r where a is not null union select d, s, 'b' || b from r where b is not null),
  e as (select distinct x.d, x.s as s, y.s as o from t x join t y on x.d = y.d and x.k = y.k and x.s <> y.s),
  reach(d, s, o) as (select d, s, o from e union select reach.d, reach.s, e.o from reach join e on reach.d = e.d and reach.o = e.s),
  w as (select d, s, least(s, min(o)) as winner from reach group by d, s)"""
RESULT_COLUMNS = ("result_id", "dataset_class", "exchange", "market_type", "instrument_id", "source_contract_version", "metric", "observed_value", "observations", "policy_id", "evaluation", "reason", "observed_at")
TRADE_COLUMNS = (
    "instrument_id", "exchange", "market_type", "contract_type", "native_symbol", "dataset_class", "source_dataset_id", "native_trade_id", "source_ordinal", "event_time", "source_timestamp", "source_timestamp_unit", "price", "quantity",
    "quote_quantity", "taker_side", "is_buyer_maker", "is_best_match", "is_rpi_trade", "received_at", "knowledge_time", "knowledge_time_basis", "raw_object_ref", "schema_version", "dq_flags",
)

#: The columns of the large tables, and what a load of each is in SQL.
PROFILED = {
    "dq_metric_result": ("cast(load_no as varchar)", ("load_no", *RESULT_COLUMNS)), "archive_trade": ("cast(cast(received_at as date) as varchar)", TRADE_COLUMNS),
    "ws_trade": ("cast(cast(received_at as date) as varchar)", ("instrument_id", "exchange", "market_type", "native_symbol", "native_trade_id", "price", "quantity", "taker_side", "event_time_ms", "session_id", "received_at")),
    "ws_envelope": ("cast(cast(received_at as date) as varchar)", ("ingest_seq", "segment_no", "envelope_id", "source", "exchange", "market_type", "instrument_id", "stream_topic", "connection_id", "session_id", "received_at", "processed_at", "source_contract_version", "collector_version", "payload", "payload_hash", "message_id")),
    "liquidation": ("cast(cast(received_at as date) as varchar)", (
        "ingest_seq", "segment_no", "exchange", "instrument_id", "symbol", "market_type", "contract_type", "venue_product_type", "event_time", "exchange_timestamp", "received_at", "processed_at", "knowledge_time", "source_event_time_ms", "source_order_trade_time_ms", "position_side_liquidated", "source_side", "source_quantity",
        "last_filled_quantity", "accumulated_filled_quantity", "source_price", "average_fill_price", "order_type", "time_in_force", "order_status", "source_window_ms", "message_id", "dedup_fingerprint", "source", "schema_version", "dq_flags",
    )),
    "ohlcv_candle": ("cast(cast(retrieved_at as date) as varchar)", (
        "instrument_id", "exchange", "market_type", "contract_type", "native_symbol", "candle_interval", "is_closed", "open_time", "close_time", "open_price", "high_price", "low_price", "close_price", "base_volume", "quote_volume", "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume", "source_method", "source_dataset_id",
        "observation_id", "retrieved_at", "knowledge_time", "knowledge_time_basis", "schema_version", "data_contract_version",
    )),
    "active_artifact": ("cast(cast(published_at as date) as varchar)", ("dataset_class", "relative_path", "parquet_sha256", "exchange", "market_type", "contract_type", "instrument_id", "symbol", "schema_version", "manifest_path", "manifest_record_number", "n_rows", "n_bytes", "published_at")),
}


def _profile_sql(name: str, load: str, columns: tuple[str, ...]) -> str:
    """One select per column: counts, and ranges in the column's own type given as text."""
    value = lambda c: f"epoch_us({c})" if c.endswith(("_at", "_time", "exchange_timestamp")) else f"cast(to_json({c}) as varchar)" if c == "dq_flags" else c
    off = lambda c: f"count(*) filter (not regexp_matches(cast({c} as varchar), '{PATTERNS[c]}'))" if c in PATTERNS else "cast(null as bigint)"
    one = lambda c: f"""select '{c}' as column_name, {load} as load, count(*) as rows, count(*) - count({c}) as nulls, count(distinct {value(c)}) as "distinct", cast(min({value(c)}) as varchar) as lowest, cast(max({value(c)}) as varchar) as highest, {off(c)} as violations from {name} group by {load}"""
    return "\nunion all ".join(map(one, columns))


SHARED_SQL = {
    "trades": """with a as (select distinct instrument_id as i, lower(trim(native_trade_id)) as k, price as p, quantity as q, upper(taker_side) as s, epoch_us(event_time) // 1000 as e from archive_trade),
  w as (select distinct instrument_id as i, lower(trim(native_trade_id)) as k, try_cast(price as decimal(38,18)) as p, try_cast(quantity as decimal(38,18)) as q, upper(taker_side) as s, event_time_ms as e from ws_trade),
  b as (select i, k, a.p as p1, w.p as p2, a.q as q1, w.q as q2, a.s as s1, w.s as s2, a.e as e1, w.e as e2 from a join w using (i, k)),
  f as (select i as instrument_id, k as native_trade_id, 'missing_in_ws' as difference from a anti join w using (i, k) union select i, k, 'missing_in_archive' from w anti join a using (i, k)
    union select i, k, 'price' from b where p1 is distinct from p2 union select i, k, 'quantity' from b where q1 is distinct from q2
    union select i, k, 'taker_side' from b where s1 is distinct from s2 union select i, k, 'event_time' from b where e1 is distinct from e2)""",
    "results": r"""with d as (select distinct on (result_id) result_id, load_no, metric, observed_value as v from dq_metric_result),
  g as (select d.*, value_kind as kind, coalesce(case when value_kind in ('rate', 'seconds') then regexp_full_match(v, '([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?') and try_cast(v as double) between min_value and max_value
    when value_kind = 'count' then regexp_full_match(v, '[0-9]+') and try_cast(v as double) between min_value and max_value when value_kind = 'label' then list_contains(string_split(allowed, '|'), v)
    when value_kind = 'counts' then regexp_full_match(v, '[ \t\r\n]*\{[ \t\r\n]*("[^"\\]*"[ \t\r\n]*:[ \t\r\n]*-?(0|[1-9][0-9]*)[ \t\r\n]*(,[ \t\r\n]*"[^"\\]*"[ \t\r\n]*:[ \t\r\n]*-?(0|[1-9][0-9]*)[ \t\r\n]*)*)?\}[ \t\r\n]*')
      and len(list_filter(regexp_extract_all(v, '"([^"\\]*)"[ \t\r\n]*:', 1), lambda k: not list_contains(string_split(allowed, '|'), k))) = 0
      and len(list_filter(regexp_extract_all(v, ':[ \t\r\n]*(-?[0-9]+)', 1), lambda i: not (try_cast(i as double) between min_value and max_value))) = 0 end, false) as fit from d left join dq_metric_catalog c on d.metric = c.metric),
  b as (select metric, load_no, count(*) as n, count(*) filter (v is null) as nulls, count(*) filter (fit) as fitting, median(case when fit and kind in ('rate', 'seconds', 'count') then try_cast(v as double) end) as med from g where kind is not null group by 1, 2),
  p as (select x.metric, x.load_no, x.n, x.nulls, x.fitting, x.med, y.n as n0, y.nulls as nulls0, y.fitting as fitting0, y.med as med0 from b x join b y on x.metric = y.metric and x.load_no = y.load_no + 1),
  l as (select metric, load_no, v, count(*) as c from g where fit and kind = 'label' group by 1, 2, 3),
  u as (select metric, load_no, v, sum(c) as c, sum(c0) as c0 from (select metric, load_no, v, c, 0 as c0 from l union all select metric, load_no + 1, v, 0, c from l) group by 1, 2, 3)""",
}
KIND_SQL = "case json_type(p, '$.\"' || k || '\"') when 'NULL' then null when 'UBIGINT' then 'integer' when 'BIGINT' then 'integer' when 'DOUBLE' then 'decimal' when 'VARCHAR' then 'string' else lower(json_type(p, '$.\"' || k || '\"')) end"
FILE_FIELDS_SQL = f"""k as (select source_dataset_id as s, file_seq as f, unnest(json_keys(payload)) as k, payload as p from raw_candle_record),
  v as (select s, f, coalesce(canonical_field, k) as c, k, {KIND_SQL} as t from k left join field_alias a on a.alias = k.k),
  g as (select s, f, c, list_sort(list(distinct k)) as names, list_sort(list(distinct t) filter (t is not null)) as kinds from v group by 1, 2, 3),
  x as (select s, f, sha256(string_agg(c || ':' || array_to_string(names, ',') || ':' || coalesce(array_to_string(kinds, ','), ''), chr(10) order by c)) as fingerprint from g group by 1, 2),
  y as (select *, coalesce(fingerprint <> lag(fingerprint) over (partition by s order by f), true) as opens from x),
  n as (select s as source_dataset_id, f as file_seq, fingerprint, cast(sum(opens::int) over (partition by s order by f) as bigint) as version from y)"""


def _cell_sql(field: str, kind: str) -> str:
    """A field's value under any of its spellings; the first in order that has one."""
    text = f"coalesce(p->>'$.{field}', (select min_by(p->>('$.\"' || alias || '\"'), alias) filter (p->>('$.\"' || alias || '\"') is not null) from field_alias where canonical_field = '{field}'){', ' + repr('2.0.0') if field == 'schema_version' else ''})"
    cast = {
        "text": "{t}", "number": "cast(try_cast({t} as decimal(38,18)) as varchar)", "whole": "try_cast(try_cast({t} as decimal(38,6)) as bigint)", "flag": "case when lower({t}) in ('true', '1') then true when lower({t}) in ('false', '0') then false end",
        "time": "coalesce(try_cast({t} as bigint) * 1000, epoch_us(try_cast({t} as timestamptz)))",
    }[kind]
    return cast.replace("{t}", text) + f' as "{field}"'


ORACLE: dict[str, str] = {
    "p1_found": f"""with m as (select {PLAIN_SQL} as p, * from active_artifact), l as (select p, arg_max(parquet_sha256, manifest_record_number) as h, arg_max(n_bytes, manifest_record_number) as b, regexp_replace(p, '[^/]*$', '') as d from m group by p),
  c as (select *, p <> min(p) over (partition by h) as copy from l), n as (select *, count(*) filter (not copy and b < 1048576) over (partition by d) as q from c)
  select p as relative_path, case when copy then 'copy' else 'merge' end as fate from n where copy or (b < 1048576 and q > 1)""",
    "p1_compact": f"""with m as (select {PLAIN_SQL} as p, * from active_artifact), l as (select p, arg_max(parquet_sha256, manifest_record_number) as h, arg_max(n_bytes, manifest_record_number) as b, arg_max(n_rows, manifest_record_number) as n, regexp_replace(p, '[^/]*$', '') as directory from m group by p),
  c as (select *, coalesce(p <> min(p) over (partition by h), false) as copy from l), q as (select *, coalesce(not copy and b < 1048576, false) as small, count(*) filter (not copy and b < 1048576) over (partition by directory) as k from c),
  t as (select raw_object_ref as p, count(*) as rows, sum(source_ordinal) as ordinals from archive_trade where raw_object_ref is not null group by 1),
  j as (select q.*, t.rows, t.ordinals, small and k > 1 and t.p is not null as joined, t.p is null and n > 0 and q.p like '%individual_trade%' as lost from q left join t on q.p = t.p)
  select directory, count(*) filter (joined) as files, count(*) filter (joined) as blocks, cast(coalesce(sum(rows) filter (joined), 0) as bigint) as rows, cast(coalesce(sum(n) filter (joined), 0) as bigint) as listed_rows, count(*) filter (lost) as missing,
    cast(coalesce(sum(rows) filter (joined), 0) as bigint) as read_rows, cast(coalesce(sum(ordinals) filter (joined), 0) as bigint) as read_ordinals from j where joined or lost group by 1""",
    "p2_found": WINNERS_SQL + """, o as (select coalesce(w.winner, l.ingest_seq) as m, min(coalesce(knowledge_time, received_at)) as arrival, arg_min(instrument_id, ingest_seq) as instrument_id, arg_min(event_time, ingest_seq) as event_time from liquidation l left join w on w.d = 'liquidation' and w.s = l.ingest_seq group by 1),
  q as (select instrument_id, epoch_ms(event_time) // 300000 * 300000 as period_start_ms, epoch_us(arrival) - (epoch_ms(event_time) // 300000 * 300000 + 300000) * 1000 as delay from o where arrival is not null and event_time is not null)
  select distinct instrument_id, period_start_ms, case when delay <= 1800000000 then 'corrected' else 'dropped' end as outcome from q where delay > 0""",
    "p2_figures": WINNERS_SQL + """, o as (select coalesce(w.winner, l.ingest_seq) as m, min(epoch_us(coalesce(knowledge_time, received_at))) as arrival, arg_min(instrument_id, ingest_seq) as instrument_id, arg_min(epoch_us(event_time), ingest_seq) filter (event_time is not null) as e,
    arg_min(try_cast(source_price as decimal(38,18)), ingest_seq) filter (try_cast(source_price as decimal(38,18)) is not null) as v from liquidation l left join w on w.d = 'liquidation' and w.s = l.ingest_seq group by 1),
  q as (select instrument_id, e // 300000000 * 300000 as period_start_ms, v, arrival - e // 300000000 * 300000000 - 300000000 as delay from o where arrival is not null and e is not null),
  s as (select instrument_id, period_start_ms, count(*) as final_n, list_sort(list(v) filter (v is not null)) as a, nullif(count(*) filter (delay <= 0), 0) as first_n, list_sort(list(v) filter (v is not null and delay <= 0)) as b from q where delay <= 1800000000 group by 1, 2),
  z as (select *, (cast(a[(len(a) + 1) // 2] as decimal(37,18)) + a[len(a) // 2 + 1]) * 0.5 as am, (cast(b[(len(b) + 1) // 2] as decimal(37,18)) + b[len(b) // 2 + 1]) * 0.5 as bm from s)
  select instrument_id, period_start_ms, final_n, coalesce(len(list_distinct(a)), 0) as final_distinct, cast(cast(a[1] as decimal(38,19)) as varchar) as final_min, cast(cast(a[-1] as decimal(38,19)) as varchar) as final_max, cast(cast(am as decimal(38,19)) as varchar) as final_median,
    first_n, case when first_n > 0 then coalesce(len(list_distinct(b)), 0) end as first_distinct, cast(cast(b[1] as decimal(38,19)) as varchar) as first_min, cast(cast(b[-1] as decimal(38,19)) as varchar) as first_max, cast(cast(bm as decimal(38,19)) as varchar) as first_median from z""",
    "p3_found": WINNERS_SQL + " select d as dataset, s as ingest_seq from w where s <> winner",
    "p4_found": SHARED_SQL["results"] + """ select 'unknown_metric' as finding, metric, load_no, result_id from g where kind is null union all select 'bad_value', metric, load_no, result_id from g where kind is not null and v is not null and not fit
  union all select 'null_shift', metric, load_no, 0 from p where abs(nulls * n0 - nulls0 * n) * 4 >= n * n0 union all select 'level_shift', metric, load_no, 0 from p where (med >= 2 * med0 or 2 * med <= med0) and (med <> 0 or med0 <> 0)
  union all select distinct 'label_shift', metric, load_no, 0 from u join p using (metric, load_no) where fitting > 0 and fitting0 > 0 and abs(c * fitting0 - c0 * fitting) * 10 >= 3 * fitting * fitting0""",
    "p4_profile": _profile_sql("dq_metric_result", "load_no", RESULT_COLUMNS),
    "p4_table_profile": "\nunion all ".join(f"select '{name}' as table_name, * from ({_profile_sql(name, load, columns)})" for name, (load, columns) in PROFILED.items()),
    "p4_trade_profile": _profile_sql("archive_trade", "strftime(received_at, '%Y-%m-%d')", TRADE_COLUMNS),
    "p4_ranges": "\nunion all ".join(
        f"select '{c}' as column_name, load_no as load, cast(min({v}) as varchar) as lowest, cast(max({v}) as varchar) as highest from dq_metric_result group by load_no"
        for c, v in [(c, c) for c in ("dataset_class", "exchange", "market_type", "instrument_id", "source_contract_version", "metric", "observed_value", "policy_id", "evaluation", "reason", "result_id", "observations")] + [("observed_at", "epoch_us(observed_at)")]
    ),
    "p5_found": """with k as (select source_dataset_id as s, file_seq as f, unnest(json_keys(payload)) as k, payload as p from raw_candle_record),
  v as (select s, f, coalesce(canonical_field, k) as c, k, case json_type(p, '$."' || k || '"') when 'NULL' then null when 'UBIGINT' then 'integer' when 'BIGINT' then 'integer' when 'DOUBLE' then 'decimal' else json_type(p, '$."' || k || '"') end as t from k left join field_alias a on a.alias = k.k),
  g as (select s, f, c, list_sort(list(distinct k)) as names, list_sort(list(distinct t) filter (t is not null)) as kinds from v group by 1, 2, 3),
  o as (select s, f, lag(f) over (partition by s order by f) as b from (select distinct source_dataset_id as s, file_seq as f from raw_candle_record)),
  n as (select g.* from g join o using (s, f) where b is not null), q as (select g.s, o.f, g.c, g.names, g.kinds from g join o on g.s = o.s and g.f = o.b),
  j as (select coalesce(n.s, q.s) as s, coalesce(n.f, q.f) as f, coalesce(n.c, q.c) as c, n.names as nn, q.names as qn, n.kinds as nk, q.kinds as qk from n full join q on n.s = q.s and n.f = q.f and n.c = q.c)
  select s as source_dataset_id, f as file_seq, c as canonical_field, 'added' as change_kind from j where qn is null union all select s, f, c, 'removed' from j where nn is null union all select s, f, c, 'renamed' from j where nn <> qn
  union all select s, f, c, 'type_changed' from j where len(nk) > 0 and len(qk) > 0 and nk <> qk""",
    "p5_versions": f"with {FILE_FIELDS_SQL} select * from n",
    "p5_table": f"with {FILE_FIELDS_SQL}, d as (select distinct source_dataset_id, file_seq, record_no, payload as p from raw_candle_record) select source_dataset_id, file_seq, record_no, version, {', '.join(_cell_sql(f, k) for f, k in CANDLE_FIELDS.items())} from d left join n using (source_dataset_id, file_seq)",
    "p6_found": f"""with {COVERED_SQL}, r as (select instrument_id, unnest(generate_series(min(t), max(t), 60000)) as t from m group by 1) select instrument_id, t as open_time_ms from r anti join m using (instrument_id, t)""",
    "p6_series": """with r as (select instrument_id as i, epoch_us(open_time) as u, max((close_price, base_volume)) as v from ohlcv_candle where candle_interval = '1m' and is_closed group by 1, 2),
  c as (select distinct i, u // 60000000 * 60000000 as t from r), g as (select i, unnest(generate_series(min(t), max(t), 60000000)) as t from c group by 1),
  b as (select g.i, g.t, r.u as pt, r.v as pv from g asof left join r on g.i = r.i and g.t >= r.u), x as (select b.*, r.u as nt, r.v as nv from b asof left join r on b.i = r.i and b.t <= r.u),
  s as (select x.*, c.t is not null as observed, coalesce(nt - pt <= 600000000, false) as near from x left join c using (i, t)),
  n as (select *, cast(pv[1] as double) as p1, cast(pv[2] as double) as p2, cast(nv[1] as double) as n1, cast(nv[2] as double) as n2, (t - pt) / (nt - pt) as f from s)
  select i as instrument_id, t // 1000 as open_time_ms, case when observed then 'observed' when near then 'filled' else 'missing' end as status,
    round(case when nt = pt then p1 when near then p1 + (n1 - p1) * f when observed then n1 end, 6) as close_price,
    round(case when nt = pt then p2 when near then p2 + (n2 - p2) * f when observed then n2 end, 6) as base_volume from n""",
    "p7_found": SHARED_SQL["trades"] + " select instrument_id, native_trade_id, difference from f",
    "p7_totals": SHARED_SQL["trades"] + """ select instrument_id, count(*) filter (difference = 'missing_in_ws') as ws_missing_count, count(*) filter (difference = 'missing_in_archive') as archive_missing_count,
  count(*) filter (difference in ('price', 'quantity', 'event_time')) as field_mismatch_count, count(*) filter (difference = 'taker_side') as side_mismatch_count from f group by 1""",
}
