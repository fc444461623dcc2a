"""Queries for catalogs, contracts, gaps, audits, baselines and data sets, each with the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions import scalars
from marlstone.operators import audit, baseline, contracts, features, gapstates, merge, multiset, quality, sequence
from marlstone.operators.compaction import plain_path
from marlstone.plans.market_queries import BARS_SQL, MINUTE_SQL, TAPE, bars, dbl, minutes, rounded, tape
from marlstone.plans.registry import Registry
from marlstone.session import keep, keep_at, scratch
from marlstone.sources import catalog, publish
from marlstone.sources.tables import table

registry = Registry()
query, QUERIES, ORACLE = registry.query, registry.queries, registry.sql
PLAIN_SQL = r"regexp_replace(regexp_replace(replace(relative_path, '\', '/'), '/+', '/', 'g'), '^(\./)+', '')"

# Catalog ----------------------------------------------------------------------------------


def manifest_records(spark: SparkSession, folder: str) -> DataFrame:
    """The artifact table as manifest records of every kind: each number's rest decides what its record does and how it names its file."""
    rows = table(spark, folder, "active_artifact").withColumn("path", plain_path(F.col("relative_path")))
    n = F.col("manifest_record_number")
    action = F.when(n % 23 == 0, "SUPERSEDED").when(n % 23 == 1, "QUARANTINED").when(n % 23 == 2, F.lit("")).when(n % 23 == 3, "VALIDATED").otherwise("NORMALIZED")
    several = n % 7 == 3
    none, empty = F.lit(None).cast("string"), F.lit(None).cast("array<string>")
    made = {
        "manifest": F.col("manifest_path"), "number": n, "action": action, "source_dataset_id": none, "period": F.regexp_extract("path", "date=([^/]*)", 1), "collector_version": none, "normalization_version": none,
        "object_id": F.when(~several, F.col("path")), "created_parquets": F.when(several, F.array("path", F.concat("path", F.lit(".second.parquet")))),
        "parquet_sha256": F.when(several & F.col("parquet_sha256").isNotNull(), F.concat(F.lit('["'), "parquet_sha256", F.lit('"]'))).otherwise(F.col("parquet_sha256")),
        "source_parquet_sha256": F.when(n % 5 == 0, F.col("parquet_sha256")), "quarantined_parquets": F.when(n % 23 == 1, F.array("path")),
        "superseded_object_id": none, "deleted_object_id": none, "superseded_object_ids": empty, "deleted_object_ids": F.when(n % 46 == 0, F.array(F.concat("path", F.lit(".second.parquet")))),
    }
    return rows.withColumns(made).select("manifest", "number", *(f.name for f in catalog.LOG.fields))


CLASS_SQL = """case lower(coalesce(dataset_class, '')) when 'x' then 'x' else null end"""
ACTIVE_SQL = f"""with m as (select {PLAIN_SQL} as path, manifest_record_number as n, manifest_path as m, regexp_extract(manifest_path, '([^/]*)$', 1) as mn, * from active_artifact),
  k as (select *, coalesce(case dataset_class when 'funding' then 'funding_rate' when 'liquidation' then 'liquidations' when 'trade_bucket' then 'derived_trade_bucket' when 'aggregate_trade' then 'exchange_aggregate_trade' when '' then null else dataset_class end,
      case when j like '%trade_bucket%' then 'derived_trade_bucket' when j like '%individual_trade%' then 'individual_trade' when j like '%aggregate_trade%' or j like '%aggtrade%' then 'exchange_aggregate_trade' when j like '%open_interest%' then 'open_interest'
        when j like '%funding%' then 'funding_rate' when j like '%liquidation%' then 'liquidations' when j like '%ohlcv%' or j like '%klines%' then 'ohlcv' end) as class
    from (select *, lower(mn || ' ' || case when n % 7 = 3 then '' else path end) as j from m)),
  r as (select * from k where class in ('ohlcv', 'individual_trade', 'exchange_aggregate_trade', 'derived_trade_bucket', 'funding_rate', 'open_interest', 'liquidations')),
  gone as (select path as ref from r where n % 23 = 0 and n % 7 <> 3 and lower(path) like '%.parquet' union select path || '.second.parquet' from r where n % 23 = 0 and n % 46 = 0),
  hidden as (select distinct regexp_extract(path, '([^/]*)$', 1) as name from r where n % 23 = 1),
  p as (select *, class in ('funding_rate', 'open_interest', 'liquidations') as cumulative from r where n % 23 not in (0, 1, 3)),
  c as (select * from p where not cumulative union all select * exclude (place) from (select *, row_number() over (partition by mn, class, coalesce(exchange, ''), coalesce(market_type, ''), coalesce(nullif(symbol, ''), instrument_id, ''), regexp_extract(path, 'date=([^/]*)', 1) order by m desc, n desc) as place from p where cumulative) where place = 1),
  f as (select class, cumulative, m, n, path as ref, parquet_sha256 as sha, case when n % 5 = 0 then parquet_sha256 end as source from c where n % 7 = 3 or lower(path) like '%.parquet' union all select class, cumulative, m, n, path || '.second.parquet', null, case when n % 5 = 0 then parquet_sha256 end from c where n % 7 = 3),
  l as (select * exclude (place) from (select *, row_number() over (partition by ref order by cumulative desc, m desc, n desc) as place from f where ref not in (select ref from gone) and regexp_extract(ref, '([^/]*)$', 1) not in (select name from hidden)) where place = 1),
  a as (select * from l where class <> 'derived_trade_bucket' or source is null or source in (select sha from l where class = 'individual_trade' and sha is not null))"""


@query(ACTIVE_SQL + " select class as dataset_class, ref as relative_path, sha as parquet_sha256, n as number from a")
def active_files(spark: SparkSession, folder: str) -> DataFrame:
    """The files that the manifests' records say are in force."""
    return catalog.active(manifest_records(spark, folder)).select("dataset_class", "relative_path", "parquet_sha256", "number")


@query(ACTIVE_SQL + f""", t as (select {PLAIN_SQL} as path, arg_min(parquet_sha256, manifest_record_number) as sha from active_artifact where n_rows > 0 group by 1)
  select ref as relative_path, case when t.path is null then 'missing' else 'hash_mismatch' end as problem from a left join t on t.path = a.ref where t.path is null or (a.sha is not null and t.sha is not null and a.sha <> t.sha)""")
def active_problems(spark: SparkSession, folder: str) -> DataFrame:
    """Active files against a store that holds each listed file with rows as its first record describes it."""
    rows = table(spark, folder, "active_artifact", "relative_path", "parquet_sha256", "manifest_record_number", "n_rows").filter("n_rows > 0")
    there = rows.groupBy(plain_path(F.col("relative_path")).alias("relative_path")).agg(F.min_by("parquet_sha256", "manifest_record_number").alias("sha256"))
    return catalog.problems(catalog.active(manifest_records(spark, folder)), there)


def _data_root(spark: SparkSession, folder: str) -> str:
    """A data root with Parquet files of five classes, their manifests and some metadata snapshots."""
    root = scratch(spark, "root")
    named = {
        "ohlcv": ("ohlcv_candle", {"open_price": "open", "close_price": "close"}, "binance.klines"), "individual_trade": ("archive_trade", {}, "trades"), "liquidations": ("liquidation", {}, "forced.orders"),
    }
    for kind, (name, renamed, source) in named.items():
        table(spark, folder, name).withColumnsRenamed(renamed).write.option("compression", "zstd").parquet(f"{root}/normalized/{kind}")
        files = catalog.inventory(spark, f"{root}/normalized/{kind}", "*.parquet").select(catalog.relative(F.col("path"), root).alias("ref"), "sha256")
        listed = files.agg(F.array_sort(F.collect_list(F.struct("ref", "sha256"))).alias("f"))  # the files of one write
        events = listed.select(
            F.lit("NORMALIZED").alias("action"), F.lit(kind).alias("dataset_class"), F.lit(source).alias("source_dataset_id"),
            F.transform("f", lambda x: x["ref"]).alias("created_parquets"), F.to_json(F.transform("f", lambda x: x["sha256"])).alias("parquet_sha256"),
        )
        old = events.select(F.lit("INGESTED").alias("action"), "dataset_class", F.lit("older").alias("source_dataset_id"), F.array(F.lit(f"normalized/{kind}/older.parquet")).alias("created_parquets"), F.lit(None).cast("string").alias("parquet_sha256"))
        gone = old.withColumns({"action": F.lit("DELETED"), "deleted_object_ids": F.col("created_parquets"), "created_parquets": F.array().cast("array<string>")})
        old.unionByName(events).unionByName(gone, allowMissingColumns=True).coalesce(1).select(F.to_json(F.struct("*")).alias("value")).write.text(f"{root}/staged/{kind}")
        lines = spark.read.text(f"{root}/staged/{kind}").orderBy(F.col("value").contains('"older"').desc(), F.col("value").contains('"DELETED"'))
        fs, path = publish.file_system(f"{root}/control/manifests/{kind}.jsonl")
        fs.create_dir(path.rpartition("/")[0])
        with fs.open_output_stream(path) as out:
            for r in lines.toLocalIterator():  # three lines
                out.write((r["value"] + "\n\n").encode())
    for i, text in enumerate(['{"retrieved_at": "2021-03-01T00:00:00Z", "dataset_id": "rules", "native_symbol": "BTCUSDT"}', '{"symbol": "ETHUSDT"}', "[1]", "broken"]):
        publish.fetch([text.encode()], f"{root}/control/instrument_metadata/{i}.json")
    return root


@query("""select 'market_ohlcv' as view, count(*) as rows from ohlcv_candle union all select 'market_individual_trade', count(*) from archive_trade union all select 'market_liquidations', count(*) from liquidation union all select v, 0 from (values ('market_exchange_aggregate_trade'), ('market_derived_trade_bucket'), ('market_funding_rate'), ('market_open_interest')) t(v)
  union all select 'instrument_metadata_snapshots', 2""")
def catalog_views(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of every view of a catalog built over files and manifests."""
    built = catalog.build(spark, _data_root(spark, folder))
    snapshots = built.snapshots.agg(F.lit("instrument_metadata_snapshots").alias("view"), F.count(F.lit(1)).alias("rows"))
    return keep(built.counts().unionByName(snapshots), "views")


@query("""select t.exchange, t.market_type, count(*) as trades, count(distinct t.instrument_id) as instruments, any_value(o.n) as orders from archive_trade t left join (select exchange, market_type, count(*) as n from liquidation group by 1, 2) o on o.exchange = t.exchange and o.market_type = t.market_type group by 1, 2""")
def catalog_sql(spark: SparkSession, folder: str) -> DataFrame:
    """SQL over the views of a catalog."""
    catalog.build(spark, _data_root(spark, folder))
    return keep(spark.sql("""
      select t.exchange, t.market_type, count(*) as trades, count(distinct t.instrument_id) as instruments, first(o.n) as orders
      from market_individual_trade t left join (select exchange, market_type, count(*) as n from market_liquidations group by 1, 2) o on o.exchange = t.exchange and o.market_type = t.market_type group by 1, 2
    """), "sql")  # fmt: skip


# Contracts --------------------------------------------------------------------------------


def _broken(df: DataFrame, contract: contracts.Contract) -> DataFrame:
    return contract.checked(df).select(F.explode("violations").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("rows"))


@query(f"""with e as (select manifest_record_number as n, case when manifest_record_number % 11 = 0 then 'PUBLISHED' else 'NORMALIZED' end as action, case when manifest_record_number % 13 = 0 then upper(parquet_sha256) else parquet_sha256 end as sha,
    epoch_us(published_at) as a, epoch_us(published_at) + (manifest_record_number % 5 - 1) * 1000000 as b, schema_version from active_artifact),
  r as (select unnest(list_filter([case when schema_version is null then 'schema_version_required' end, case when a is null then 'occurred_at_required' end, case when action <> 'NORMALIZED' then 'known_action' end, case when not regexp_matches(sha, '^[a-f0-9]{{64}}$') then 'checksum_form' end, case when b < a then 'coverage_order' end], lambda x: x is not null)) as rule from e)
  select rule, count(*) as rows from r group by 1""")
def manifest_event_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules that manifest events break, made of the artifact table with some faults put in."""
    rows, n = table(spark, folder, "active_artifact", "manifest_record_number", "parquet_sha256", "published_at", "schema_version", "relative_path"), F.col("manifest_record_number")
    events = rows.select(
        n.cast("string").alias("event_id"), F.when(n % 11 == 0, "PUBLISHED").otherwise("NORMALIZED").alias("action"), F.col("relative_path").alias("object_id"), F.col("published_at").alias("occurred_at"), F.col("published_at").alias("coverage_start"),
        F.timestamp_micros(F.unix_micros("published_at") + (n % 5 - 1) * 1_000_000).alias("coverage_end"), F.when(n % 13 == 0, F.upper("parquet_sha256")).otherwise(F.col("parquet_sha256")).alias("checksum_sha256"), F.lit(None).cast("string").alias("reason"),
        "schema_version", F.lit("1").alias("collector_version"), F.lit("1").alias("normalization_version"),
    )
    return _broken(events, contracts.MANIFEST_EVENT)


@query("""with r as (select unnest(list_filter([case when processed_at is null then 'committed_at_required' end, case when instrument_id is null then 'instrument_id_required' end, case when processed_at < event_time then 'event_committed' end, case when processed_at < knowledge_time then 'knowledge_committed' end, case when knowledge_time < event_time then 'known_after_event' end], lambda x: x is not null)) as rule from liquidation)
  select rule, count(*) as rows from r group by 1""")
def checkpoint_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules that checkpoints break, one taken after each forced order."""
    rows = table(spark, folder, "liquidation", "ingest_seq", "instrument_id", "source", "event_time", "knowledge_time", "processed_at")
    marks = rows.select(F.col("ingest_seq").cast("string").alias("checkpoint_id"), F.coalesce("source", F.lit("s")).alias("source_dataset_id"), "instrument_id", F.lit(None).cast("string").alias("cursor"), F.col("processed_at").alias("committed_at"), F.col("event_time").alias("last_event_time"), F.col("knowledge_time").alias("last_knowledge_time"))
    return _broken(marks, contracts.CHECKPOINT)


@query("""with r as (select unnest(list_filter([case when instrument_id is null then 'instrument_id_required' end, case when event_time is null then 'started_at_required' end, case when received_at is null then 'ended_at_required' end, case when processed_at is null then 'detected_at_required' end, case when order_status <> 'FILLED' then 'known_kind' end,
    case when not coalesce(received_at > event_time, false) then 'ends_after_start' end, case when not coalesce(processed_at >= event_time, false) then 'detected_after_start' end], lambda x: x is not null)) as rule from liquidation) select rule, count(*) as rows from r group by 1""")
def gap_record_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules that gap records break, made of the time between an order's event and its receipt."""
    rows = table(spark, folder, "liquidation", "ingest_seq", "instrument_id", "event_time", "received_at", "processed_at", "order_status")
    gaps = rows.select(F.col("ingest_seq").cast("string").alias("gap_id"), F.lit("s").alias("source_dataset_id"), "instrument_id", F.when(F.col("order_status") == "FILLED", "unknown_gap").otherwise("other").alias("kind"), F.col("event_time").alias("started_at"), F.col("received_at").alias("ended_at"), F.col("processed_at").alias("detected_at"), F.lit("OPEN").alias("status"), F.lit(None).cast("string").alias("reason"))
    return _broken(gaps, contracts.GAP_RECORD)


@query("""with e as (select manifest_record_number as n, published_at as p, case when manifest_record_number % 3 = 0 then to_timestamp((epoch_us(published_at) + (manifest_record_number % 4 - 1) * 1000000) / 1000000.0) end as d, case when manifest_record_number % 6 <> 0 then parquet_sha256 end as sha from active_artifact),
  r as (select unnest(list_filter([case when p is null then 'planned_at_required' end, case when d is not null and sha is null then 'deleted_with_checksum' end, case when n % 3 = 0 and n % 4 = 0 and p is not null then 'deleted_after_plan' end], lambda x: x is not null)) as rule from e) select rule, count(*) as rows from r group by 1""")
def deletion_record_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules that deletion records break, made of the artifact table."""
    rows, n = table(spark, folder, "active_artifact", "manifest_record_number", "parquet_sha256", "published_at", "relative_path"), F.col("manifest_record_number")
    none = F.lit(None).cast("timestamp")
    made = rows.select(
        n.cast("string").alias("deletion_id"), F.col("relative_path").alias("object_id"), F.col("published_at").alias("planned_at"), F.when(n % 3 == 0, F.timestamp_micros(F.unix_micros("published_at") + (n % 4 - 1) * 1_000_000)).alias("deleted_at"),
        none.alias("coverage_start"), none.alias("coverage_end"), F.lit("age").alias("reason"), F.when(n % 6 != 0, F.col("parquet_sha256")).alias("checksum_sha256"),
    )
    return _broken(made, contracts.DELETION_RECORD)


@query("""with r as (select 'windowed' as contract, unnest(list_filter([case when not coalesce(exchange = 'binance' and instrument_id like 'ins\\_%' escape '\\', false) then 'identity' end, case when knowledge_time is distinct from received_at then 'known_when_received' end, case when not coalesce(position_side_liquidated = 'UNKNOWN', false) then 'no_side_inferred' end,
    case when not coalesce(source_window_ms = 1000, false) then 'window' end, case when not coalesce(list_contains(dq_flags, 'SOURCE_SELECTION_INCOMPLETENESS'), false) then 'incompleteness_flagged' end], lambda x: x is not null)) as rule from liquidation
  union all select 'stated', unnest(list_filter([case when not coalesce(exchange = 'bybit', false) then 'exchange' end, case when not coalesce(market_type = 'perpetual' and contract_type = 'linear_perpetual', false) then 'market' end, case when not coalesce(position_side_liquidated in ('LONG', 'SHORT', 'UNKNOWN'), false) then 'side_domain' end, 'price_semantic',
    case when not coalesce(try_cast(source_quantity as decimal(38,18)) > 0, false) then 'quantity_positive' end, case when not coalesce(try_cast(source_price as decimal(38,18)) > 0, false) then 'price_positive' end, case when knowledge_time is distinct from received_at then 'known_when_received' end], lambda x: x is not null)) from liquidation)
  select contract, rule, count(*) as rows from r group by 1, 2""")
def forced_order_rules(spark: SparkSession, folder: str) -> DataFrame:
    """What every forced order breaks of either venue's rules."""
    rows = table(spark, folder, "liquidation").withColumn("price_semantic", F.lit("average_price"))
    both = F.array(F.struct(F.lit("windowed").alias("contract"), quality.violations({n: F.expr(r) for n, r in contracts.WINDOWED_ORDERS.items()}).alias("v")), F.struct(F.lit("stated").alias("contract"), quality.violations({n: F.expr(r) for n, r in contracts.STATED_ORDERS.items()}).alias("v")))
    return rows.select(F.explode(both).alias("b")).select("b.contract", F.explode("b.v").alias("rule")).groupBy("contract", "rule").agg(F.count(F.lit(1)).alias("rows"))


def _issues_sql(rules: str) -> str:
    return f"""with w as (select *, row_number() over k as copy, row_number() over s as place, lag(event_time) over s as before from liquidation window k as (partition by exchange, instrument_id, event_time order by ingest_seq), s as (partition by exchange, instrument_id order by ingest_seq)),
  r as (select unnest(list_filter([case when copy > 1 then 'duplicate_key' end, case when place > 1 and not coalesce(event_time > before, false) then 'not_later' end, {rules}], lambda x: x is not null)) as issue from w) select issue, count(*) as rows from r group by 1"""


def _issues(rows: DataFrame, rules: dict[str, str]) -> DataFrame:
    found = contracts.sequence_issues(rows, rules, ["exchange", "instrument_id", "event_time"], ["exchange", "instrument_id"], "event_time", "ingest_seq")
    return found.select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count(F.lit(1)).alias("rows"))


@query(_issues_sql("case when not coalesce(try_cast(source_quantity as decimal(38,18)) >= 0, false) then 'base_not_negative' end, case when last_filled_quantity is not null and not coalesce(try_cast(last_filled_quantity as decimal(38,18)) >= 0, false) then 'notional_not_negative' end"))
def open_interest_issues(spark: SparkSession, folder: str) -> DataFrame:
    """The checks of open-interest series, over the orders' quantities as readings in the order they came."""
    rows = table(spark, folder, "liquidation", "exchange", "instrument_id", "event_time", "ingest_seq", F.col("source_quantity").alias("oi_base"), F.col("last_filled_quantity").alias("oi_notional"))
    return _issues(rows, contracts.OPEN_INTEREST)


@query(_issues_sql("case when try_cast(source_price as decimal(38,18)) is null then 'rate_number' end, case when average_fill_price is not null and not coalesce(try_cast(average_fill_price as decimal(38,18)) > 0, false) then 'mark_positive' end, case when not coalesce(instrument_id like 'ins\\_%' escape '\\', false) then 'instrument' end, case when not coalesce(market_type = 'perpetual', false) then 'market' end"))
def funding_issues(spark: SparkSession, folder: str) -> DataFrame:
    """The checks of funding series, over the orders' prices as readings in the order they came."""
    rows = table(spark, folder, "liquidation", "exchange", "instrument_id", "event_time", "ingest_seq", "market_type", F.col("source_price").alias("funding_rate"), F.col("average_fill_price").alias("mark_price"))
    return _issues(rows, contracts.FUNDING)


@query("""select manifest_path, count(*) as rows, count(*) filter (dataset_class is distinct from 'individual_trade' or exchange is distinct from 'binance') as strangers from active_artifact group by 1""")
def class_isolation(spark: SparkSession, folder: str) -> DataFrame:
    """How many records of each manifest an isolation gate for one class and venue would refuse."""
    return contracts.strangers(table(spark, folder, "active_artifact", "manifest_path", "dataset_class", "exchange"), {"dataset_class": "individual_trade", "exchange": "binance"}, ["manifest_path"])


@query("""with u as (select ingest_seq, case when order_status = 'FILLED' then 'LOCAL_COLLECTOR_GAP' else order_status end as gap_type, coalesce(source, 'unknown') as source, 'filesystem_mtime' as age_basis from liquidation) select gap_type, source, age_basis, count(*) as rows from u group by 1, 2, 3""")
def upgraded_records(spark: SparkSession, folder: str) -> DataFrame:
    """Old records read in the present form: an old type's present name, defaults for what they lack."""
    old = table(spark, folder, "liquidation", "ingest_seq", F.when(F.col("order_status") == "FILLED", "RECOVERED_GAP").otherwise(F.col("order_status")).alias("gap_type"), "source")
    found = contracts.upgraded(old, {"source": "'unknown'", "age_basis": "'filesystem_mtime'"}, {"gap_type": gapstates.OLD_TYPES})
    return found.groupBy("gap_type", "source", "age_basis").agg(F.count(F.lit(1)).alias("rows"))


@query("""with l as (select instrument_id, max(ingest_seq) as s, arg_max(order_status, ingest_seq) as status from liquidation where instrument_id is not null group by 1), u as (select instrument_id, ingest_seq as s, order_status as status from liquidation where instrument_id is not null union all select instrument_id, s + 1, 'RECOVERED' from l where status = 'FILLED')
  select instrument_id, count(*) as rows, arg_max(status, s) as status from u group by 1""")
def revised_records(spark: SparkSession, folder: str) -> DataFrame:
    """A log in which every record whose latest state is FILLED got a new one."""
    log = table(spark, folder, "liquidation", "instrument_id", "ingest_seq", F.col("order_status").alias("status")).filter("instrument_id is not null")
    changes = sequence.latest(log, ["instrument_id"], ["ingest_seq"]).filter("status = 'FILLED'").select("instrument_id", F.lit("RECOVERED").alias("status"))
    return contracts.revised(log, changes, ["instrument_id"], "ingest_seq").groupBy("instrument_id").agg(F.count(F.lit(1)).alias("rows"), F.max_by("status", "ingest_seq").alias("status"))


# Gaps -------------------------------------------------------------------------------------

GAPS_SQL = f"""with {MINUTE_SQL}, l as (select *, lag(t) over (partition by instrument_id order by t) as b from m), g as (select instrument_id, b + 60000000 as s, t as e from l where t > b + 60000000)"""


def _gap_log(spark: SparkSession, folder: str) -> DataFrame:
    return gapstates.records(sequence.gaps(minutes(spark, folder), ["instrument_id"], "t", 60_000_000), "instrument_id")


@query(GAPS_SQL + " select 'gap_' || instrument_id || '_' || (s // 1000) as gap_id, s as gap_start_us, e as gap_end_us, 'UNKNOWN_GAP' as gap_type, 'OPEN' as status from g")
def gap_records(spark: SparkSession, folder: str) -> DataFrame:
    return _gap_log(spark, folder).select("gap_id", "gap_start_us", "gap_end_us", "gap_type", "status")


RECOVERY_SQL = GAPS_SQL + """, f as (select g.*, (e - s) // 60000000 as need, (e - s) // 60000000 - case when (e - s) // 60000000 % 3 = 0 then 0 else (e - s) // 60000000 % 2 end as fetched, case when right(instrument_id, 1) < '2' then 'ohlcv' else 'individual_trade' end as class from g),
  r as (select *, case when class = 'ohlcv' or fetched = 0 then 'UNRECOVERABLE' when fetched = need then 'RECOVERED' else 'PARTIAL' end as status, case when class = 'ohlcv' then 'UNSUPPORTED_CLASS' when fetched = 0 then 'NO_RECORDS' when fetched = need then 'PROVEN' when fetched = 60 then 'TRUNCATION_RISK' else 'UNPROVEN' end as note from f)"""


def _recovered(spark: SparkSession, folder: str) -> DataFrame:
    need = F.expr("(gap_end_us - gap_start_us) div 60000000")
    fetched = need - F.when(need % 3 == 0, F.lit(0)).otherwise(need % 2)
    kind = F.when(F.substring("instrument_id", -1, 1) < "2", "ohlcv").otherwise("individual_trade")
    tried = _gap_log(spark, folder).withColumns({"dataset_class": kind, "exchange": F.lit("bybit"), "market_type": F.lit("spot"), "fetched": fetched, "proven": fetched == need})
    return gapstates.recovery(tried)


@query(RECOVERY_SQL + " select status, note, count(*) as gaps, cast(sum(fetched) as bigint) as fetched from r group by 1, 2")
def gap_recovery(spark: SparkSession, folder: str) -> DataFrame:
    """What becomes of gaps when some come back whole, some in part, and some not at all."""
    return _recovered(spark, folder).groupBy("status", "note").agg(F.count(F.lit(1)).alias("gaps"), F.sum("fetched").alias("fetched"))


@query(RECOVERY_SQL + """ select instrument_id, count(*) as total, 0 as open, count(*) filter (status = 'RECOVERED') as recovered, count(*) filter (status = 'PARTIAL') as partial, count(*) filter (status = 'UNRECOVERABLE') as unrecoverable, 0 as unknown, 0 as local_collector_gap, 0 as source_gap, 0 as sequence_gap, 0 as archive_gap, count(*) as unknown_gap from r group by 1""")
def gap_exposure(spark: SparkSession, folder: str) -> DataFrame:
    """Gaps of every instrument by state and type, from a log with two states of each."""
    first = _gap_log(spark, folder).select("gap_id", "instrument_id", F.lit(1).alias("seq"), "gap_type", "status")
    log = first.unionByName(_recovered(spark, folder).select("gap_id", "instrument_id", F.lit(2).alias("seq"), "gap_type", "status"))
    return gapstates.exposure(gapstates.latest(log), ["instrument_id"])


SESSIONS_SQL = """s as (select exchange, market_type, session_id, min(epoch_us(received_at)) as a, max(epoch_us(received_at)) as b from ws_envelope where session_id is not null and received_at is not null group by 1, 2, 3)"""


def _sessions(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "ws_envelope", "exchange", "market_type", "session_id", "received_at").filter("session_id is not null and received_at is not null")
    return rows.groupBy("exchange", "market_type", "session_id").agg(F.min(F.unix_micros("received_at")).alias("a"), F.max(F.unix_micros("received_at")).alias("b"))


@query(f"""with {SESSIONS_SQL}, w as (select *, max((b, session_id)) over (partition by exchange, market_type order by a, b rows between unbounded preceding and 1 preceding) as p from s)
  select exchange, market_type, p[1] as gap_start_us, a as gap_end_us, p[2] as session_before, session_id as session_after from w where p[1] < a""")
def session_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """The gaps between consecutive sessions of each stream."""
    return gapstates.between_sessions(_sessions(spark, folder), ["exchange", "market_type"], "a", "b", "session_id")


@query(f"""with {SESSIONS_SQL} select exchange, market_type, session_id, case when right(session_id, 1) < '8' then b else 1614700790000000 end as gap_start_us, 1614700800000000 as gap_end_us from s""")
def disconnect_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """The gap each session would open if it broke off at a fixed time; half of them saw no event."""
    seen = _sessions(spark, folder).withColumn("last", F.when(F.substring("session_id", -1, 1) < "8", F.col("b")))
    return gapstates.at_disconnect(seen, "last", F.lit(1_614_700_800_000_000)).select("exchange", "market_type", "session_id", "gap_start_us", "gap_end_us")


@query("""with l as (select instrument_id, ingest_seq, order_status as now, lag(order_status) over w as was, row_number() over w as place from liquidation window w as (partition by instrument_id order by ingest_seq))
  select instrument_id, ingest_seq, was, now from l where not coalesce(place = 1 and now = 'NEW' or was = 'PARTIALLY_FILLED' and now in ('PARTIALLY_FILLED', 'FILLED') or was = 'FILLED' and now = 'PARTIALLY_FILLED', false)""")
def state_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Changes of state in a log that its table of steps doesn't allow."""
    log = table(spark, folder, "liquidation", "instrument_id", "ingest_seq", "order_status")
    return contracts.changes_of_state(log, ["instrument_id"], "ingest_seq", "order_status", {"PARTIALLY_FILLED": ["PARTIALLY_FILLED", "FILLED"], "FILLED": ["PARTIALLY_FILLED"]}, "NEW")


@query("""select case when lower(text) like '%timeout%' or lower(text) like '%timed out%' then 'TIMEOUT' when regexp_matches(lower(text), 'dns|name resolution|getaddrinfo') then 'DNS' when regexp_matches(lower(text), 'ack|subscri') then 'SUBSCRIPTION' when regexp_matches(lower(text), 'schema|json|decode|parse') then 'MALFORMED'
  when regexp_matches(lower(text), 'disk|space') then 'STORAGE' when regexp_matches(lower(text), 'close|reset|disconnect') then 'DISCONNECTED' when text is not null then 'UNKNOWN' end as reason, count(*) as texts from documents group by 1""")
def failure_reasons(spark: SparkSession, folder: str) -> DataFrame:
    """Reason codes of all reports' texts."""
    return table(spark, folder, "documents", "text").groupBy(gapstates.failure_reason(F.col("text")).alias("reason")).agg(F.count(F.lit(1)).alias("texts"))


# Roll-ups and audits ----------------------------------------------------------------------


@query("""with h as (select source, regexp_replace(lower(message_id), '^sha256:', '') as h, count(*) as n, min(received_at) as a, max(received_at) as b, sum(length(payload)) as c from ws_envelope group by 1, 2)
  select source, cast(sum(n) as bigint) as messages, count(h) as contents, cast(sum(case when h is null then 0 else n - 1 end) as bigint) as repeats, epoch_us(min(a)) as first_us, epoch_us(max(b)) as last_us, cast(sum(c) as bigint) as characters from h group by 1""")
def stream_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Messages, contents and repeated deliveries of every stream over all its sessions."""
    rows = table(spark, folder, "ws_envelope", "source", "received_at", "payload", F.regexp_replace(F.lower("message_id"), r"\Asha256:", "").alias("h"))
    found = audit.stream_totals(rows, ["source"], "h", "received_at", {"characters": F.char_length("payload")})
    return found.select("source", "messages", "contents", "repeats", F.unix_micros("first_received").alias("first_us"), F.unix_micros("last_received").alias("last_us"), "characters")


@query("""select manifest_path, count(*) as records, cast(sum(coalesce(n_rows, 0)) as bigint) as rows, cast(sum(coalesce(n_bytes, n_rows, 0)) as bigint) as bytes from active_artifact group by 1""")
def run_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Records, rows and bytes of every manifest; unknown bytes count as the rows, unknown rows as none."""
    return audit.roll_up(table(spark, folder, "active_artifact", "manifest_path", "n_rows", "n_bytes"), ["manifest_path"], {"rows": ["n_rows"], "bytes": ["n_bytes", "n_rows"]})


@query("""select instrument_id, count(*) as rows, epoch_us(min(event_time)) as first_us, epoch_us(max(event_time)) as last_us, epoch_us(max(knowledge_time)) as known_us from liquidation group by 1""")
def coverage_bounds(spark: SparkSession, folder: str) -> DataFrame:
    found = audit.coverage(table(spark, folder, "liquidation", "instrument_id", "event_time", "knowledge_time"), ["instrument_id"], "event_time", "knowledge_time")
    return found.select("instrument_id", "rows", F.unix_micros("first_event").alias("first_us"), F.unix_micros("last_event").alias("last_us"), F.unix_micros("last_knowledge").alias("known_us"))


@query("""select o_orderstatus, cast(year(o_orderdate) as integer) as year, count(*) as rows from orders group by 1, 2""")
def rows_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return audit.by_year(table(spark, folder, "orders", "o_orderstatus", "o_orderdate"), ["o_orderstatus"], "o_orderdate")


@query(f"""with f as (select {PLAIN_SQL} as p, max(n_bytes) as s from active_artifact group by 1), x as (select s, unnest(list_transform(generate_series(0, least(len(string_split(p, '/')) - 1, 3)), lambda n: array_to_string(list_slice(string_split(p, '/'), 1, n), '/'))) as folder from f) select folder, count(*) as files, cast(coalesce(sum(s), 0) as bigint) as bytes from x group by 1""")
def tree_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Files and bytes of every folder that manifests name, three levels deep."""
    files = table(spark, folder, "active_artifact", "relative_path", "n_bytes").groupBy(plain_path(F.col("relative_path")).alias("path")).agg(F.max("n_bytes").alias("size"))
    return audit.tree_sizes(files, "path", "size", 3)


@query("""select instrument_id, count(v) as n, round(min(v), 6) as lowest, round(max(v), 6) as highest, round(avg(v), 6) as mean from (select instrument_id, try_cast(source_quantity as double) as v from liquidation) group by 1""")
def size_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(audit.statistics(table(spark, folder, "liquidation", "instrument_id", "source_quantity"), ["instrument_id"], F.col("source_quantity").try_cast("double")), "lowest", "highest", "mean")


@query(f"""with r as (select {PLAIN_SQL} as ref, arg_max(n_rows, manifest_record_number) as n, arg_max(exchange, manifest_record_number) as exchange from active_artifact group by 1), t as (select raw_object_ref as ref, count(*) as k from archive_trade where raw_object_ref is not null group by 1),
  j as (select coalesce(r.ref, t.ref) as ref, r.ref is not null as listed, r.exchange, n, k, coalesce(r.ref is not null and k % 7 = 0, false) as q from (select * from r where ref like '%individual_trade%') r full join t on r.ref = t.ref)
  select exchange, count(*) filter (listed) as listed, count(*) filter (q) as quarantined, count(*) filter (listed and not q) as active, count(*) filter (listed and not q and k is null and coalesce(n, 1) > 0) as missing, count(*) filter (not listed) as unlisted, count(*) filter (listed and not q and k <> n) as row_mismatches, cast(coalesce(sum(k) filter (listed and not q), 0) as bigint) as rows from j group by 1""")
def data_root_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Listed trade files against the archive's rows; files whose row count is a multiple of seven are quarantined."""
    latest = table(spark, folder, "active_artifact", "relative_path", "manifest_record_number", "n_rows", "exchange").groupBy(plain_path(F.col("relative_path")).alias("ref")).agg(F.max_by("n_rows", "manifest_record_number").alias("n_rows"), F.max_by("exchange", "manifest_record_number").alias("exchange"))
    stored = table(spark, folder, "archive_trade", "raw_object_ref").filter("raw_object_ref is not null").groupBy(F.col("raw_object_ref").alias("ref")).agg(F.count(F.lit(1)).alias("n_rows"))
    hidden = stored.filter("n_rows % 7 = 0").select(F.regexp_extract("ref", r"([^/]*)\z", 1).alias("name"))
    return audit.data_root(latest.filter("ref like '%individual_trade%'"), stored, ["exchange"], hidden)


COMPLETE_SQL = """with s as (select raw_object_ref as source, count(*) as rows from archive_trade where raw_object_ref is not null group by 1),
  d as (select raw_object_ref as source, count(*) as n from archive_trade where raw_object_ref is not null and taker_side is not null group by 1), c as (select s.source, coalesce(d.n = s.rows and s.rows % 9 <> 0, false) as complete from s left join d using (source))"""


def _complete(spark: SparkSession, folder: str) -> DataFrame:
    """Trade files with their derived records: these count rows with a side, and files of a multiple of nine rows have two."""
    rows = table(spark, folder, "archive_trade", "raw_object_ref", "taker_side").filter("raw_object_ref is not null")
    sources = rows.groupBy(F.col("raw_object_ref").alias("source")).agg(F.count(F.lit(1)).alias("rows"), F.count("taker_side").alias("source_rows"))
    derived = sources.filter("source_rows > 0").select("source", "source_rows")
    return audit.complete_sources(derived.unionByName(sources.filter("rows % 9 = 0").select("source", "source_rows")), sources.select("source", "rows"))


@query(COMPLETE_SQL + " select complete, count(*) as sources from c group by 1")
def complete_sources(spark: SparkSession, folder: str) -> DataFrame:
    return _complete(spark, folder).groupBy("complete").agg(F.count(F.lit(1)).alias("sources"))


LEDGER_SQL = COMPLETE_SQL + """, p as (select source as ref, sha256(source) as sha from c where complete union all select source || '.1s', sha256(source || '.1s') from c where complete)"""


@query(LEDGER_SQL + """, a as (select ref, case when ascii(right(sha, 1)) % 2 = 0 then 'DELETED' else 'CHECKSUM_CHANGED' end as status from p where ref not like '%0.parquet') select status, count(*) as objects from a group by 1""")
def deletion_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Deletions planned for complete sources and applied once more: what the ledger holds isn't applied again, and changed files stay."""
    files = _complete(spark, folder).select("source", F.explode(F.array("source", F.concat("source", F.lit(".1s")))).alias("ref")).withColumn("sha256", F.sha2("ref", 256))
    planned = audit.deletion_plan(files, _complete(spark, folder))
    there = files.select("ref", F.when(F.ascii(F.substring("sha256", -1, 1)) % 2 == 0, F.col("sha256")).otherwise("other").alias("sha256"))
    empty = spark.createDataFrame([], "deletion_id string")
    done = audit.applied(planned.filter("object_id like '%0.parquet'"), empty, there, dry_run=False)
    return audit.applied(planned, done, there, dry_run=False).groupBy("status").agg(F.count(F.lit(1)).alias("objects"))


@query(f"""select {PLAIN_SQL} as hold from active_artifact group by 1 having arg_max(manifest_record_number % 3, manifest_record_number) <> 0""")
def holds_in_force(spark: SparkSession, folder: str) -> DataFrame:
    """Holds of a log in which every third event takes its hold away."""
    rows = table(spark, folder, "active_artifact", "relative_path", "manifest_record_number")
    return audit.holds(rows.select(plain_path(F.col("relative_path")).alias("hold"), F.col("manifest_record_number").alias("seq"), F.when(F.col("manifest_record_number") % 3 == 0, "REMOVED").otherwise("ADDED").alias("event")))


# Baseline ---------------------------------------------------------------------------------

#: Own policies in the form a policy document has.
DOCUMENT = {
    "policy_version": "1", "policies": {
        "semantic_unique_key": {"calibration_state": "CALIBRATED", "comparison": "MAXIMUM", "threshold": 0.01, "failure_impact": "UNAVAILABLE"}, "required_side": {"calibration_state": "CALIBRATED", "comparison": "MAXIMUM", "threshold": 0.02, "failure_impact": "UNAVAILABLE"},
        "exact_wire_replay": {"calibration_state": "CALIBRATED", "comparison": "MAXIMUM", "threshold": 0.0, "failure_impact": "DEGRADE"}, "archive_freshness": {"calibration_state": "NOT_APPLICABLE"}, "event_driven_freshness": {"calibration_state": "UNCALIBRATED", "failure_impact": "DEGRADE"},
        "synchronous_queue": {"calibration_state": "NOT_APPLICABLE"}, "no_queue_telemetry": {"calibration_state": "UNCALIBRATED", "failure_impact": "DEGRADE"}, "missing_proven_identity_key": {"calibration_state": "UNCALIBRATED", "failure_impact": "DEGRADE"},
    },
}
ORDERS_SQL = "coalesce(exchange, 'UNKNOWN') as exchange, coalesce(market_type, 'UNKNOWN') as market_type, coalesce(instrument_id, 'UNKNOWN') as instrument_id, coalesce({s}, 'UNKNOWN') as source_dataset_id, coalesce(schema_version, 'UNKNOWN') as source_contract_version"
BASELINE_SQL = f"""with t as (select 'individual_trade' as dataset_class, {ORDERS_SQL.format(s="source_dataset_id")}, count(*) as n, count(*) - count(distinct (instrument_id, source_dataset_id, native_trade_id)) as d, count(*) filter (not coalesce(upper(taker_side) in ('BUY', 'SELL'), false)) as u from archive_trade group by all),
  l as (select 'liquidations' as dataset_class, {ORDERS_SQL.format(s="source")}, count(*) as n, count(*) filter (not coalesce(upper(source_side) in ('BUY', 'SELL'), false)) as u, count(dedup_fingerprint) - count(distinct dedup_fingerprint) as r from liquidation group by all),
  q as (values ('queue_utilization'), ('queue_high_watermark'), ('writer_lag_seconds')), i as (select dataset_class, exchange, market_type, instrument_id, source_dataset_id, source_contract_version from t union select dataset_class, exchange, market_type, instrument_id, source_dataset_id, source_contract_version from l),
  g as ({RECOVERY_SQL.replace("with m as", "with m as", 1)} select instrument_id, count(*) filter (status = 'UNRECOVERABLE') as bad, count(*) filter (status = 'PARTIAL') as unsure from r group by 1),
  x as (select dataset_class, exchange, market_type, instrument_id, 'duplicate_rate' as metric, 'semantic_unique_key' as policy_id, case when d / n <= 0.01 then 'PASS' else 'FAIL' end as evaluation, case when d / n <= 0.01 then 'NONE' else 'UNAVAILABLE' end as impact from t
    union all select dataset_class, exchange, market_type, instrument_id, 'freshness_age_seconds', 'archive_freshness', 'NOT_APPLICABLE', 'NONE' from t union all select dataset_class, exchange, market_type, instrument_id, col0, 'no_queue_telemetry', 'UNKNOWN', 'DEGRADE' from t, q
    union all select dataset_class, exchange, market_type, instrument_id, 'unexpected_unknown_rate.taker_side', 'required_side', case when u / n <= 0.02 then 'PASS' else 'FAIL' end, case when u / n <= 0.02 then 'NONE' else 'UNAVAILABLE' end from t
    union all select dataset_class, exchange, market_type, instrument_id, 'duplicate_rate', 'missing_proven_identity_key', 'UNKNOWN', 'DEGRADE' from l union all select dataset_class, exchange, market_type, instrument_id, 'unexpected_unknown_rate.source_side', 'required_side', case when u / n <= 0.02 then 'PASS' else 'FAIL' end, case when u / n <= 0.02 then 'NONE' else 'UNAVAILABLE' end from l
    union all select dataset_class, exchange, market_type, instrument_id, 'freshness_status', 'event_driven_freshness', 'UNKNOWN', 'DEGRADE' from l union all select dataset_class, exchange, market_type, instrument_id, 'duplicate_rate.exact_wire_replay', 'exact_wire_replay', case when r / n <= 0 then 'PASS' else 'FAIL' end, case when r / n <= 0 then 'NONE' else 'DEGRADE' end from l
    union all select dataset_class, exchange, market_type, instrument_id, col0, 'synchronous_queue', 'NOT_APPLICABLE', 'NONE' from l, q
    union all select i.dataset_class, i.exchange, i.market_type, i.instrument_id, 'gap_exposure', 'gap_status_policy', case when coalesce(bad, 0) > 0 or coalesce(unsure, 0) > 0 then 'FAIL' else 'PASS' end, case when coalesce(bad, 0) > 0 then 'UNAVAILABLE' when coalesce(unsure, 0) > 0 then 'DEGRADE' else 'NONE' end from i left join g on i.instrument_id = g.instrument_id)"""


def _profile(spark: SparkSession, folder: str) -> DataFrame:
    trades = table(spark, folder, "archive_trade", "exchange", "market_type", "instrument_id", "source_dataset_id", "schema_version", "native_trade_id", "taker_side")
    orders = table(spark, folder, "liquidation", "exchange", "market_type", "instrument_id", "source", "schema_version", "source_side", "dedup_fingerprint")
    specs = [(trades, baseline.Spec("individual_trade", "source_dataset_id", "schema_version", ("instrument_id", "source_dataset_id", "native_trade_id"), "taker_side")), (orders, baseline.Spec("liquidations", "source", "schema_version", None, "source_side", True))]
    unknown = lambda c, n: F.coalesce(F.col(c), F.lit("UNKNOWN")).alias(n)
    named = orders.select(F.lit("liquidations").alias("dataset_class"), unknown("exchange", "exchange"), unknown("market_type", "market_type"), unknown("instrument_id", "instrument_id"), unknown("source", "source_dataset_id"), unknown("schema_version", "source_contract_version"), "dedup_fingerprint")
    totals = audit.stream_totals(named.withColumn("t", F.lit(None).cast("timestamp")), list(baseline.IDENTITY), "dedup_fingerprint", "t")
    streams = totals.select(*baseline.IDENTITY, F.lit(False).alias("quiet"), F.lit(True).alias("transport_ok"), F.col("messages").alias("raw_messages"), F.col("repeats").alias("replays"), F.col("contents").alias("source_events"))
    gaps = _recovered(spark, folder).select("instrument_id", "status").join(streams.select("instrument_id").distinct().unionByName(trades.select("instrument_id").distinct()).distinct(), "instrument_id")
    identities = named.select("dataset_class", "exchange", "market_type", "instrument_id").unionByName(trades.select(F.lit("individual_trade").alias("dataset_class"), unknown("exchange", "exchange"), unknown("market_type", "market_type"), unknown("instrument_id", "instrument_id"))).distinct()
    return baseline.profile(specs, baseline.policies(spark, DOCUMENT), identities.join(gaps, "instrument_id"), streams)


@query(BASELINE_SQL + " select dataset_class, exchange, market_type, instrument_id, metric, policy_id, evaluation, impact as eligibility_impact from x")
def dq_baseline(spark: SparkSession, folder: str) -> DataFrame:
    """Every metric of the trade archive and the forced orders, judged by policies."""
    return _profile(spark, folder).select("dataset_class", "exchange", "market_type", "instrument_id", "metric", "policy_id", "evaluation", "eligibility_impact")


@query(BASELINE_SQL + """ select count(*) as metrics, count(*) filter (evaluation = 'PASS') as pass, count(*) filter (evaluation = 'FAIL') as fail, count(*) filter (evaluation = 'UNKNOWN') as unknown, count(*) filter (evaluation = 'NOT_APPLICABLE') as not_applicable,
  case when count(*) filter (impact = 'UNAVAILABLE') > 0 then 'UNAVAILABLE' when count(*) filter (impact = 'DEGRADE') > 0 then 'DEGRADED' else 'USABLE' end as eligibility from x""")
def dq_verdict(spark: SparkSession, folder: str) -> DataFrame:
    return baseline.verdict(_profile(spark, folder))


# Generations ------------------------------------------------------------------------------


@query("""with o as (select o_orderkey, year(o_orderdate) as y, o_orderstatus from orders), n as (select * from o where y in (select y from o where o_orderstatus = 'P' group by 1)) select cast(y as bigint) as year, count(*) as rows, case when y in (select y from n) then 'second' else 'first' end as generation from o where y not in (select y from n) or o_orderstatus <> 'F' group by 1, 3""")
def yearly_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """Yearly partitions of which those that a second batch has rows for are replaced by it, and the others stay."""
    rows = table(spark, folder, "orders", "o_orderkey", "o_orderdate", "o_orderstatus").withColumn("part", F.year("o_orderdate").cast("bigint"))
    held = publish.GenerationTable(spark, f"{scratch(spark, 'years')}/t", rows.select("o_orderkey", "o_orderstatus").withColumn("generation", F.lit("")).schema)
    years = [r["part"] for r in rows.filter("o_orderstatus = 'P'").select("part").distinct().collect()]  # calendar years, not data
    held.publish(rows.withColumn("generation", F.lit("first")))
    held.overwrite(rows.filter(F.col("part").isin(years) & (F.col("o_orderstatus") != "F")).withColumn("generation", F.lit("second")), years)
    return held.read().groupBy(F.col("part").alias("year"), "generation").agg(F.count(F.lit(1)).alias("rows"))
