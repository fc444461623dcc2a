"""The quality baseline: every dataset's metrics, judged by policies, as one table and one verdict."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.operators import quality

IDENTITY = ("dataset_class", "exchange", "market_type", "instrument_id", "source_dataset_id", "source_contract_version")
POLICY = "policy_id string, calibration_state string, comparison string, threshold double, failure_impact string"
# The states a policy and an impact may have.
CALIBRATIONS, COMPARISONS, IMPACTS = ("CALIBRATED", "UNCALIBRATED", "NOT_APPLICABLE"), ("MAXIMUM", "MINIMUM", "CATEGORICAL", "NONE"), ("NONE", "DEGRADE", "UNAVAILABLE")
QUEUE_METRICS = ("queue_utilization", "queue_high_watermark", "writer_lag_seconds")


@dataclass(frozen=True)
class Spec:
    """How a dataset is measured: the columns of its source and contract, its unique key if one is proven, its side."""

    dataset_class: str
    source: str
    contract: str
    key: tuple[str, ...] | None
    side: str | None = None
    event_driven: bool = False


# How the catalog's datasets are measured. The identity of a liquidation isn't proven by any key.
SPECS = (
    Spec("ohlcv", "source_dataset_id", "data_contract_version", ("instrument_id", "source_dataset_id", "interval", "open_time")),
    Spec("individual_trade", "source_dataset_id", "schema_version", ("instrument_id", "source_dataset_id", "native_trade_id"), "taker_side"),
    Spec("derived_trade_bucket", "source_dataset_id", "aggregation_version", ("instrument_id", "source_dataset_id", "source_parquet_sha256", "bucket_seconds", "bucket_start")),
    Spec("funding_rate", "source", "source_contract_version", ("exchange", "instrument_id", "source_contract_version", "funding_time")),
    Spec("open_interest", "source", "source_contract_version", ("exchange", "instrument_id", "source_contract_version", "observation_time")),
    Spec("liquidations", "source", "schema_version", None, "source_side", True),
)


def policies(spark: SparkSession, document: Mapping[str, object]) -> DataFrame:
    """The policies of a document {policy_version, policies: {id: {...}}} as a table; what can't be meant is refused.

    A version is required; a calibrated MAXIMUM or MINIMUM needs a threshold, an uncalibrated or
    inapplicable policy may have none.
    """
    version, listed = str(document.get("policy_version") or "").strip(), document.get("policies")
    if not version or not isinstance(listed, Mapping):
        raise ValueError("a policy document needs a policy_version and policies")
    rows = []
    for name, p in listed.items():
        state, comparison, threshold, impact = p["calibration_state"], p.get("comparison", "NONE"), p.get("threshold"), p.get("failure_impact", "NONE")
        if state not in CALIBRATIONS or comparison not in COMPARISONS or impact not in IMPACTS:
            raise ValueError(f"policy {name}: unknown state, comparison or impact")
        if state == "CALIBRATED" and comparison in ("MAXIMUM", "MINIMUM") and threshold is None:
            raise ValueError(f"policy {name} is calibrated and needs a threshold")
        if state != "CALIBRATED" and threshold is not None:
            raise ValueError(f"policy {name} isn't calibrated and can't have a threshold")
        rows.append((name, state, comparison, None if threshold is None else float(threshold), impact))
    return spark.createDataFrame(rows, POLICY)


def load_policies(spark: SparkSession, path: str) -> DataFrame:
    """Policies from a JSON file, or a YAML one where a reader for it is installed."""
    text = "\n".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect())  # one small file
    if path.endswith((".yaml", ".yml")):
        import yaml

        return policies(spark, yaml.safe_load(text))
    return policies(spark, json.loads(text))


def judged(metrics: DataFrame, table: DataFrame) -> DataFrame:
    """``metrics`` (policy_id, observed_value, ...) with evaluation and eligibility_impact; unknown policies count as uncalibrated, without impact."""
    joined = metrics.join(F.broadcast(table), "policy_id", "left")  # a policy document's few rows
    value, limit = F.col("observed_value").try_cast("double"), F.col("threshold")
    met = F.when(F.col("comparison") == "MAXIMUM", value <= limit).when(F.col("comparison") == "MINIMUM", value >= limit).when(F.col("comparison") == "CATEGORICAL", F.lit(True))
    unknown = (F.coalesce("calibration_state", F.lit("UNCALIBRATED")) == "UNCALIBRATED") | F.col("observed_value").isNull() | met.isNull()
    evaluation = F.when(F.col("calibration_state") == "NOT_APPLICABLE", "NOT_APPLICABLE").when(unknown, "UNKNOWN").when(met, "PASS").otherwise("FAIL")
    impact = F.when(evaluation.isin("UNKNOWN", "FAIL"), F.coalesce("failure_impact", F.lit("NONE"))).otherwise("NONE")
    return joined.withColumns({"evaluation": evaluation, "eligibility_impact": impact})


def _metric(rows: DataFrame, *metrics: tuple[str, Column, Column, str]) -> DataFrame:
    """One row per (metric, value, observations, policy) of each identity."""
    cells = F.array(*(F.struct(F.lit(m).alias("metric"), v.cast("string").alias("observed_value"), n.cast("bigint").alias("observations"), F.lit(p).alias("policy_id")) for m, v, n, p in metrics))
    return rows.select(*IDENTITY, F.explode(cells).alias("m")).select(*IDENTITY, "m.*")


def measured(df: DataFrame, spec: Spec) -> DataFrame:
    """The metrics of one dataset per identity; unknown identity parts read UNKNOWN."""
    named = df.select(
        F.lit(spec.dataset_class).alias("dataset_class"), *(F.coalesce(F.col(c).cast("string"), F.lit("UNKNOWN")).alias(n) for c, n in (("exchange", "exchange"), ("market_type", "market_type"), ("instrument_id", "instrument_id"), (spec.source, "source_dataset_id"), (spec.contract, "source_contract_version"))),
        *(F.col(k).alias(f"__k{i}") for i, k in enumerate(spec.key or ())), *([F.col(spec.side).alias("__side")] if spec.side else []),
    )
    counted = quality.measures(named, IDENTITY, [f"__k{i}" for i in range(len(spec.key or ()))] or ["exchange"], "__side" if spec.side else None)
    none, rows = F.lit(None).cast("string"), F.col("rows")
    wanted = [("duplicate_rate", (F.col("duplicates") / rows) if spec.key else none, rows, "semantic_unique_key" if spec.key else "missing_proven_identity_key")]
    if not spec.event_driven:
        wanted.append(("freshness_age_seconds", none, rows, "archive_freshness"))
        wanted += [(m, none, F.lit(None), "no_queue_telemetry") for m in QUEUE_METRICS]
    if spec.side:
        wanted.append((f"unexpected_unknown_rate.{spec.side}", F.col("unknown_sides") / rows, rows, "required_side"))
    return _metric(counted, *wanted)


def gap_metrics(identities: DataFrame, registry: DataFrame) -> DataFrame:
    """gap_exposure of each identity: UNRECOVERABLE gaps make it unavailable, open, partial or unknown ones degrade it."""
    keys = ["dataset_class", "exchange", "market_type", "instrument_id"]
    states = ("OPEN", "RECOVERED", "PARTIAL", "UNRECOVERABLE", "UNKNOWN")
    counts = registry.groupBy(*keys).agg(F.count(F.lit(1)).alias("observations"), *(F.count_if(F.col("status") == s).alias(s) for s in states))
    joined = identities.join(counts, keys, "left")
    n = lambda s: F.coalesce(F.col(s), F.lit(0))
    bad, unsure = n("UNRECOVERABLE") > 0, (n("OPEN") + n("PARTIAL") + n("UNKNOWN")) > 0
    return joined.select(
        *IDENTITY, F.lit("gap_exposure").alias("metric"), F.to_json(F.struct(*(n(s).alias(s) for s in sorted(states)))).alias("observed_value"), n("observations").cast("bigint").alias("observations"), F.lit("gap_status_policy").alias("policy_id"),
        F.when(bad | unsure, "FAIL").otherwise("PASS").alias("evaluation"), F.when(bad, "UNAVAILABLE").when(unsure, "DEGRADE").otherwise("NONE").alias("eligibility_impact"),
    )


def stream_metrics(streams: DataFrame) -> DataFrame:
    """Operational metrics of captured streams: freshness, exact replays, and the queue.

    ``streams`` has the identity, quiet and transport_ok (booleans), raw_messages, replays and
    source_events. Without any message the replay rate is null. These streams are read and written
    in one step, so that the queue's metrics don't apply.
    """
    fresh = F.when(F.col("quiet") & F.col("transport_ok"), "LOW_ACTIVITY_QUIET").otherwise("UNKNOWN")
    rate = F.when(F.col("raw_messages") > 0, F.col("replays") / F.col("raw_messages"))
    return _metric(
        streams, ("freshness_status", fresh, F.col("source_events"), "event_driven_freshness"), ("duplicate_rate.exact_wire_replay", rate, F.col("raw_messages"), "exact_wire_replay"),
        *((m, F.lit(None).cast("string"), F.lit(None), "synchronous_queue") for m in QUEUE_METRICS),
    )


def profile(datasets: Sequence[tuple[DataFrame, Spec]], table: DataFrame, registry: DataFrame, streams: DataFrame | None = None) -> DataFrame:
    """Every metric of every identity, judged: identity..., metric, observed_value, observations, policy_id, evaluation, eligibility_impact.

    Identities of event-driven datasets get their gaps only with their streams.
    """
    found = reduce(DataFrame.unionByName, (measured(df, spec) for df, spec in datasets))
    regular = [s.dataset_class for _, s in datasets if not s.event_driven]
    owners = found.filter(F.col("dataset_class").isin(*regular)).select(*IDENTITY).distinct()
    if streams is not None:
        found, owners = found.unionByName(stream_metrics(streams)), owners.unionByName(streams.select(*IDENTITY).distinct())
    columns = [*IDENTITY, "metric", "observed_value", "observations", "policy_id", "evaluation", "eligibility_impact"]
    return judged(found, table).select(*columns).unionByName(gap_metrics(owners, registry).select(*columns))


def verdict(profiled: DataFrame) -> DataFrame:
    """One row: the counts of every outcome, and UNAVAILABLE, DEGRADED or USABLE, whichever impact is worst."""
    outcomes = [F.count_if(F.col("evaluation") == e).alias(e.lower()) for e in ("PASS", "FAIL", "UNKNOWN", "NOT_APPLICABLE")]
    hard, soft = (F.count_if(F.col("eligibility_impact") == i) for i in ("UNAVAILABLE", "DEGRADE"))
    return profiled.agg(F.count(F.lit(1)).alias("metrics"), *outcomes, F.when(hard > 0, "UNAVAILABLE").when(soft > 0, "DEGRADED").otherwise("USABLE").alias("eligibility"))


def document(profiled: DataFrame) -> DataFrame:
    """The profile as JSON lines in a stable order, one per metric, keys sorted; write it with ``.write.text``."""
    ordered = profiled.select(*sorted(profiled.columns)).orderBy(*IDENTITY, "metric", "policy_id")
    return ordered.select(F.to_json(F.struct(*sorted(profiled.columns)), {"ignoreNullFields": "false"}).alias("value"))
