"""Data contracts: declared fields and rules that compile to schemas, gates and violation columns.

Rules are SQL predicates over a row. A null outcome breaks a rule, so optional fields say so
themselves. What depends on other rows (repeated keys, times that don't rise) is added by
:func:`sequence_issues`, which reads each row's predecessor in blocks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.operators import quality, sequence


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = True
    unit: str | None = None


@dataclass(frozen=True)
class Contract:
    """What a dataset's rows must look like; ``key`` names the natural key, ``dataset_class`` the only class allowed."""

    contract_id: str
    version: str
    fields: tuple[Field, ...]
    rules: Mapping[str, str] = field(default_factory=dict)
    key: tuple[str, ...] = ()
    dataset_class: str | None = None

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, T._parse_datatype_string(f.type), f.nullable) for f in self.fields])

    def shape_problems(self, df: DataFrame) -> list[str]:
        """Fields that lack, that aren't declared, or that have another type; from the schema alone."""
        found = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        declared = {f.name: T._parse_datatype_string(f.type).simpleString() for f in self.fields}
        return (
            [f"missing {n}" for n in declared if n not in found] + [f"unknown {n}" for n in found if n not in declared]
            + [f"{n} is {found[n]}, not {t}" for n, t in declared.items() if n in found and found[n] != t]
        )

    def violations(self) -> Column:
        """The names of required fields that are null and of rules that a row breaks."""
        required = {f"{f.name}_required": F.col(f.name).isNotNull() for f in self.fields if not f.nullable}
        return quality.violations(required | {name: F.expr(rule) for name, rule in self.rules.items()})

    def checked(self, df: DataFrame) -> DataFrame:
        """``df`` with ``violations``; a frame of another shape is refused before anything runs."""
        if problems := self.shape_problems(df):
            raise ValueError(f"{self.contract_id} {self.version}: {', '.join(problems)}")
        return df.withColumn("violations", self.violations())


HEX64 = "rlike '^[a-f0-9]{64}$'"
# The states of records that logs hold.
ACTIONS = ("INGESTED", "VALIDATED", "NORMALIZED", "COMPACTED", "SUPERSEDED", "QUARANTINED", "DELETION_PLANNED", "DELETED", "DELETE_FAILED")
GAP_KINDS = ("exchange_gap", "local_collector_gap", "unknown_gap")
LATER = "({b} is null or {a} is null or {b} >= {a})"


def _times(*names: str, required: Sequence[str] = ()) -> tuple[Field, ...]:
    return tuple(Field(n, "timestamp", n not in required) for n in names)


MANIFEST_EVENT = Contract(
    "manifest_event", "1.0.0",
    (Field("event_id", "string", False), Field("action", "string", False), Field("object_id", "string", False), *_times("occurred_at", "coverage_start", "coverage_end", required=["occurred_at"]), Field("checksum_sha256", "string"), Field("reason", "string"),
     Field("schema_version", "string", False), Field("collector_version", "string", False), Field("normalization_version", "string", False)),
    {"known_action": f"action in {ACTIONS}", "checksum_form": f"checksum_sha256 is null or checksum_sha256 {HEX64}", "coverage_order": LATER.format(a="coverage_start", b="coverage_end")}, ("event_id",),
)
CHECKPOINT = Contract(
    "checkpoint", "1.0.0",
    (Field("checkpoint_id", "string", False), Field("source_dataset_id", "string", False), Field("instrument_id", "string", False), Field("cursor", "string"), *_times("committed_at", "last_event_time", "last_knowledge_time", required=["committed_at"])),
    {"event_committed": LATER.format(a="last_event_time", b="committed_at"), "knowledge_committed": LATER.format(a="last_knowledge_time", b="committed_at"), "known_after_event": LATER.format(a="last_event_time", b="last_knowledge_time")}, ("checkpoint_id",),
)
GAP_RECORD = Contract(
    "gap_record", "1.0.0",
    (Field("gap_id", "string", False), Field("source_dataset_id", "string", False), Field("instrument_id", "string", False), Field("kind", "string", False), *_times("started_at", "ended_at", "detected_at", required=["started_at", "ended_at", "detected_at"]),
     Field("status", "string", False), Field("reason", "string")),
    {"known_kind": f"kind in {GAP_KINDS}", "ends_after_start": "ended_at > started_at", "detected_after_start": "detected_at >= started_at"}, ("gap_id",),
)
DELETION_RECORD = Contract(
    "deletion_record", "1.0.0",
    (Field("deletion_id", "string", False), Field("object_id", "string", False), *_times("planned_at", "deleted_at", "coverage_start", "coverage_end", required=["planned_at"]), Field("reason", "string", False), Field("checksum_sha256", "string")),
    {"checksum_form": f"checksum_sha256 is null or checksum_sha256 {HEX64}", "deleted_with_checksum": "deleted_at is null or checksum_sha256 is not null", "deleted_after_plan": LATER.format(a="planned_at", b="deleted_at"),
     "coverage_order": LATER.format(a="coverage_start", b="coverage_end")}, ("deletion_id",),
)

NUMBER = "try_cast({c} as decimal(38,18))"
#: Rules of forced orders as the two venues publish them: one samples a window and hides the side, the other states a bankruptcy price.
WINDOWED_ORDERS = {
    "identity": "exchange = 'binance' and instrument_id like 'ins\\_%'", "known_when_received": "knowledge_time <=> received_at", "no_side_inferred": "position_side_liquidated = 'UNKNOWN'",
    "window": "source_window_ms = 1000", "incompleteness_flagged": "array_contains(dq_flags, 'SOURCE_SELECTION_INCOMPLETENESS')",
}
STATED_ORDERS = {
    "exchange": "exchange = 'bybit'", "market": "market_type = 'perpetual' and contract_type = 'linear_perpetual'", "side_domain": "position_side_liquidated in ('LONG', 'SHORT', 'UNKNOWN')", "price_semantic": "price_semantic = 'bankruptcy_price'",
    "quantity_positive": f"{NUMBER.format(c='source_quantity')} > 0", "price_positive": f"{NUMBER.format(c='source_price')} > 0", "known_when_received": "knowledge_time <=> received_at",
}
FUNDING = {
    "rate_number": f"{NUMBER.format(c='funding_rate')} is not null", "mark_positive": f"mark_price is null or {NUMBER.format(c='mark_price')} > 0", "instrument": "instrument_id like 'ins\\_%'", "market": "market_type = 'perpetual'",
}
OPEN_INTEREST = {"base_not_negative": f"{NUMBER.format(c='oi_base')} >= 0", "notional_not_negative": f"oi_notional is null or {NUMBER.format(c='oi_notional')} >= 0"}


def sequence_issues(df: DataFrame, rules: Mapping[str, str], key: Sequence[str], series: Sequence[str], time: str, order: str) -> DataFrame:
    """``df`` with ``issues``: rules broken, ``duplicate_key`` on every row of a natural key but its first, ``not_later`` where time doesn't rise.

    ``order`` is the whole number in which rows came, unique within a series. The first row of a
    series has no predecessor and can't be late; a null time is not later than any.
    """
    first = df.groupBy(*key).agg(F.min(order).alias("__first"), F.count(F.lit(1)).alias("__n")).filter("__n > 1")
    same = None
    for k in key:
        one = F.col(k).eqNullSafe(F.col(f"__k_{k}"))
        same = one if same is None else same & one
    first = first.select("__first", *(F.col(k).alias(f"__k_{k}") for k in key))
    seen = sequence.with_previous(df, series, order, {"t": F.col(time)}).join(first, same, "left")
    late = F.col("__previous").isNotNull() & ~F.coalesce(F.col(time) > F.col("__previous.t"), F.lit(False))
    extra = F.array_compact(F.array(F.when(F.coalesce(F.col(order) > F.col("__first"), F.lit(False)), F.lit("duplicate_key")), F.when(late, F.lit("not_later"))))
    return seen.withColumn("issues", F.concat(extra, quality.violations({n: F.expr(r) for n, r in rules.items()}))).select(*df.columns, "issues")


def isolated(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """``df`` unchanged, but running it fails on the first row of another class, venue, market or dataset than expected."""
    return quality.require(df, {f"{c} is {v}": F.col(c).eqNullSafe(F.lit(v)) for c, v in expected.items()})


def strangers(df: DataFrame, expected: Mapping[str, str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., rows, strangers): how many rows an isolation gate would refuse."""
    ok = None
    for c, v in expected.items():
        one = F.col(c).eqNullSafe(F.lit(v))
        ok = one if ok is None else ok & one
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(~ok).alias("strangers"))


def upgraded(records: DataFrame, defaults: Mapping[str, str], renamed: Mapping[str, Mapping[str, str]] | None = None) -> DataFrame:
    """Old records in the present form: fields they lack or leave null get defaults (SQL), values of old enumerations their present names."""
    out = records
    for name, old in (renamed or {}).items():
        value = F.col(name)
        for before, now in old.items():
            value = F.when(F.col(name) == before, now).otherwise(value)
        out = out.withColumn(name, value)
    return out.withColumns({n: F.coalesce(F.col(n), F.expr(d)) if n in records.columns else F.expr(d) for n, d in defaults.items()})


def revised(log: DataFrame, changes: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """The append-only log with a new state of every changed record: the latest row of its key under the changed values, numbered on.

    ``changes`` has the key and any columns of the log; null means unchanged. Changes to unknown
    keys add nothing. New rows of one key are numbered after its latest.
    """
    now = sequence.latest(log, key, [order])
    named = [c for c in changes.columns if c not in key]
    joined = now.join(changes.select(*key, *(F.col(c).alias(f"__to_{c}") for c in named)), list(key))
    values = {c: F.coalesce(F.col(f"__to_{c}"), F.col(c)) for c in named if c != order}
    fresh = joined.withColumns(values | {order: (F.col(order) + 1).cast(log.schema[order].dataType)}).select(*log.columns)
    return log.unionByName(fresh)


def changes_of_state(log: DataFrame, key: Sequence[str], order: str, state: str, allowed: Mapping[str, Sequence[str]], first: str) -> DataFrame:
    """(key..., order, was, now) of transitions that ``allowed`` doesn't name, a record's first state other than ``first`` included."""
    seen = sequence.with_previous(log, key, order, {"s": F.col(state)})
    pairs = F.array(*(F.lit(f"{a}>{b}") for a, bs in allowed.items() for b in bs), F.lit(f">{first}"))
    step = F.concat_ws(">", F.coalesce("__previous.s", F.lit("")), F.coalesce(state, F.lit("")))
    return seen.filter(~F.array_contains(pairs, step)).select(*key, order, F.col("__previous.s").alias("was"), F.col(state).alias("now"))


def natural_key_window(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with ``copy``: 1 for the first row of a key in ``order``, and on."""
    return df.withColumn("copy", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
