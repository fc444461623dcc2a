"""Roll-ups and audits of what was captured, published and kept, and the deletions they allow."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def roll_up(runs: DataFrame, by: Sequence[str], sums: Mapping[str, Sequence[str]]) -> DataFrame:
    """(by..., records, sums...): each sum takes the first of its columns that isn't null, else 0."""
    first = lambda names: F.coalesce(*(F.col(n) for n in names), F.lit(0))
    return runs.groupBy(*by).agg(F.count(F.lit(1)).alias("records"), *(F.sum(first(names)).alias(out) for out, names in sums.items()))


def stream_totals(messages: DataFrame, by: Sequence[str], wire_hash: str, received: str, counters: Mapping[str, Column] | None = None) -> DataFrame:
    """Per stream: messages, distinct wire contents, repeated deliveries, first and last receipt, and further sums.

    A content counts once per stream over all its sessions. Each content is reduced to one row
    first, so that a message delivered a thousand million times costs one row per task; messages
    without hash are told apart from none and repeat nothing.
    """
    counters = counters or {}
    rows = messages.select(*by, F.col(wire_hash).alias("__h"), F.col(received).alias("__t"), *(c.cast("bigint").alias(f"__c_{n}") for n, c in counters.items()))
    one = rows.groupBy(*by, "__h").agg(F.count(F.lit(1)).alias("__n"), F.min("__t").alias("__first"), F.max("__t").alias("__last"), *(F.sum(f"__c_{n}").alias(f"__c_{n}") for n in counters))
    known = F.col("__h").isNotNull()
    return one.groupBy(*by).agg(
        F.sum("__n").alias("messages"), F.count_if(known).alias("contents"), F.sum(F.when(known, F.col("__n") - 1).otherwise(0)).alias("repeats"),
        F.min("__first").alias("first_received"), F.max("__last").alias("last_received"), *(F.coalesce(F.sum(f"__c_{n}"), F.lit(0)).alias(n) for n in counters),
    )


def coverage(df: DataFrame, by: Sequence[str], event: str, knowledge: str | None = None) -> DataFrame:
    """(by..., rows, first_event, last_event[, last_knowledge]); rows without event time count as rows alone."""
    more = [F.max(knowledge).alias("last_knowledge")] if knowledge else []
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.min(event).alias("first_event"), F.max(event).alias("last_event"), *more)


def by_year(df: DataFrame, by: Sequence[str], time: str) -> DataFrame:
    """(by..., year, rows) by calendar year in UTC, as yearly partitions would hold them."""
    return df.groupBy(*by, F.year(time).alias("year")).agg(F.count(F.lit(1)).alias("rows"))


def tree_sizes(files: DataFrame, path: str, size: str, depth: int) -> DataFrame:
    """(folder, files, bytes) of every folder down to ``depth``, its subfolders' files included; '' is the root."""
    parts = F.split(path, "/")
    above = F.transform(F.sequence(F.lit(0), F.least(F.size(parts) - 1, F.lit(depth))), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    return files.select(F.explode(above).alias("folder"), F.col(size).alias("__s")).groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("__s"), F.lit(0)).alias("bytes"))


def statistics(df: DataFrame, by: Sequence[str], number: Column) -> DataFrame:
    """(by..., n, lowest, highest, mean) of the known values."""
    rows = df.select(*by, number.alias("__v"))
    return rows.groupBy(*by).agg(F.count("__v").alias("n"), F.min("__v").alias("lowest"), F.max("__v").alias("highest"), F.avg("__v").alias("mean"))


def data_root(listed: DataFrame, stored: DataFrame, by: Sequence[str], quarantined: DataFrame | None = None) -> DataFrame:
    """Per group, what manifests list against what is stored: files, rows, and files that lack, surplus or differ in rows.

    ``listed`` and ``stored`` have ref, n_rows and, the listed ones, the group columns. Stored
    files that no record lists stand in a group of nulls. ``quarantined`` (name) moves listed
    files out of the active ones.
    """
    name = F.regexp_extract("ref", r"([^/]*)\z", 1)
    files = listed.withColumn("__q", F.lit(False))
    if quarantined is not None:
        marked = quarantined.select(F.col("name").alias("__name")).distinct().withColumn("__hit", F.lit(True))
        files = listed.withColumn("__name", name).join(marked, "__name", "left").withColumn("__q", F.coalesce("__hit", F.lit(False))).drop("__name", "__hit")
    there = stored.select("ref", F.col("n_rows").alias("__stored"))
    both = files.withColumn("__listed", F.lit(1)).join(there, "ref", "full")
    active = F.col("__listed").isNotNull() & ~F.coalesce("__q", F.lit(False))
    return both.groupBy(*by).agg(
        F.count_if(F.col("__listed").isNotNull()).alias("listed"), F.count_if(F.coalesce("__q", F.lit(False))).alias("quarantined"), F.count_if(active).alias("active"),
        F.count_if(active & F.col("__stored").isNull() & (F.coalesce("n_rows", F.lit(1)) > 0)).alias("missing"), F.count_if(F.col("__listed").isNull()).alias("unlisted"),
        F.count_if(active & (F.col("__stored") != F.col("n_rows"))).alias("row_mismatches"), F.coalesce(F.sum(F.when(active, F.col("__stored"))), F.lit(0)).alias("rows"),
    )


def complete_sources(derived: DataFrame, sources: DataFrame, source: str = "source") -> DataFrame:
    """(source, complete): whether exactly one derived record names a source and states its row count.

    ``derived`` has source and source_rows, ``sources`` source and rows. Sources that nothing
    was derived from, or whose records repeat, aren't complete.
    """
    made = derived.groupBy(source).agg(F.count(F.lit(1)).alias("__d"), F.max("source_rows").alias("__rows"))
    own = sources.groupBy(source).agg(F.count(F.lit(1)).alias("__s"), F.max("rows").alias("rows"))
    return own.join(made, source, "left").select(source, F.coalesce((F.col("__d") == 1) & (F.col("__s") == 1) & (F.col("rows") == F.col("__rows")), F.lit(False)).alias("complete"))


def deletion_plan(files: DataFrame, complete: DataFrame, reason: str = "retention_after_complete_60s") -> DataFrame:
    """DELETION_PLANNED rows for the raw files and finer derivatives (``files``: source, ref, sha256) of complete sources."""
    done = complete.filter("complete").select("source")
    return files.join(done, "source", "left_semi").select(F.lit("DELETION_PLANNED").alias("action"), F.col("ref").alias("object_id"), F.col("sha256").alias("checksum_sha256"), F.lit(reason).alias("reason"))


def applied(plan: DataFrame, ledger: DataFrame, there: DataFrame, dry_run: bool = True) -> DataFrame:
    """Ledger rows for the planned deletions that it doesn't hold yet: deletion_id, object_id, checksum_sha256, status.

    status is DRY_RUN, DELETED, or CHECKSUM_CHANGED for files that no longer hold the planned
    bytes, which must stay. Ids derive from what is planned, so a plan applied twice adds nothing;
    the caller deletes the files whose rows say DELETED.
    """
    identified = plan.withColumn("deletion_id", F.sha2(F.to_json(F.struct("action", "checksum_sha256", F.lit(dry_run).alias("dry_run"), "object_id", "reason")), 256)).dropDuplicates(["deletion_id"])
    fresh = identified.join(ledger.select("deletion_id"), "deletion_id", "left_anti")
    now = there.select(F.col("ref").alias("object_id"), F.col("sha256").alias("__now"))
    status = F.lit("DRY_RUN") if dry_run else F.when(F.col("__now") == F.col("checksum_sha256"), "DELETED").otherwise("CHECKSUM_CHANGED")
    return fresh.join(now, "object_id", "left").select("deletion_id", "object_id", "checksum_sha256", status.alias("status"))


def holds(log: DataFrame) -> DataFrame:
    """(hold) in force from a log of (hold, seq, event): ADDED and not REMOVED since."""
    return log.groupBy("hold").agg(F.max_by("event", "seq").alias("__e")).filter("__e = 'ADDED'").select("hold")


def coverage_index(records: DataFrame) -> DataFrame:
    """(ref, coverage_end): every file a manifest names, by path and by bare name, with its latest record's end.

    ``records`` has manifest, number, object_id, raw_object_ref, artifact_ref and coverage_end;
    records without an end index nothing.
    """
    refs = F.explode(F.array_compact(F.array("object_id", "raw_object_ref", "artifact_ref"))).alias("__r")
    named = records.filter("coverage_end is not null").select("manifest", "number", "coverage_end", refs).withColumn("__r", F.regexp_replace("__r", r"\\", "/"))
    both = named.select("manifest", "number", "coverage_end", F.explode(F.array_distinct(F.array("__r", F.regexp_extract("__r", r"([^/]*)\z", 1)))).alias("ref"))
    return both.groupBy("ref").agg(F.max_by("coverage_end", F.struct("manifest", "number")).alias("coverage_end"))
