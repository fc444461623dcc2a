"""Keyed merges into new generations, manifests resolved to active files, content fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a manifest record does to the files it names.
PUBLISH, REMOVE = ("", "NORMALIZED", "INGESTED", "COMPACTED"), ("SUPERSEDED", "DELETED")


def keyed(existing: DataFrame, new: DataFrame, keys: Sequence[str], new_wins: bool = True, order: Sequence[str] = ()) -> DataFrame:
    """The union of both by key; of several rows of a key one is kept.

    With ``new_wins`` a new row replaces an old one, else the first stays. Within a side the
    highest ``order``, then the largest row, decides, so a repeated merge changes nothing. Columns
    that a side lacks are null there.
    """
    rank = {True: (0, 1), False: (1, 0)}[new_wins]
    both = existing.withColumn("__rank", F.lit(rank[0])).unionByName(new.withColumn("__rank", F.lit(rank[1])), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in keys and c != "__rank" and c not in order]
    best = both.groupBy(*keys).agg(F.max(F.struct("__rank", *order, *rest)).alias("__r"))
    return best.select(*keys, *(F.col(f"__r.{c}").alias(c) for c in [*order, *rest])).select(*[c for c in both.columns if c != "__rank"])


def content_fingerprint(df: DataFrame, columns: Sequence[str], digits: int = 12, shards: int = 256) -> DataFrame:
    """One row: rows and a fingerprint that depends on the multiset of rows alone.

    Each row is hashed; hashes are summed exactly in four parts per shard and then over shards, so
    no list of rows is ever built. An empty table has the fingerprint of zero rows.
    """
    row = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    part = lambda i: F.conv(F.substring(row, 1 + 12 * i, 12), 16, 10).cast("decimal(38,0)")
    sums = df.select(F.pmod(F.xxhash64(*columns), F.lit(shards)).alias("s"), *(part(i).alias(f"p{i}") for i in range(4))).groupBy("s").agg(F.count(F.lit(1)).alias("n"), *(F.sum(f"p{i}").alias(f"p{i}") for i in range(4)))
    total = sums.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), *(F.coalesce(F.sum(f"p{i}"), F.lit(0)).cast("string").alias(f"p{i}") for i in range(4)))
    return total.select("rows", F.substring(F.sha2(F.concat_ws("-", F.col("rows").cast("string"), "p0", "p1", "p2", "p3"), 256), 1, digits).alias("fingerprint"))


def references(manifest: DataFrame) -> DataFrame:
    """One row per file a record names: ``object_id`` if it is a Parquet file, then each of ``created_parquets``.

    Hashes come from the array ``hashes`` by position in that one list; files beyond its end have
    none. Other columns of the manifest stay.
    """
    none = F.array().cast("array<string>")
    named = F.when(F.lower("object_id").endswith(".parquet"), F.array("object_id"))
    listed = F.concat(F.coalesce(named, none), F.coalesce("created_parquets", none))
    files = F.posexplode(listed).alias("__at", "ref")
    rest = [c for c in manifest.columns if c not in ("object_id", "created_parquets", "hashes")]
    return manifest.select(*rest, "hashes", files).select(*rest, "ref", F.try_element_at("hashes", F.col("__at") + 1).alias("sha256"))


def with_active_source(derived: DataFrame, sources: DataFrame, source_hash: str, hash_column: str) -> DataFrame:
    """Derived rows that name no source, or one that is active."""
    named = derived.filter(F.col(source_hash).isNotNull()).join(sources.select(F.col(hash_column).alias(source_hash)).distinct(), source_hash, "left_semi")
    return derived.filter(F.col(source_hash).isNull()).unionByName(named.select(*derived.columns))


def broken_references(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(ref, problem): listed files that don't exist (``missing``) or hold other bytes (``hash_mismatch``).

    Unknown hashes on either side match any bytes.
    """
    there = files.select("ref", F.col("sha256").alias("__found"), F.lit(True).alias("__there"))
    problem = F.when(F.col("__there").isNull(), "missing").when(F.col("sha256").isNotNull() & F.col("__found").isNotNull() & (F.lower("sha256") != F.lower("__found")), "hash_mismatch")
    return manifest.join(there, "ref", "left").select("ref", problem.alias("problem")).filter("problem is not null")


def coverage_status(reason: Column, official_window: Column) -> Column:
    """COMPLETE, PARTIAL_TRUNCATED_BY_PAGE_LIMIT or COMPLETE_OFFICIAL_WINDOW from why paging ended."""
    return F.when(reason == "PAGE_LIMIT_REACHED", "PARTIAL_TRUNCATED_BY_PAGE_LIMIT").when(official_window, "COMPLETE_OFFICIAL_WINDOW").otherwise("COMPLETE")
