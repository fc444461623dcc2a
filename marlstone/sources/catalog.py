"""A catalog of SQL views over the Parquet files that manifests say are in force.

Manifests are append-only JSON-lines logs. Their records are resolved into active files by joins
and aggregates; files are checked against their recorded hashes; and every dataset class gets a
view, typed even when it is empty. Nothing is copied: the views read the files themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.operators import merge
from marlstone.operators.compaction import file_system, plain_path
from marlstone.sources.archives import parquet_union

# Dataset classes, their views and their older names.
VIEWS = {
    "ohlcv": "market_ohlcv", "individual_trade": "market_individual_trade", "exchange_aggregate_trade": "market_exchange_aggregate_trade", "derived_trade_bucket": "market_derived_trade_bucket",
    "funding_rate": "market_funding_rate", "open_interest": "market_open_interest", "liquidations": "market_liquidations",
}
CUMULATIVE = ("funding_rate", "open_interest", "liquidations")
OLD_NAMES = {"funding": "funding_rate", "liquidation": "liquidations", "trade_bucket": "derived_trade_bucket", "aggregate_trade": "exchange_aggregate_trade"}
#: Words in a manifest's name, a source's id or a file's path that tell the class, the first that fits.
MARKS = [
    ("trade_bucket", "derived_trade_bucket"), ("individual_trade", "individual_trade"), ("aggregate_trade|aggtrade", "exchange_aggregate_trade"), ("open_interest", "open_interest"),
    ("funding", "funding_rate"), ("liquidation", "liquidations"), ("ohlcv|klines", "ohlcv"),
]

TEXTS = (
    "action", "dataset_class", "source_dataset_id", "exchange", "market_type", "contract_type", "instrument_id", "symbol", "period", "schema_version", "collector_version", "normalization_version", "object_id",
    "parquet_sha256", "source_parquet_sha256", "superseded_object_id", "deleted_object_id",
)
LISTS = ("created_parquets", "quarantined_parquets", "superseded_object_ids", "deleted_object_ids")
LOG = T.StructType([*(T.StructField(n, T.StringType()) for n in TEXTS), *(T.StructField(n, T.ArrayType(T.StringType())) for n in LISTS)])
IDENTITY = ("source_dataset_id", "exchange", "market_type", "contract_type", "instrument_id", "symbol", "schema_version", "collector_version", "normalization_version")


def numbered_lines(spark: SparkSession, path: str, pattern: str = "*.jsonl") -> DataFrame:
    """(manifest, number, line): the lines of every log below ``path``, numbered from 1 within their file; blank ones count but are left out.

    Files may be split between tasks: a line's place is its block's start and its order within it.
    """
    raw = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("lineSep", "\n").text(path)
    placed = raw.select(F.col("_metadata.file_path").alias("manifest"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__at"), F.col("value").alias("line"))
    number = F.row_number().over(Window.partitionBy("manifest").orderBy("__block", "__at")).cast("bigint")
    return placed.select("manifest", number.alias("number"), "line").filter(F.trim("line") != "")


def log_records(spark: SparkSession, path: str) -> DataFrame:
    """The manifest records below a folder: manifest, number and the fields of ``LOG``; unreadable lines fail the read."""
    lines = numbered_lines(spark, path)
    parsed = F.from_json("line", LOG, {"mode": "FAILFAST"})
    return lines.select("manifest", "number", parsed.alias("r")).select("manifest", "number", "r.*")


def class_of(declared: Column, *clues: Column) -> Column:
    """The dataset class: the declared one under its present name, else what the clues tell, else null."""
    named = F.nullif(declared, F.lit(""))
    present = named
    for old, new in OLD_NAMES.items():
        present = F.when(named == old, new).otherwise(present)
    joined = F.lower(F.concat_ws(" ", *(F.regexp_replace(F.coalesce(c, F.lit("")), r"\\", "/") for c in clues)))
    told = F.lit(None).cast("string")
    for mark, name in reversed(MARKS):
        told = F.when(joined.rlike(mark), name).otherwise(told)
    return F.coalesce(present, told)


def active(records: DataFrame) -> DataFrame:
    """(dataset_class, relative_path, parquet_sha256, identity columns..., manifest, number) of the files in force.

    ``records`` has manifest, number and the fields of ``LOG``; later means higher (manifest,
    number). Records that publish name files; of the cumulative classes only the latest record
    of each generation counts. Files that any record supersedes or deletes, and files whose
    name was ever quarantined, are out. Of several records for a file the latest counts, those
    of cumulative classes last. Buckets whose source is not an active trade file are out.
    """
    name = F.regexp_extract("manifest", r"([^/]*)\z", 1)
    rows = records.withColumns({"dataset_class": class_of(F.col("dataset_class"), name, F.col("source_dataset_id"), F.col("object_id")), "__action": F.upper(F.coalesce("action", F.lit("")))})
    rows = rows.filter(F.col("dataset_class").isin(*VIEWS))
    none = F.array().cast("array<string>")
    lists = lambda *names: F.concat(*(F.coalesce(F.col(n), none) for n in names))
    last_part = lambda c: F.regexp_extract(F.regexp_replace(c, r"\\", "/"), r"([^/]*)\z", 1)
    quarantined = rows.filter("__action = 'QUARANTINED'").select(F.explode(lists("quarantined_parquets")).alias("f")).select(last_part(F.col("f")).alias("__name")).distinct()
    gone = lists("superseded_object_ids", "deleted_object_ids")
    gone = F.array_compact(F.concat(gone, F.array("superseded_object_id", "deleted_object_id", "object_id")))
    removed = rows.filter(F.col("__action").isin(*merge.REMOVE)).select(F.explode(gone).alias("f")).filter(F.lower("f").endswith(".parquet")).select(F.regexp_replace("f", r"\\", "/").alias("ref")).distinct()
    published = rows.filter(F.col("__action").isin(*merge.PUBLISH))
    cumulative = F.col("dataset_class").isin(*CUMULATIVE)
    generation = [name, F.col("dataset_class"), *(F.coalesce(c, F.lit("")) for c in ("source_dataset_id", "exchange", "market_type")), F.coalesce(F.nullif("symbol", F.lit("")), "instrument_id", F.lit("")), F.coalesce("period", F.lit(""))]
    fields = [c for c in published.columns if c != "__action"]
    whole = F.struct("manifest", "number", *(c for c in fields if c not in ("manifest", "number")))
    latest = published.filter(cumulative).groupBy(*(g.alias(f"__g{i}") for i, g in enumerate(generation))).agg(F.max_by(whole, F.struct("manifest", "number")).alias("r")).select("r.*")
    chosen = published.filter(~cumulative).select(*fields, F.lit(0).alias("__last")).unionByName(latest.select(*fields, F.lit(1).alias("__last")))
    hashes = F.when(F.col("parquet_sha256").startswith("["), F.from_json("parquet_sha256", "array<string>")).when(F.col("parquet_sha256") != "", F.array("parquet_sha256"))
    named = merge.references(chosen.withColumn("hashes", hashes).drop("parquet_sha256"))
    named = named.withColumnsRenamed({"sha256": "parquet_sha256"}).withColumn("ref", F.regexp_replace("ref", r"\\", "/"))
    live = named.join(removed, "ref", "left_anti").withColumn("__name", last_part(F.col("ref"))).join(quarantined, "__name", "left_anti")
    kept = [c for c in live.columns if c not in ("ref", "__last", "manifest", "number", "__name")]
    one = live.groupBy("ref").agg(F.max_by(F.struct("manifest", "number", *kept), F.struct("__last", "manifest", "number")).alias("r")).select("ref", "r.*")
    buckets = one.filter("dataset_class = 'derived_trade_bucket'")
    trades = one.filter("dataset_class = 'individual_trade' and parquet_sha256 is not null")
    sourced = merge.with_active_source(buckets.withColumn("source_parquet_sha256", F.nullif("source_parquet_sha256", F.lit(""))), trades, "source_parquet_sha256", "parquet_sha256")
    out = one.filter("dataset_class <> 'derived_trade_bucket'").unionByName(sourced)
    return out.select("dataset_class", F.col("ref").alias("relative_path"), "parquet_sha256", *IDENTITY, "manifest", "number")


def escapes(path: Column) -> Column:
    """Whether a relative path leaves its root: absolute, with a drive letter, or climbing above it."""
    plain = plain_path(path)
    parts = F.filter(F.split(plain, "/"), lambda p: (p != "") & (p != "."))
    climbed = F.aggregate(
        parts, F.struct(F.lit(0).alias("depth"), F.lit(False).alias("out")),
        lambda a, p: F.struct((a["depth"] + F.when(p == "..", -1).otherwise(1)).alias("depth"), (a["out"] | ((p == "..") & (a["depth"] < 1))).alias("out")),
    )
    return plain.startswith("/") | plain.rlike("^[A-Za-z]:") | climbed["out"]


def inventory(spark: SparkSession, path: str, pattern: str = "*", hashed: bool = True) -> DataFrame:
    """(path, bytes, modified, sha256) of every file below a folder; contents are hashed on the executors as streams, a mebibyte at a time."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    if not hashed:
        return files.withColumn("sha256", F.lit(None).cast("string"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for b in batches:
            found = []
            for name in b.column(0).to_pylist():
                fs, at = file_system(name)
                h = hashlib.sha256()
                with fs.open_input_stream(at, compression=None) as f:
                    while part := f.read(1 << 20):
                        h.update(part)
                found.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.string())], names=["path", "bytes", "modified", "sha256"])

    return files.mapInArrow(digest, "path string, bytes bigint, modified timestamp, sha256 string")


def relative(path: Column, root: str) -> Column:
    """A file's path below ``root``, whichever way its URI is written."""
    bare = root.split("://")[-1] if "://" in root else root.removeprefix("file:")
    return F.regexp_replace(F.substring_index(path, f"{bare.rstrip('/')}/", -1), "^/+", "")


def problems(files: DataFrame, there: DataFrame) -> DataFrame:
    """(relative_path, problem) of active files: ``escapes_root``, ``missing`` or ``hash_mismatch``; ``there`` has relative_path and sha256."""
    out = files.select("relative_path", F.lit("escapes_root").alias("problem")).filter(escapes(F.col("relative_path")))
    inside = files.filter(~escapes(F.col("relative_path"))).select(F.col("relative_path").alias("ref"), F.col("parquet_sha256").alias("sha256"))
    broken = merge.broken_references(inside, there.select(F.col("relative_path").alias("ref"), "sha256"))
    return out.unionByName(broken.select(F.col("ref").alias("relative_path"), "problem"))


def metadata_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """(file_path, file_sha256, file_bytes, retrieved_at, source_dataset_id, symbol) of the JSON objects below a folder; others are left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
    text = F.col("content").cast("string")
    got = lambda field: F.get_json_object(text, f"$.{field}")
    rows = files.withColumn("__v", F.expr("try_parse_json(cast(content as string))")).filter(F.schema_of_variant("__v").startswith("OBJECT"))
    return rows.select(
        F.col("path").alias("file_path"), F.sha2("content", 256).alias("file_sha256"), F.col("length").alias("file_bytes"), got("retrieved_at").alias("retrieved_at"),
        got("dataset_id").alias("source_dataset_id"), F.coalesce(F.nullif(got("native_symbol"), F.lit("")), got("symbol")).alias("symbol"),
    )


@dataclass(frozen=True)
class Catalog:
    """The active files, the frame of every dataset class, and how many metadata snapshots there are."""

    files: DataFrame
    datasets: dict[str, DataFrame]
    snapshots: DataFrame

    def counts(self) -> DataFrame:
        """(view, rows) of every dataset view, in one query."""
        spark = self.files.sparkSession
        names = spark.createDataFrame([(v,) for v in sorted(VIEWS.values())], "view string")
        counted = None
        for kind, df in self.datasets.items():
            one = df.select(F.lit(VIEWS[kind]).alias("view")).groupBy("view").agg(F.count(F.lit(1)).alias("n"))
            counted = one if counted is None else counted.unionByName(one)
        return names.join(counted, "view", "left").select("view", F.coalesce("n", F.lit(0)).cast("bigint").alias("rows"))


def build(spark: SparkSession, root: str, schemas: dict[str, T.StructType] | None = None) -> Catalog:
    """Views over the data below ``root``: the dataset views, catalog_active_artifacts and instrument_metadata_snapshots.

    Manifests lie in control/manifests, snapshots in control/instrument_metadata. An active file
    that is missing, holds other bytes or leaves the root fails the build, before any view is
    replaced. A class without files gets an empty view of its schema in ``schemas``. What the
    driver sees is the list of active files, as any reader of them needs it.
    """
    files = active(log_records(spark, f"{root}/control/manifests"))
    there = inventory(spark, root, "*.parquet").select(relative(F.col("path"), root).alias("relative_path"), "sha256")
    broken = problems(files, there).limit(5).collect()
    if broken:
        raise ValueError(f"active files are broken: {[tuple(r) for r in broken]}")
    paths: dict[str, list[str]] = {}
    for r in files.select("dataset_class", "relative_path").orderBy("relative_path").toLocalIterator():
        paths.setdefault(r["dataset_class"], []).append(f"{root}/{r['relative_path']}")
    datasets = {kind: parquet_union(spark, paths.get(kind, []), (schemas or {}).get(kind)) for kind in VIEWS}
    try:
        snapshots = metadata_snapshots(spark, f"{root}/control/instrument_metadata")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        snapshots = spark.createDataFrame([], "file_path string, file_sha256 string, file_bytes bigint, retrieved_at string, source_dataset_id string, symbol string")
    for kind, df in datasets.items():
        df.createOrReplaceTempView(VIEWS[kind])
    files.withColumn("file_path", F.concat(F.lit(f"{root}/"), "relative_path")).createOrReplaceTempView("catalog_active_artifacts")
    snapshots.createOrReplaceTempView("instrument_metadata_snapshots")
    return Catalog(files, datasets, snapshots)
