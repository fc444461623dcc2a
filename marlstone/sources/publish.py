"""Sinks: immutable generations, content-addressed raw objects, append-only event logs, and a pipeline that joins them."""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.operators import merge, quality
from marlstone.operators.compaction import file_system
from marlstone.sources.generations import GenerationTable


class Refused(ValueError):
    """What was to be published isn't what was promised, or is there already with another content."""


def archive_url(base: str, market: Column, symbol: Column, day: Column) -> Column:
    """The address of a day's trade archive: base/market/daily/trades/SYMBOL/SYMBOL-trades-DAY.zip."""
    up = F.upper(symbol)
    return F.concat_ws("/", F.lit(base.rstrip("/")), market, F.lit("daily"), F.lit("trades"), up, F.concat(up, F.lit("-trades-"), F.date_format(day, "yyyy-MM-dd"), F.lit(".zip")))


def sidecar(text: str) -> str:
    """The SHA-256 a checksum file states."""
    if not (m := re.match(r"\s*([0-9a-fA-F]{64})\b", text)):
        raise Refused("a checksum file without checksum")
    return m.group(1).lower()


def fetch(parts: Iterable[bytes], target: str, expected: str | None = None) -> str:
    """Write a download in parts to ``target`` and return its SHA-256; under its name only when it is complete and, if told, as expected."""
    fs, path = file_system(target)
    partial, digest = f"{path}.{uuid.uuid4().hex}.partial", hashlib.sha256()
    fs.create_dir(path.rpartition("/")[0])
    try:
        with fs.open_output_stream(partial, compression=None) as out:
            for part in parts:
                digest.update(part)
                out.write(part)
        found = digest.hexdigest()
        if expected is not None and found != expected.lower():
            raise Refused(f"{target} has checksum {found}, not {expected}")
        fs.move(partial, path)
    finally:
        if fs.get_file_info(partial).is_file:
            fs.delete_file(partial)
    return found


def land(content: bytes, root: str, suffix: str) -> str:
    """The path below ``root`` of a raw object named by its SHA-256; what is there is never written again."""
    name = hashlib.sha256(content).hexdigest()
    at = f"sha256={name[:2]}/{name}{suffix}"
    fs, path = file_system(f"{root.rstrip('/')}/{at}")
    if not fs.get_file_info(path).is_file:
        fetch([content], f"{root.rstrip('/')}/{at}", name)
    return at


def document(value: object, target: str) -> None:
    """A JSON document with sorted keys, replaced as a whole."""
    fetch([(json.dumps(value, sort_keys=True, indent=2, default=str) + "\n").encode()], target)


class EventLog:
    """An append-only log of events as JSON-lines files, each append one new file; read in the order of appends."""

    def __init__(self, spark: SparkSession, root: str, schema: str, identity: str):
        self.spark, self.root, self.schema, self.identity = spark, root.rstrip("/"), schema, identity

    def read(self) -> DataFrame:
        """The events with ``append``, the name of the file that holds them."""
        fs, path = file_system(self.root)
        fs.create_dir(path)
        return self.spark.read.schema(self.schema).option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).json(self.root).withColumn("append", F.regexp_extract("_metadata.file_path", r"append=([0-9a-f-]+)", 1))

    def append(self, events: DataFrame) -> int:
        """Add the events whose identity is new; how many. Equal events are there already; another event of the same identity is Refused."""
        held = self.read().drop("append")
        names = [c for c in held.columns if c != self.identity]
        one = events.select(*held.columns).distinct()
        if one.groupBy(self.identity).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count():
            raise Refused(f"two different events of one {self.identity}")
        same = None
        for c in names:
            s = F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}"))
            same = s if same is None else same & s
        met = one.alias("n").join(held.alias("o"), self.identity).filter(~same).limit(1).count()
        if met:
            raise Refused(f"another event of the same {self.identity} is in the log")
        fresh = one.join(held.select(self.identity), self.identity, "left_anti")
        target = f"{self.root}/append={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        fresh.write.option("ignoreNullFields", "false").json(target)
        return self.spark.read.schema(self.schema).json(target).count()


def write_rows(df: DataFrame, target: str, rows_a_file: int = 1_000_000, order: Sequence[str] = ()) -> int:
    """Write ``df`` as Parquet in files of bounded size, sorted within each; how many rows a reader then finds."""
    rows = df.sortWithinPartitions(*order) if order else df
    rows.write.option("compression", "zstd").option("maxRecordsPerFile", rows_a_file).parquet(target)
    return df.sparkSession.read.parquet(target).count()


@dataclass(frozen=True)
class Published:
    """What a pipeline run made of its input."""

    generation: str
    accepted: int
    quarantined: int
    added: int
    fresh: bool


def ingest(df: DataFrame, root: str, rules: Mapping[str, Column], key: Sequence[str], part: Column, log: EventLog, event: Mapping[str, str], new_wins: bool = True) -> Published:
    """Rules, quarantine, keyed merge into new generations, manifest event: a run of the pipeline, once and for all.

    Rows that break a rule go to ``root``/quarantine with the reasons. Of the rest, the partitions
    (a whole number, ``part``) they fall into are merged with what these hold and replaced. The
    event is named by the content's fingerprint; a run over the same content publishes nothing.
    """
    spark = df.sparkSession
    good, bad = quality.split(df, rules)
    rows, print_ = merge.content_fingerprint(good, good.columns).first()
    table = GenerationTable(spark, f"{root}/data", good.schema)
    name = f"{event.get('source_dataset_id', 'data')}-{print_}"
    if log.read().filter(F.col(log.identity) == name).limit(1).count():
        return Published(name, rows, 0, 0, False)
    broken = bad.withColumn("generation", F.lit(name))
    broken.write.mode("append").partitionBy("generation").parquet(f"{root}/quarantine")
    placed = good.withColumn("part", part.cast("bigint"))
    parts = [r["part"] for r in placed.select("part").distinct().collect()]  # partitions, not data
    held = table.read(parts)
    before = held.count()
    merged = merge.keyed(held.drop("part"), good, key, new_wins).withColumn("part", part.cast("bigint"))
    table.overwrite(merged, parts)
    added = max(0, table.read(parts).count() - before)
    facts = {**event, log.identity: name, "row_count": rows}
    log.append(spark.createDataFrame([tuple(str(facts[c]) if c in facts else None for c in log.read().drop("append").columns)], ", ".join(f"`{c}` string" for c in log.read().drop("append").columns)).select(*(F.col(f.name).cast(f.dataType) for f in log.read().drop("append").schema.fields)))
    return Published(name, rows, spark.read.parquet(f"{root}/quarantine").filter(F.col("generation") == name).count(), added, True)


def stale_partials(files: DataFrame, now: Column, hours: int, active: DataFrame | None = None) -> DataFrame:
    """The ``.partial`` files (path, modified) older than ``hours`` that no writer in ``active`` (path) holds."""
    old = files.filter(F.col("path").endswith(".partial") & (F.col("modified") < now - F.expr(f"interval {int(hours)} hours")))
    return old if active is None else old.join(active.select("path"), "path", "left_anti")


class Lease:
    """One writer at a time, by a file that only one can create; a stale one can be taken over."""

    def __init__(self, spark: SparkSession, path: str, owner: str, stale_seconds: float = 900, clock: Callable[[], float] = time.time):
        self.owner, self.stale, self.clock = owner, stale_seconds, clock
        self._at = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._at.getFileSystem(spark._jsc.hadoopConfiguration())
        self._text = spark._jvm.org.apache.commons.io.IOUtils

    def _holder(self) -> tuple[str, float]:
        stream = self._fs.open(self._at)
        try:
            held = json.loads(self._text.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return held["owner"], held["at"]

    def acquire(self) -> bool:
        """Whether the lease is this owner's now."""
        if self._fs.exists(self._at):
            owner, at = self._holder()
            if owner != self.owner and self.clock() - at < self.stale:
                return False
            self._fs.delete(self._at, False)
        try:
            out = self._fs.create(self._at, False)
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                return False
            raise
        out.write(bytearray(json.dumps({"owner": self.owner, "at": self.clock()}).encode()))
        out.close()
        return True

    def release(self) -> None:
        if self._fs.exists(self._at) and self._holder()[0] == self.owner:
            self._fs.delete(self._at, False)
