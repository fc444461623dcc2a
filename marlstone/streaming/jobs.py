"""Structured Streaming jobs: capture, replay dedup, windows, and figures corrected by late rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marlstone.operators import lateness
from marlstone.sources.generations import GenerationTable


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, files_a_trigger: int = 8) -> DataFrame:
    """Parquet files of a folder as a rate-limited stream; zoneless times become UTC instants."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).parquet(folder)
    naive = [f.name for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return stream.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else stream


def staged(df: DataFrame, order: str, batches: int, path: str) -> T.StructType:
    """Write ``df`` as one Parquet file per intake batch, in the order in which a stream will read them; its schema.

    The whole number ``order`` says when a row came in; its range is cut into ``batches`` parts.
    """
    spark = df.sparkSession
    low, high = df.agg(F.min(order), F.max(order)).first()
    number = F.floor((F.col(order) - (low or 0)) * batches / ((high or 0) - (low or 0) + 1))
    df.withColumn("__batch", F.coalesce(number, F.lit(0)).cast("bigint")).repartition("__batch").write.partitionBy("__batch").parquet(f"{path}.parts")
    jvm = spark._jvm
    root, target = jvm.org.apache.hadoop.fs.Path(f"{path}.parts"), jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    for n in range(batches):
        part = jvm.org.apache.hadoop.fs.Path(f"{path}.parts/__batch={n}")
        for i, f in enumerate([s.getPath() for s in fs.listStatus(part)] if fs.exists(part) else []):
            to = jvm.org.apache.hadoop.fs.Path(f"{path}/{n:05d}-{i:05d}.parquet")
            fs.rename(f, to)
            fs.setTimes(to, 1_600_000_000_000 + n * 60_000 + i, -1)
    fs.delete(root, True)
    return df.schema


def tumbling_buckets(stream: DataFrame, time: str, keys: Sequence[str], seconds: int, watermark: str) -> DataFrame:
    """Trade buckets on a stream: counts by side, open, high, low, close, volumes and their delta per bucket of event time.

    Needs price, quantity and side. Open and close follow (event time, price); a bucket is complete
    when the watermark passes its end, and what comes for it later is dropped.
    """
    at = F.struct(F.col(time), "price", "quantity")
    of = lambda s: F.coalesce(F.sum(F.when(F.col("side") == s, F.col("quantity"))), F.lit(0).cast("decimal(38,18)"))
    return stream.withWatermark(time, watermark).groupBy(F.window(time, f"{seconds} seconds"), *keys).agg(
        F.count(F.lit(1)).alias("trade_count"), F.count_if(F.col("side") == "BUY").alias("buy_count"), F.count_if(F.col("side") == "SELL").alias("sell_count"),
        F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"),
        F.sum("quantity").alias("base_volume"), (of("BUY") - of("SELL")).alias("base_delta"),
    )


def drained(made: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Run an append-mode stream over all that is there, batch by batch, and read what it wrote."""
    made.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return made.sparkSession.read.schema(made.schema).parquet(out)


def tumbling(stream: DataFrame, time: str, keys: Sequence[str], value: str, width: str, watermark: str) -> DataFrame:
    """Count, sum and extremes of ``value`` per window of event time."""
    return stream.withWatermark(time, watermark).groupBy(F.window(time, width), *keys).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.min(value).alias("lowest"), F.max(value).alias("highest"))


def sliding(stream: DataFrame, time: str, keys: Sequence[str], width: str, slide: str, watermark: str) -> DataFrame:
    """Counts per overlapping window."""
    return stream.withWatermark(time, watermark).groupBy(F.window(time, width, slide), *keys).agg(F.count(F.lit(1)).alias("n"))


def sessions(stream: DataFrame, time: str, keys: Sequence[str], gap: str, watermark: str) -> DataFrame:
    """Counts per session, a session ending after ``gap`` without a row."""
    return stream.withWatermark(time, watermark).groupBy(F.session_window(time, gap), *keys).agg(F.count(F.lit(1)).alias("n"))


def without_replays(stream: DataFrame, time: str, keys: Sequence[str], watermark: str) -> DataFrame:
    """The stream without exact replays within the watermark; the store of operators.dedup forgets none."""
    return stream.withWatermark(time, watermark).dropDuplicatesWithinWatermark(list(keys))


def capture(stream: DataFrame, raw: str, normalised: str, normalise, checkpoint: str) -> StreamingQuery:
    """Write each batch raw, then normalised; a batch that runs again replaces what it wrote before."""

    def both(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{raw}/batch={number}")
        normalise(batch.sparkSession.read.parquet(f"{raw}/batch={number}")).write.mode("overwrite").parquet(f"{normalised}/batch={number}")

    return stream.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def segments(stream: DataFrame, time: str, out: str, checkpoint: str) -> StreamingQuery:
    """Append raw messages to JSON-lines segments in folders of their day and hour of receipt; a message without time stands in none's."""
    placed = stream.withColumns({"date": F.date_format(time, "yyyy-MM-dd"), "hour": F.date_format(time, "HH")})
    sink = placed.writeStream.outputMode("append").format("json").partitionBy("date", "hour").option("ignoreNullFields", "false")
    return sink.option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class LateCorrections:
    """Period figures kept as a multiset state that every batch adjusts, in any order of arrival.

    The state lies in partitions of event-time days; a batch reads and atomically overwrites only
    the days it has rows for. Batches are applied once: the number of the last one is kept with the
    state, so a repeated batch is skipped.
    """

    DAY_US = 86_400_000_000

    def __init__(self, spark: SparkSession, root: str, keys: dict[str, str], value_type: str, period_us: int, cutoff_us: int):
        fields = ", ".join([*(f"`{k}` {t}" for k, t in keys.items()), "period_us bigint", f"value {value_type}", *(f"{c} bigint" for c in lateness.COUNTS)])
        self.keys, self.period_us, self.cutoff_us = list(keys), period_us, cutoff_us
        self.table = GenerationTable(spark, root, T._parse_datatype_string(fields))

    def apply(self, batch: DataFrame, number: int, event: str = "event_us", arrival: str = "arrival_us", value: str = "value") -> None:
        change = lateness.adjust(batch, self.keys, F.col(event), F.col(arrival), F.col(value), self.period_us, self.cutoff_us)
        day = F.floor(F.col("period_us") / self.DAY_US).cast("bigint")
        days = [r["part"] for r in change.select(day.alias("part")).distinct().collect()]  # calendar days, not data
        if number <= self.table.mark():
            return
        merged = lateness.merge(self.table.read(days).drop("part"), change, self.keys).withColumn("part", day)
        self.table.overwrite(merged, days, mark=number)

    def state(self) -> DataFrame:
        return self.table.read().drop("part")

    def run(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return stream.writeStream.foreachBatch(self.apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
