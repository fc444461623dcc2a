"""Exactly one copy of messages that were delivered at least once.

Accepted messages lie in historical partitions (ranges of the intake batches). Beside them a
stored index, bucketed by identifier, says in which partitions each identifier occurs, and in
which each group of copies lies. An incoming batch looks its identifiers up in the index; only
the partitions that hold a related row are opened, recomputed together with the incoming rows
and atomically overwritten. All others aren't read; they only get the batch's own rows added.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.operators.components import smallest_member
from marlstone.session import keep_at, remove, scratch
from marlstone.sources.generations import GenerationTable

ROWS = T.StructType([
    T.StructField("node", T.LongType()),
    T.StructField("first", T.BinaryType()),
    T.StructField("second", T.BinaryType()),
    T.StructField("winner", T.LongType()),
])
INDEX = T.StructType([T.StructField("token", T.BinaryType()), T.StructField("at", T.LongType())])
MOST_DATASETS, BUCKETS, MOST_GENERATIONS = 16, 32, 8


def plain_identifier(c: str) -> Column:
    """The identifier without the marks that don't matter: letter case and a leading ``sha256:``."""
    return F.regexp_replace(F.lower(c), r"\Asha256:", "")


def token(dataset: str, kind: str, identifier: Column) -> Column:
    """128 bits that stand for one identifier of one kind in one dataset; null stays null."""
    return F.unhex(F.md5(F.concat(F.lit(f"{dataset}\x1f{kind}\x1f"), identifier)))


def _tokens(rows: DataFrame, *more: str) -> DataFrame:
    return rows.select(*more, F.explode(F.array("first", "second")).alias("token")).filter("token is not null")


def _bucket(token: str) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("bigint")


def _group_token(winner: str) -> Column:
    """The token that all rows of one group of copies share."""
    return F.unhex(F.md5(F.concat(F.lit("\x1fwinner\x1f"), F.col(winner).cast("string"))))


def winners(rows: DataFrame) -> DataFrame:
    """``rows`` (node, first, second, winner, ...) with the lowest node of their group as winner, and grouped: whether others are in it.

    Rows are in one group if they share a token or their earlier winner, also through a chain of
    rows. A row without shared tokens is its own winner.
    """
    earlier = rows.filter("winner != node").select(F.explode(F.array("node", "winner")).alias("node"), _group_token("winner").alias("token"))
    tokens = _tokens(rows, "node").unionByName(earlier)
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("token")
    labels = smallest_member(tokens.join(shared, "token", "left_semi"), "node", "token")
    named = labels.withColumnRenamed("label", "__label")
    return rows.join(named, "node", "left").withColumns({"winner": F.coalesce("__label", "winner"), "grouped": F.col("__label").isNotNull()}).drop("__label")


class MessageStore:
    """Messages by intake partition, each with the lowest sequence number among its copies.

    Incoming rows need dataset (one of ``datasets``), seq (unique within the dataset, from 0 up
    to 2**58), segment (intake batch; null counts as batch 0) and the tokens first and second.
    Two rows are copies if they agree in a token, also through a chain of rows. A row without
    tokens is its own only copy. One writer at a time: a second one ends in a Conflict.
    """

    def __init__(self, spark: SparkSession, root: str, datasets: list[str], segments_per_part: int = 256):
        if not 0 < len(datasets) <= MOST_DATASETS:
            raise ValueError(f"a store holds 1 to {MOST_DATASETS} datasets")
        self.spark, self.root, self.datasets, self.segments = spark, root, datasets, segments_per_part
        self.table, self.index = GenerationTable(spark, f"{root}/messages", ROWS), GenerationTable(spark, f"{root}/index", INDEX)

    def _lookup(self, wanted: DataFrame) -> set[int]:
        """The partitions that hold any of the tokens: numbers of intake ranges, not data."""
        buckets = {r["b"] for r in wanted.select(_bucket("token").alias("b")).distinct().collect()} if self.index.version() else set()
        found = self.index.read(buckets).join(wanted, "token", "left_semi")
        return {r["at"] for r in found.select("at").distinct().collect()} if buckets else set()

    def _enter(self, rows: DataFrame) -> None:
        """Add (token, partition) entries; buckets in too many pieces are put together."""
        entries = rows.distinct()
        scattered = {p for p, gs in self.index.manifest().items() if len(gs) >= MOST_GENERATIONS}
        if scattered:
            entries = entries.unionByName(self.index.read(scattered).select("token", "at")).distinct()
        self.index.publish(entries.withColumn("part", _bucket("token")).repartition("part"), scattered)

    def ingest(self, incoming: DataFrame) -> None:
        """Take one batch in. Rows already stored (same dataset and seq) must not come again."""
        code = F.array_position(F.array(*map(F.lit, self.datasets)), F.col("dataset")) - 1
        arrived = f"{self.root}/incoming-{uuid.uuid4().hex}"
        incoming.select(
            (F.col("seq") * MOST_DATASETS + code).alias("node"), "first", "second",
            F.floor(F.coalesce("segment", F.lit(0)) / self.segments).cast("bigint").alias("part"),
        ).write.parquet(arrived)
        batch = self.spark.read.parquet(arrived).select("node", "first", "second", F.col("node").alias("winner"), "part")
        wanted = _tokens(batch).distinct()
        related = self._lookup(wanted)
        if related:
            # a related row may be one of a group whose other rows lie elsewhere
            met = _tokens(self.table.read(related), "winner").join(wanted, "token", "left_semi")
            related |= self._lookup(met.select(_group_token("winner").alias("token")).distinct())
        everything = self.table.read(related).unionByName(batch) if related else batch
        made = f"{self.root}/settled-{uuid.uuid4().hex}"
        settled = keep_at(winners(everything), made)
        # entries that a lost writer leaves behind name partitions needlessly, never wrongly: the index goes first
        groups = settled.filter("grouped").select(_group_token("winner").alias("token"), F.col("part").alias("at"))
        self._enter(_tokens(batch, F.col("part").alias("at")).select("token", "at").unionByName(groups))
        self.table.publish(settled, related)
        for path in (arrived, made):
            remove(self.spark, path)

    def vacuum(self) -> None:
        """Delete superseded generations of messages and index."""
        self.table.vacuum()
        self.index.vacuum()

    def rows(self) -> DataFrame:
        """Everything taken in so far: dataset, seq, winner (the seq of the kept copy)."""
        name = F.element_at(F.array(*map(F.lit, self.datasets)), (F.col("node") % MOST_DATASETS + 1).cast("int"))
        return self.table.read().select(name.alias("dataset"), F.expr(f"node div {MOST_DATASETS}").alias("seq"), F.expr(f"winner div {MOST_DATASETS}").alias("winner"))

    def surplus(self) -> DataFrame:
        """(dataset, seq) of all rows that aren't the kept copy."""
        return self.rows().filter("winner != seq").select("dataset", "seq")


def intake(spark: SparkSession, rows: DataFrame, datasets: list[str], cuts: list[int], root: str | None = None) -> MessageStore:
    """A store that took ``rows`` in as consecutive batches, split at the segment numbers ``cuts``."""
    store = MessageStore(spark, root or scratch(spark, "store"), datasets)
    segment = F.coalesce("segment", F.lit(0))
    for low, high in zip([None, *cuts], [*cuts, None]):
        batch = rows
        if low is not None:
            batch = batch.filter(segment >= low)
        if high is not None:
            batch = batch.filter(segment < high)
        store.ingest(batch)
    return store
