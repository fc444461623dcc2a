"""One consistent table from files whose schemas drift, and a record of every change.

Each file's schema is fingerprinted. Along a source's files, every new fingerprint opens a
version, and what differs from the version before becomes explicit migration steps (add,
remove, rename, cast). A record is routed by its file's version: that version's spellings are
renamed to the canonical names, fields it lacks get defaults, and values are cast to the target
types, which is what the steps from that version on amount to.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.operators import sequence

#: How many numbers of a source's files one block spans.
FILES = 10_000
FIELD_KINDS = ("integer", "decimal", "string", "boolean", "object", "array")


def _kind(schema_text: Column) -> Column:
    """The JSON type behind the schema of a variant: whole numbers stay apart from decimals."""
    whole = schema_text.rlike(r"^DECIMAL\((19|[23][0-9]),0\)$")  # beyond 64 bits
    return (
        F.when(schema_text.rlike("^(BIGINT|INT|SMALLINT|TINYINT)$") | whole, "integer")
        .when(schema_text.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "decimal")
        .when(schema_text == "STRING", "string")
        .when(schema_text == "BOOLEAN", "boolean")
        .when(schema_text.startswith("OBJECT"), "object")
        .when(schema_text.startswith("ARRAY"), "array")
    )


def file_fields(records: DataFrame, source: str, order: str, payload: str, aliases: DataFrame) -> DataFrame:
    """(source, order, canonical, names, kinds) for each field that a file names.

    A file has a field if any of its records names it, null values included; ``names`` are the
    spellings in use and ``kinds`` the JSON types of its non-null values, both sorted.
    ``aliases`` (alias, canonical_field) must be small enough for the caller to have marked it;
    other names are their own canonical names. Null, unreadable or non-object payloads name no
    field.
    """
    spark = records.sparkSession
    view = records.select(F.col(source).alias("s"), F.col(order).alias("o"), F.expr(f"try_parse_json(`{payload}`)").alias("v"))
    pairs = view.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())).filter("key is not null")
    # one row per file, spelling and kind leaves the map side
    seen = pairs.groupBy("s", "o", F.col("key").alias("alias"), _kind(F.schema_of_variant("value")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    named = seen.join(aliases.select("alias", "canonical_field"), "alias", "left").withColumn("canonical", F.coalesce("canonical_field", "alias"))
    return named.groupBy(F.col("s").alias(source), F.col("o").alias(order), "canonical").agg(
        F.array_sort(F.collect_set("alias")).alias("names"),
        F.array_sort(F.collect_set("kind")).alias("kinds"),
    )


def chain(records: DataFrame, fields: DataFrame, source: str, order: str) -> DataFrame:
    """(source, order, fingerprint, version, opened, previous): every file, with the version it belongs to.

    A file whose fingerprint differs from that of the file before opens a version (the first
    does too); ``opened`` is the order of the file that opened its version, ``previous`` that of
    the file before. Files without any field are files; null orders or sources are none. Files
    are numbered in blocks, so that a source of very many files spreads over tasks.
    """
    files = records.filter(F.col(source).isNotNull() & F.col(order).isNotNull()).select(source, order).distinct()
    spelled = F.concat_ws(":", "canonical", F.concat_ws(",", "names"), F.concat_ws(",", "kinds"))
    prints = fields.groupBy(source, order).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(spelled)), "\n"), 256).alias("fingerprint"))
    named = files.join(prints, [source, order], "left").withColumn("fingerprint", F.coalesce("fingerprint", F.sha2(F.lit(""), 256)))
    seen = sequence.with_previous(named, [source], order, {"print": F.col("fingerprint")}, block=FILES)
    opens = seen.select(source, order, "fingerprint", F.col("__previous.__order").alias("previous"), F.coalesce(F.col("__previous.print") != F.col("fingerprint"), F.lit(True)).alias("__opens"), F.floor(F.col(order) / FILES).cast("bigint").alias("__block"))
    upto = Window.partitionBy(source, "__block").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    mark = F.when(F.col("__opens"), F.col(order))
    blocks = opens.groupBy(source, "__block").agg(F.count_if("__opens").alias("__n"), F.max(mark).alias("__last"))
    before = Window.partitionBy(source).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(source, "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n"), F.max("__last").over(before).alias("__last"))
    counted = opens.withColumns({"__k": F.count_if("__opens").over(upto), "__own": F.max(mark).over(upto)}).join(carried, [source, "__block"])
    return counted.select(source, order, "fingerprint", (F.col("__k") + F.col("__n")).cast("bigint").alias("version"), F.coalesce("__own", "__last").alias("opened"), "previous")


def migrations(files: DataFrame, fields: DataFrame, source: str, order: str) -> DataFrame:
    """(source, order, version, canonical, change_kind, was, now): the steps from each version to the next, at the file that opens it.

    ``files`` is what :func:`chain` gives. change_kind is added, removed, renamed (the spellings
    differ) or type_changed (both versions have non-null values, of different JSON types). A
    source's first version has no steps.
    """
    opening = files.filter(F.col("opened") == F.col(order)).filter("previous is not null").select(source, order, "previous", "version")
    now = fields.join(opening.select(source, order), [source, order])
    was = fields.withColumnRenamed(order, "previous").join(opening.select(source, order, "previous"), [source, "previous"]).select(source, order, "canonical", F.col("names").alias("__names"), F.col("kinds").alias("__kinds"))
    both = now.join(was, [source, order, "canonical"], "full").join(opening.select(source, order, "version"), [source, order])
    kinds = F.array_compact(F.array(
        F.when(F.col("__names").isNull(), F.lit("added")),
        F.when(F.col("names").isNull(), F.lit("removed")),
        F.when(F.col("names") != F.col("__names"), F.lit("renamed")),
        F.when((F.size("kinds") > 0) & (F.size("__kinds") > 0) & (F.col("kinds") != F.col("__kinds")), F.lit("type_changed")),
    ))
    told = lambda names, types: F.concat_ws(" ", F.concat_ws("|", names), F.concat_ws("|", types))
    return both.select(source, order, "version", "canonical", F.explode(kinds).alias("change_kind"), told("__names", "__kinds").alias("was"), told("names", "kinds").alias("now"))


def rules(files: DataFrame, fields: DataFrame, source: str, order: str) -> DataFrame:
    """(source, order, version, spellings): each file with its version's map from canonical names to spellings.

    The canonical spelling itself comes first, the others in order.
    """
    first = F.concat(F.filter("names", lambda n: n == F.col("canonical")), F.filter("names", lambda n: n != F.col("canonical")))
    opening = files.filter(F.col("opened") == F.col(order)).select(source, order, "version")
    named = fields.join(opening, [source, order]).groupBy(source, "version").agg(F.map_from_entries(F.collect_list(F.struct("canonical", first.alias("names")))).alias("spellings"))
    return files.select(source, order, "version").join(named, [source, "version"], "left").select(source, order, "version", "spellings")


def _as(kind: str, text: Column) -> Column:
    """A value's text cast to its target type; what can't be cast becomes null."""
    plain = F.when(~F.lower(text).isin("null"), text)
    if kind == "time":
        millis = F.when(text.rlike(r"^-?[0-9]+$"), F.timestamp_millis(text.try_cast("bigint")))
        return F.coalesce(millis, F.try_to_timestamp(text))
    if kind == "flag":
        return F.when(F.lower(text).isin("true", "1"), True).when(F.lower(text).isin("false", "0"), False)
    if kind == "whole":
        return plain.try_cast("decimal(38,6)").try_cast("bigint")
    if kind == "number":
        return plain.try_cast("decimal(38,18)")
    return plain


def migrate(records: DataFrame, payload: str, keep: Sequence[str], routes: DataFrame, file: Sequence[str], target: Mapping[str, str], defaults: Mapping[str, str] | None = None) -> DataFrame:
    """Every record in the one target schema: ``keep`` columns, version, then ``target`` fields by kind.

    ``routes`` is what :func:`rules` gives, ``file`` the columns that name a record's file. Kinds
    are text, number, whole, flag and time. A record's value is that of the first of its version's
    spellings that has one; absent or null fields take their default, else null. Records of no
    known file are read by canonical names alone; records that can't be parsed keep their row,
    with defaults alone.
    """
    texts = F.from_json(F.col(payload), "map<string,string>")
    named = routes.select(*(F.col(c).alias(f"__k{i}") for i, c in enumerate(file)), "version", "spellings")
    same = reduce(and_, (F.col(c) == F.col(f"__k{i}") for i, c in enumerate(file)))
    routed = records.join(named, same, "left").select(*keep, "version", "spellings", texts.alias("__m"))

    def value(field: str) -> Column:
        spelled = F.filter(F.transform(F.try_element_at("spellings", F.lit(field)), lambda n: F.try_element_at("__m", n)), lambda v: v.isNotNull())
        return F.coalesce(F.try_element_at(spelled, F.lit(1)), F.try_element_at("__m", F.lit(field)), F.lit((defaults or {}).get(field)).cast("string"))

    return routed.select(*keep, "version", *(_as(kind, value(f)).alias(f) for f, kind in target.items()))
