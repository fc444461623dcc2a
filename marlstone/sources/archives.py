"""Raw files: ZIP and gzip CSV archives with their checksums, JSON lines, and Parquet files with differing columns."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.session import tasks

LINES_A_BATCH = 20_000


def zip_lines(spark: SparkSession, path: str, member: str | None = None) -> DataFrame:
    """(path, ordinal, line) of the single text member of each ZIP file; ordinals count lines from 0.

    An archive with another number of members, or whose member's name doesn't match the regular
    expression ``member``, fails the read. Executors open the files where they lie and decompress
    them as a stream, so that no archive has to fit in memory.
    """
    import re

    files = spark.read.format("binaryFile").load(path).select("path")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from marlstone.operators.compaction import file_system

        for b in batches:
            for name in b.column(0).to_pylist():
                fs, at = file_system(name)
                with fs.open_input_file(at) as f, zipfile.ZipFile(f) as z:
                    inside = z.namelist()
                    if len(inside) != 1 or (member and not re.fullmatch(member, inside[0])):
                        raise ValueError(f"{name}: unexpected members {inside[:3]}")
                    lines, first = [], 0
                    with io.TextIOWrapper(z.open(inside[0]), "utf-8", newline="") as text:
                        for line in text:
                            lines.append(line.rstrip("\r\n"))
                            if len(lines) == LINES_A_BATCH:
                                yield _lines(name, first, lines)
                                first, lines = first + len(lines), []
                    if lines:
                        yield _lines(name, first, lines)

    return files.repartition(tasks(spark)).mapInArrow(read, "path string, ordinal bigint, line string")


def _lines(name: str, first: int, lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"path": [name] * len(lines), "ordinal": list(range(first, first + len(lines))), "line": lines}, schema=pa.schema([("path", pa.string()), ("ordinal", pa.int64()), ("line", pa.string())]))


def zip_csv(spark: SparkSession, path: str, columns: Sequence[str], member: str | None = None, header: str = "optional") -> DataFrame:
    """(path, ordinal, columns... as text) of zipped CSV; a first line that starts with the first column's name is a header.

    With ``header="mandatory"`` a file whose first line isn't exactly the header fails the read.
    Fields may be quoted. Lines with another number of fields have ``_corrupt`` set and null columns.
    """
    lines = zip_lines(spark, path, member)
    if header == "mandatory":
        named = F.col("line") == ",".join(columns)
        guard = F.when((F.col("ordinal") == 0) & ~named, F.raise_error(F.concat(F.lit("no header in "), F.col("path"))))
        lines = lines.withColumn("__guard", guard).filter(F.col("__guard").isNull() & (F.col("ordinal") > 0)).drop("__guard")
    else:
        lines = lines.filter(~((F.col("ordinal") == 0) & F.lower("line").startswith(columns[0].lower())))
    schema = ", ".join([*(f"`{c}` string" for c in columns), "_corrupt string"])
    parsed = lines.filter("line <> ''").select("path", "ordinal", F.from_csv("line", schema, {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}).alias("r"))
    whole = F.col("r._corrupt").isNull()
    return parsed.select("path", "ordinal", *(F.when(whole, F.col(f"r.{c}")).alias(c) for c in columns), F.col("r._corrupt").alias("_corrupt"))


def verified(spark: SparkSession, path: str, pattern: str = "*.zip", suffix: str = ".CHECKSUM") -> DataFrame:
    """(path, sha256, expected, state) of every archive: ``ok``, ``mismatch``, or ``no_checksum`` where no sidecar file states one."""
    from marlstone.sources.catalog import inventory

    files = inventory(spark, path, pattern).select("path", "sha256")
    said = spark.read.option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", True).option("wholetext", True).schema("value string").text(path)
    stated = said.select(F.regexp_replace("_metadata.file_path", f"{suffix.replace('.', '[.]')}$", "").alias("__p"), F.lower(F.regexp_extract("value", r"^\s*([0-9a-fA-F]{64})\b", 1)).alias("expected"))
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    joined = files.join(stated.withColumn("__p", plain("__p")), plain(F.col("path")) == F.col("__p"), "left")
    state = F.when(F.coalesce("expected", F.lit("")) == "", "no_checksum").when(F.col("expected") == F.col("sha256"), "ok").otherwise("mismatch")
    return joined.select("path", "sha256", "expected", state.alias("state"))


def gzip_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Headed gzip CSV as text columns, with the file's path; the header must name the columns in order."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.options(header=True, enforceSchema=False, columnPruning=False, escape='"').schema(schema).csv(path).withColumn("path", F.col("_metadata.file_path"))


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON-lines logs under a declared schema, with path and file_modified; unreadable lines stand in ``_corrupt_record``."""
    declared = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    full = T.StructType([*declared.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(full).json(path).select("*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("file_modified"))


def parquet_union(spark: SparkSession, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Parquet files united by column name, with the file name; no paths give an empty table of ``schema``.

    Files with equal columns are read in one scan; columns a file lacks are null.
    """
    if not paths:
        return spark.createDataFrame([], T.StructType([*(schema.fields if schema else []), T.StructField("filename", T.StringType())]))
    df = spark.read.option("mergeSchema", True).parquet(*paths)
    return df.withColumn("filename", F.col("_metadata.file_path"))
