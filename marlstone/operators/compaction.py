"""Fewer, well-sized files from far too many small ones, without decoding a value.

A plan decides each listed file's fate from the manifest alone; the plan's bins are then
joined on the executors, each by copying encoded blocks and rewriting one footer.
"""

from __future__ import annotations

import os
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.session import tasks
from marlstone.sources import parquet_blocks

SMALL_BYTES, TARGET_BYTES, MOST_FILES = 1 << 20, 128 << 20, 4096


def plain_path(path: Column) -> Column:
    """Forward slashes, no doubled slash, no leading ``./``."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(path, r"\\", "/"), "/+", "/"), r"\A(\./)+", "")


def plan(manifest: DataFrame, small_bytes: int = SMALL_BYTES, target_bytes: int = TARGET_BYTES, most_files: int = MOST_FILES, kind: Column | None = None) -> DataFrame:
    """(relative_path, directory, dataset_class, n_rows, n_bytes, fate, kind, bin) of each listed file.

    Of a plain path the record with the highest manifest_record_number counts. fate is ``copy``
    (an earlier path, by bytes, has the same content hash), ``merge`` (small, no copy, and not
    the only such file of its directory) or ``keep``. Files of one directory share an output only
    if they agree in ``kind``, an expression over relative_path and dataset_class (by default
    the latter as it is written). ``bin`` numbers the joined files of a directory and kind: a hash
    spreads the files, so that no directory has to be sorted in one task, over as many bins as
    size and file count ask for. Null hashes equal nothing; null sizes are not small; null paths
    list no file; equal records of one path are one.
    """
    path = plain_path(F.col("relative_path"))
    fields = ("dataset_class", "parquet_sha256", "n_rows", "n_bytes")
    latest = manifest.filter("relative_path is not null").groupBy(path.alias("relative_path")).agg(F.max(F.struct("manifest_record_number", *fields)).alias("r"))
    files = latest.select("relative_path", F.regexp_replace("relative_path", r"[^/]*\z", "").alias("directory"), *(F.col(f"r.{c}").alias(c) for c in fields))
    files = files.withColumn("kind", F.coalesce(F.col("dataset_class") if kind is None else kind, F.lit("")))
    firsts = files.filter("parquet_sha256 is not null").groupBy("parquet_sha256").agg(F.min("relative_path").alias("__first"))
    files = files.join(firsts, "parquet_sha256", "left").withColumn("__copy", F.coalesce(F.col("relative_path") != F.col("__first"), F.lit(False)))
    small = ~F.col("__copy") & F.coalesce(F.col("n_bytes") < small_bytes, F.lit(False))
    files = files.withColumn("__small", small)
    kinds = files.filter("__small").groupBy("directory", "kind").agg(F.count(F.lit(1)).alias("__n"), F.sum("n_bytes").alias("__bytes"))
    homes = kinds.groupBy("directory").agg(F.sum("__n").alias("__small_files"), F.map_from_entries(F.collect_list(F.struct("kind", F.struct("__n", "__bytes")))).alias("__of"))
    of = F.try_element_at("__of", F.col("kind"))
    bins = F.greatest(F.lit(1), F.ceil(of["__bytes"] / target_bytes), F.ceil(of["__n"] / most_files))
    merged = F.col("__small") & (F.col("__small_files") > 1)
    return files.join(homes, "directory", "left").select(
        "relative_path", "directory", "dataset_class", "n_rows", "n_bytes",
        F.when(F.col("__copy"), "copy").when(merged, "merge").otherwise("keep").alias("fate"), "kind",
        F.when(merged, F.pmod(F.xxhash64("relative_path"), bins)).alias("bin"),
    )


def file_system(root: str):
    """(file system, path) of a URI; plain paths and Hadoop's ``file:/`` form are local."""
    from pyarrow import fs

    if root.startswith("file:/") and not root.startswith("file://"):
        root = root.removeprefix("file:")
    return fs.FileSystem.from_uri(root if "://" in root else f"file://{root}")


REPORT = "directory string, kind string, bin bigint, output_path string, files bigint, blocks bigint, rows bigint, bytes bigint, listed_rows bigint, members array<string>, problem string"


def execute(planned: DataFrame, source_root: str, target_root: str) -> DataFrame:
    """Join the files of every bin of the plan; every planned file is a member of exactly one report row.

    Files of a bin with different schemas end in different outputs. Output names come from what
    they hold, and a file appears under its name only when it is complete and verified (schema,
    block count, row totals, and rows against the manifest where it states them), so a task that
    runs again does no harm. Members that can't be joined are reported with their ``problem`` and
    left as they were, with no output; members of a row without problem may be retired. Roots are
    URIs that every executor reaches.
    """

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        (source, base), (target, out_base) = file_system(source_root), file_system(target_root)
        directory, number = pdf["directory"].iloc[0], int(pdf["bin"].iloc[0])
        listed = {p: None if n != n or n is None else int(n) for p, n in zip(pdf["relative_path"], pdf["n_rows"])}

        def row(paths: list[str], **more: object) -> dict:
            known = sum(listed[p] or 0 for p in paths)
            return {"directory": directory, "kind": pdf["kind"].iloc[0], "bin": number, "output_path": None, "files": len(paths), "blocks": 0, "rows": 0, "bytes": 0, "listed_rows": known, "members": paths, "problem": None} | more

        def write(paths: list[str]) -> dict:
            name = uuid.uuid5(uuid.NAMESPACE_URL, "\n".join(paths)).hex
            final, part = f"{directory}merged-{number:05d}-{name}.parquet", f"{out_base}/{directory}.{name}-{uuid.uuid4().hex}.partial"
            target.create_dir(os.path.dirname(f"{out_base}/{final}"))
            try:
                with target.open_output_stream(part) as f:
                    joined = parquet_blocks.join_files([lambda p=p: source.open_input_file(f"{base}/{p}") for p in paths], f)
                with target.open_input_file(part) as f:
                    parquet_blocks.verify(f, joined)
                if None not in (counts := [listed[p] for p in paths]) and sum(counts) != joined.rows:
                    raise parquet_blocks.BlockError(f"the manifest lists {sum(counts)} rows, the files hold {joined.rows}")
                target.move(part, f"{out_base}/{final}")
            except (OSError, parquet_blocks.BlockError) as e:
                if target.get_file_info(part).is_file:
                    target.delete_file(part)
                return row(paths, problem=f"{type(e).__name__}: {e}"[:300])
            return row(paths, output_path=final, blocks=joined.blocks, rows=joined.rows, bytes=joined.bytes)

        by_schema: dict[bytes, list[str]] = {}
        rows = []
        for path in sorted(listed):
            try:
                with source.open_input_file(f"{base}/{path}") as f:
                    by_schema.setdefault(parquet_blocks.schema_bytes(f), []).append(path)
            except (OSError, parquet_blocks.BlockError) as e:
                rows.append(row([path], problem=f"{type(e).__name__}: {e}"[:300]))
        return pd.DataFrame(rows + [write(paths) for paths in by_schema.values()])

    work = planned.filter("fate = 'merge'").select("directory", "kind", "bin", "relative_path", "n_rows")
    return work.repartition(tasks(work.sparkSession), "directory", "kind", "bin").groupBy("directory", "kind", "bin").applyInPandas(join, REPORT)


def absent(planned: DataFrame, there: DataFrame) -> DataFrame:
    """A report row with a problem for every planned file with rows, whatever its fate, whose path isn't in ``there``."""
    lost = planned.filter("n_rows > 0").join(there, "relative_path", "left_anti")
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("string")
    problem = F.concat(F.lit("missing file ("), "fate", F.lit("): "), "relative_path")
    return lost.select(
        "directory", "kind", "bin", none.alias("output_path"), F.lit(1).cast("bigint").alias("files"), *(zero.alias(c) for c in ("blocks", "rows", "bytes")), F.col("n_rows").alias("listed_rows"),
        F.array("relative_path").alias("members"), problem.alias("problem"),
    )
