"""Which stored objects are old enough to go, by what is known of their age."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.functions.scalars import path_time


def aged(objects: DataFrame, coverage: DataFrame, modified: Column) -> DataFrame:
    """``objects`` (with ``ref``) plus aged_at and age_basis: manifest coverage by path, by file name, the path's date, or modification.

    ``coverage`` (ref, coverage_end) names files by path and by bare name (operators.audit); of
    several rows for one the latest end counts.
    """
    name = F.regexp_extract("ref", r"([^/]*)\z", 1)
    by_path = coverage.groupBy("ref").agg(F.max("coverage_end").alias("__by_path"))
    by_name = coverage.filter(~F.col("ref").contains("/")).groupBy(F.col("ref").alias("__name")).agg(F.max("coverage_end").alias("__by_name"))
    joined = objects.withColumn("__name", name).join(by_path, "ref", "left").join(by_name, "__name", "left").withColumn("__by_date", path_time(F.col("ref")))
    basis = F.when(F.col("__by_path").isNotNull(), "MANIFEST_PATH").when(F.col("__by_name").isNotNull(), "MANIFEST_NAME").when(F.col("__by_date").isNotNull(), "PATH_DATE").otherwise("MODIFIED")
    return joined.withColumns({"age_basis": basis, "aged_at": F.coalesce("__by_path", "__by_name", "__by_date", modified)}).drop("__name", "__by_path", "__by_name", "__by_date")


def candidates(objects: DataFrame, holds: DataFrame, now: Column, days: int) -> DataFrame:
    """``objects`` (ref, aged_at) with ``decision``: DELETE if strictly older than ``days``, else KEEP; HELD if a hold names them.

    A hold is an exact ref or a folder ending in ``/``. Unknown ages are kept.
    """
    exact = holds.filter(~F.col("hold").endswith("/")).select(F.col("hold").alias("ref")).distinct().withColumn("__exact", F.lit(True))
    folders = holds.filter(F.col("hold").endswith("/")).select(F.col("hold").alias("__folder")).distinct().withColumn("__in", F.lit(True))
    # every folder above an object, matched by equality
    parts = F.split("ref", "/")
    above = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.concat(F.array_join(F.slice(parts, 1, n), "/"), F.lit("/")))
    held_below = objects.select("ref", F.explode(above).alias("__folder")).join(folders, "__folder", "left_semi").select("ref").distinct().withColumn("__below", F.lit(True))
    joined = objects.join(exact, "ref", "left").join(held_below, "ref", "left")
    old = F.coalesce(F.col("aged_at") < now - F.expr(f"interval {days} days"), F.lit(False))
    decision = F.when(old & (F.col("__exact").isNotNull() | F.col("__below").isNotNull()), "HELD").when(old, "DELETE").otherwise("KEEP")
    return joined.withColumn("decision", decision).drop("__exact", "__below")
