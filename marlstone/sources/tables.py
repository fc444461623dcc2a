"""Readers for the engine's Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What one broadcast side may hold.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """One Parquet table (a file or a folder of part files), projected to ``columns`` if given.

    Timestamps without zone are read as UTC instants.
    """
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    naive = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df


def bounded(df: DataFrame, most_rows: int, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it proves to have at most ``most_rows`` and ``most_bytes``, else as it is.

    Bytes are those of the rows' JSON text, within a small factor of what a broadcast holds.
    """
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    rows, held = df.limit(most_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if rows <= most_rows and held <= most_bytes else df
