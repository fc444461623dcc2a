"""Differences between two copies of a dataset, cell by cell.

Both sides become key-field-value cells with signed counts, +1 for the left side and -1 for the
right; cells or keys whose counts don't sum to zero are the differences. Equal rows meet first,
merged on the map side, so that a key that holds a third of all rows costs one row per task. Rows
that stand on both sides cancel as a whole: cells are made only for keys that have a row on one
side alone, and are summed by key, field and value, so that no key needs to fit in one task.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.session import keep

MISSING_LEFT, MISSING_RIGHT = "missing_left", "missing_right"
#: The number of the cell that stands for the key itself.
PRESENCE = -1


def _shape(df: DataFrame, key: Mapping[str, Column], fields: Mapping[str, Column], sign: int) -> DataFrame:
    return df.select(*(c.alias(n) for n, c in key.items()), *(c.alias(f"__f_{n}") for n, c in fields.items()), F.lit(sign).alias("__sign"))


def signed_cells(
    left: DataFrame,
    right: DataFrame,
    left_key: Mapping[str, Column],
    right_key: Mapping[str, Column],
    left_fields: Mapping[str, Column],
    right_fields: Mapping[str, Column],
) -> DataFrame:
    """(key..., field, value, balance) of all keys with a row on one side alone: the sum of each cell's signs, a side counting once.

    The cell with field -1 stands for the key itself. A null value is a cell like any other.
    """
    if list(left_key) != list(right_key) or list(left_fields) != list(right_fields):
        raise ValueError("both sides need the same key and field names in the same order")
    keys, names = list(left_key), list(left_fields)
    both = _shape(left, left_key, left_fields, 1).unionByName(_shape(right, right_key, right_fields, -1))
    rows = keep(both.groupBy(*keys, *(f"__f_{n}" for n in names)).agg(F.max("__sign").alias("__high"), F.min("__sign").alias("__low")), "rows")
    lone = rows.filter(F.col("__high") == F.col("__low")).select(*(F.col(k).alias(f"__k_{k}") for k in keys)).distinct()
    related = rows.join(lone, reduce(and_, (F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys)), "left_semi")
    cell = lambda i, value: F.struct(F.lit(i).alias("field"), value.cast("string").alias("value"))
    cells = F.array(cell(PRESENCE, F.lit("")), *(cell(i, F.col(f"__f_{n}")) for i, n in enumerate(names)))
    signs = F.explode(F.array_distinct(F.array("__high", "__low"))).alias("__sign")
    unpivoted = related.select(*keys, signs, cells.alias("__cells")).select(*keys, "__sign", F.explode("__cells").alias("__c")).select(*keys, "__sign", "__c.field", "__c.value")
    return unpivoted.groupBy(*keys, "field", "value").agg(F.sum_distinct("__sign").alias("balance"))


def differences(
    left: DataFrame,
    right: DataFrame,
    left_key: Mapping[str, Column],
    right_key: Mapping[str, Column],
    left_fields: Mapping[str, Column],
    right_fields: Mapping[str, Column],
    missing_left: str = MISSING_LEFT,
    missing_right: str = MISSING_RIGHT,
) -> DataFrame:
    """One row (key..., difference) per key missing on a side or per differing field.

    Fields are compared by the values the given columns yield. Null differs from any value and
    equals null. Repeated rows count once. If a side holds several values of a field for one
    key, the field differs unless each of them exists on the other side. A null in the key is a
    value like any other (null meets null). Empty sides are fine: all keys of the other side
    are then missing. Other columns of the inputs are never looked at.
    """
    keys, names = list(left_key), list(left_fields)
    cells = signed_cells(left, right, left_key, right_key, left_fields, right_fields)
    per_key = cells.filter("balance <> 0").groupBy(*keys).agg(
        F.max(F.when(F.col("field") == PRESENCE, F.col("balance"))).alias("__only"),
        *(F.max(F.when(F.col("field") == i, 1)).alias(f"__d_{n}") for i, n in enumerate(names)),
    )
    kinds = (
        F.when(F.col("__only") > 0, F.array(F.lit(missing_right)))
        .when(F.col("__only") < 0, F.array(F.lit(missing_left)))
        .otherwise(F.array_compact(F.array(*(F.when(F.col(f"__d_{n}") == 1, F.lit(n)) for n in names))))
    )
    return per_key.select(*keys, F.explode(kinds).alias("difference"))
