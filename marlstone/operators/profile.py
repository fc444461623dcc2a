"""Column profiles load by load, and a classifier two-sample test between consecutive loads.

Base aggregates are exact. For distribution changes a logistic regression learns to tell a
load from the one before it, on categorical features (missing, form, level or label, ...).
Rows are first counted per combination of features, a bounded set, and these counts are all
the models need: any number of rows of a load, however skewed, ends in a few hundred cells.
Models are trained in parallel over the executors, cross-fitted over two halves of every cell,
and refitted without each feature in turn; what discrimination is lost names the column that
changed. Pairs of loads whose cross-fitted discrimination reaches a threshold are candidates,
and exact aggregates say what the change is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.operators import multiset
from marlstone.session import keep, tasks

RIDGE, FOLDS, BLOCK = 0.5, 2, 256
#: Most steps of a model and halvings of a step, and the gain, as a part of the loss, below which a step is the last.
NEWTON_STEPS, HALVINGS, CONVERGED = 200, 40, 1e-10
#: The cross-fitted discrimination from which a pair of loads is a candidate for a shift.
CANDIDATE_AUC = 0.55
NUMBER = r"\A([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
DIGITS = r"\A[0-9]+\z"
INTEGER_OBJECT = r'\A[ \t\r\n]*\{[ \t\r\n]*("[^"\\]*"[ \t\r\n]*:[ \t\r\n]*-?(0|[1-9][0-9]*)[ \t\r\n]*(,[ \t\r\n]*"[^"\\]*"[ \t\r\n]*:[ \t\r\n]*-?(0|[1-9][0-9]*)[ \t\r\n]*)*)?\}[ \t\r\n]*\z'


def _plain(df: DataFrame, c: str) -> Column:
    """Nested values as JSON, timestamps as microseconds since 1970, all others as they are."""
    kind = df.schema[c].dataType.typeName()
    return F.to_json(c) if kind in ("array", "map", "struct") else F.unix_micros(c) if kind == "timestamp" else F.col(c)


def columns_by_load(df: DataFrame, load: str, columns: Sequence[str] | None = None, patterns: Mapping[str, str] | None = None) -> DataFrame:
    """(column_name, load, rows, nulls, distinct, lowest, highest, violations), exact.

    Ranges are found in each column's own type and given as text. violations counts the values
    whose text doesn't match the column's regular expression in ``patterns``, and is null for
    columns without one. Null loads form a load of their own; columns that are entirely null have
    distinct 0 and no range; nested values are profiled by their JSON text, timestamps by their
    microseconds since 1970; an empty table yields no rows. Distinct values are told apart by
    128 bits, so that only these, and no texts, are shuffled; all else is one aggregate a load.
    """
    names, patterns = list(columns) if columns else [c for c in df.columns if c != load], patterns or {}
    none = F.lit(None).cast("bigint")
    parts = lambda i, c: [
        F.count(c).cast("bigint").alias(f"__known{i}"), F.min(_plain(df, c)).cast("string").alias(f"__low{i}"), F.max(_plain(df, c)).cast("string").alias(f"__high{i}"),
        *([F.count_if(~_plain(df, c).cast("string").rlike(patterns[c])).cast("bigint").alias(f"__off{i}")] if c in patterns else []),
    ]
    wide = df.groupBy(F.col(load).alias("load")).agg(F.count(F.lit(1)).cast("bigint").alias("rows"), *(e for i, c in enumerate(names) for e in parts(i, c)))
    cell = lambda i, c: F.struct(
        F.lit(i).alias("i"), F.lit(c).alias("column_name"), (F.col("rows") - F.col(f"__known{i}")).alias("nulls"), F.col(f"__low{i}").alias("lowest"), F.col(f"__high{i}").alias("highest"),
        (F.col(f"__off{i}") if c in patterns else none).alias("violations"),
    )
    figures = wide.select("load", "rows", F.explode(F.array(*(cell(i, c) for i, c in enumerate(names)))).alias("c")).select("load", "rows", "c.*")
    hashed = lambda i, c: F.when(F.col(c).isNotNull(), F.struct(F.lit(i).alias("i"), F.xxhash64(_plain(df, c)).alias("a"), F.xxhash64(F.lit(c), _plain(df, c)).alias("b")))
    seen = df.select(F.col(load).alias("__l"), F.explode(F.array_compact(F.array(*(hashed(i, c) for i, c in enumerate(names))))).alias("h")).select("__l", "h.*").distinct()
    counts = seen.groupBy("__l", F.col("i").alias("__i")).agg(F.count(F.lit(1)).alias("distinct"))
    joined = figures.join(counts, (F.col("i") == F.col("__i")) & F.col("load").eqNullSafe(F.col("__l")), "left")
    return joined.select("column_name", "load", "rows", "nulls", F.coalesce("distinct", F.lit(0)).cast("bigint").alias("distinct"), "lowest", "highest", "violations")


def column_ranges(df: DataFrame, load: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, load, lowest, highest): ranges found in each column's own type, then given as text."""
    names = list(columns) if columns else [c for c in df.columns if c != load]
    ends = [f(_plain(df, c)).cast("string").alias(f"__{mark}{i}") for i, c in enumerate(names) for mark, f in (("low", F.min), ("high", F.max))]
    wide = df.groupBy(F.col(load).alias("load")).agg(*ends)
    cells = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"__low{i}").alias("lowest"), F.col(f"__high{i}").alias("highest")) for i, c in enumerate(names)))
    return wide.select("load", F.explode(cells).alias("c")).select("c.column_name", "load", "c.lowest", "c.highest")


def fits(value: Column, kind: Column, low: Column, high: Column, allowed: Column) -> Column:
    """Whether a text has the form and range of its kind (rate, seconds, count, label, counts)."""
    names = F.split(allowed, r"\|")
    within = lambda x: (x >= low) & (x <= high)
    number = value.try_cast("double")
    keys = F.regexp_extract_all(value, F.lit(r'"([^"\\]*)"[ \t\r\n]*:'), F.lit(1))
    integers = F.regexp_extract_all(value, F.lit(r":[ \t\r\n]*(-?[0-9]+)"), F.lit(1))
    return F.coalesce(
        F.when(kind.isin("rate", "seconds"), value.rlike(NUMBER) & within(number))
        .when(kind == "count", value.rlike(DIGITS) & within(number))
        .when(kind == "label", F.array_contains(names, value))
        .when(kind == "counts", value.rlike(INTEGER_OBJECT) & F.forall(keys, lambda k: F.array_contains(names, k)) & F.forall(integers, lambda i: within(i.try_cast("double")))),
        F.lit(False),
    )


def level(number: Column) -> Column:
    """Category of a number's size: half powers of two, so that no doubling stays inside one."""
    return F.when(number == 0, "0").otherwise(F.concat(F.when(number < 0, "-").otherwise(""), F.floor(F.log2(F.abs(number)) * 2).cast("string")))


def _newton(x: np.ndarray, w0: np.ndarray, w1: np.ndarray) -> np.ndarray:
    """Ridge logistic regressions, one per row of the count matrices, over shared one-hot cells.

    Each starts at the constant that fits its two loads' sizes, from which the ridge pulls back,
    and takes halved steps where a whole one doesn't help, until no step gains anything: however
    unequal the loads, no model is worse than its constant. What a step must gain grows with the
    loss, as the arithmetic's own error does. Models with an empty load stay at 0.
    """
    models, features = w0.shape[0], x.shape[1]
    n0, n1 = w0.sum(axis=1), w1.sum(axis=1)
    squares = (x[:, :, None] * x[:, None, :]).reshape(len(x), -1)
    ridge = np.full(features, RIDGE)
    ridge[0] = 1e-6
    active = np.flatnonzero((n0 > 0) & (n1 > 0))
    start = np.zeros((models, features))
    start[active, 0] = np.log(n1[active] / n0[active])
    theta = start.copy()

    def loss(t: np.ndarray, of: np.ndarray) -> np.ndarray:
        z = t @ x.T
        return (w1[of] * np.logaddexp(0, -z) + w0[of] * np.logaddexp(0, z)).sum(axis=1) + (t - start[of]) ** 2 @ ridge / 2

    for _ in range(NEWTON_STEPS):
        if not len(active):
            return theta
        t, a, b = theta[active], w0[active], w1[active]
        p = 1 / (1 + np.exp(-np.clip(t @ x.T, -30, 30)))
        slope = ((a + b) * p - b) @ x + ridge * (t - start[active])
        curve = ((a + b) * p * (1 - p)) @ squares
        step = np.linalg.solve(curve.reshape(-1, features, features) + np.diag(ridge), slope[:, :, None])[:, :, 0]
        gain = (slope * step).sum(axis=1)
        now, size = loss(t, active), np.ones(len(active))
        for _ in range(HALVINGS):
            worse = loss(t - size[:, None] * step, active) > now - 1e-4 * size * gain
            if not worse.any():
                break
            size[worse] /= 2
        size[worse] = 0
        theta[active] = t - size[:, None] * step
        active = active[(gain > CONVERGED * np.maximum(1, now)) & (size > 0)]
    return theta


def _auc(score: np.ndarray, w0: np.ndarray, w1: np.ndarray) -> np.ndarray:
    order = np.argsort(score, axis=1, kind="stable")
    take = lambda a: np.take_along_axis(a, order, axis=1)
    s, a, b = take(score), take(w0), take(w1)
    new = np.concatenate([np.ones((len(s), 1), bool), np.diff(s, axis=1) > 1e-9], axis=1)
    group = np.cumsum(new, axis=1) - 1
    out = np.full(len(s), 0.5)
    for i in range(len(s)):
        zeros, ones = np.bincount(group[i], a[i]), np.bincount(group[i], b[i])
        if zeros.sum() and ones.sum():
            out[i] = ((np.cumsum(zeros) - zeros) * ones + zeros * ones / 2).sum() / (zeros.sum() * ones.sum())
    return out


def _deviance(theta: np.ndarray, x: np.ndarray, w0: np.ndarray, w1: np.ndarray) -> np.ndarray:
    """How much better than a constant the models tell the loads apart, in nats over all rows."""
    z = theta @ x.T
    loss = (w1 * np.logaddexp(0, -z) + w0 * np.logaddexp(0, z)).sum(axis=1)
    n0, n1 = w0.sum(axis=1), w1.sum(axis=1)
    share = np.clip(n1 / np.maximum(n0 + n1, 1), 1e-12, 1 - 1e-12)
    return -(n1 * np.log(share) + n0 * np.log1p(-share)) - loss


def two_sample(cells: DataFrame, group: str, load: str, features: Sequence[str], count: str = "n") -> DataFrame:
    """Classifier test of every load against the load before it (load - 1), per group.

    ``cells`` holds counts per (group, load, features...). Returns (group, load, separation,
    auc, lost_<feature>...): separation is the in-sample gain over a constant (zero exactly if
    no feature's shares differ), auc the cross-fitted discrimination, lost_* what of it goes
    without that feature. The rows of a cell are alike, so each fold takes half of every cell,
    odd rows in turn; a fold that lacks rows of either load is scored and trained on all rows.
    Null features are a category of their own. Loads without a predecessor in their group are left
    out.
    """
    names = list(features)
    schema = f"`{group}` string, `{load}` bigint, separation double, auc double, " + ", ".join(f"`lost_{n}` double" for n in names)
    # a pair of loads belongs to the block of the later one; the first load of a block also closes the block before
    at = F.col(load)
    placed = cells.select(group, load, *(F.coalesce(F.col(n).cast("string"), F.lit("\x00")).alias(n) for n in names), count, F.explode(F.array_distinct(F.array(F.floor(at / BLOCK), F.floor((at + 1) / BLOCK)))).alias("__block"))

    def train(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        block, loads = key[1], set(pdf[load])
        later = sorted(t for t in loads if t - 1 in loads and t // BLOCK == block)
        if not later:
            return pd.DataFrame({c.split()[0].strip("`"): [] for c in schema.split(", ")}, dtype=object)  # Arrow can't make texts of numbers
        combos, cell = np.unique(pdf[names].to_numpy(str), axis=0, return_inverse=True)
        cell = cell.reshape(-1)
        parts = [np.unique(combos[:, i], return_inverse=True) for i in range(len(names))]
        hot = [np.eye(len(values))[codes.reshape(-1)] for values, codes in parts]
        place = {t: i for i, t in enumerate(sorted(loads))}
        whole_counts = np.zeros((len(place), len(combos)))
        np.add.at(whole_counts, (pdf[load].map(place).to_numpy(int), cell), pdf[count].to_numpy(float))
        odd = whole_counts % 2 == 1
        turn = np.cumsum(odd, axis=1) % 2 == 1  # the odd rows of a load go to one fold, then the other
        half = np.floor(whole_counts / 2)
        counts = np.stack([half + (odd & turn), half + (odd & ~turn)])
        bare = (counts.sum(axis=2) == 0).any(axis=0)
        counts[:, bare] = whole_counts[bare]
        now, before = [place[t] for t in later], [place[t - 1] for t in later]
        w0, w1 = counts[:, before], counts[:, now]
        one = np.ones((len(combos), 1))

        def crossed(blocks: list[np.ndarray]) -> np.ndarray:
            if not blocks:
                return np.full(len(later), 0.5)
            x = np.hstack([one, *blocks])
            return np.mean([_auc(_newton(x, w0[1 - k], w1[1 - k]) @ x.T, w0[k], w1[k]) for k in range(FOLDS)], axis=0)

        varied = [i for i in range(len(names)) if hot[i].shape[1] > 1]  # a column of one value tells nothing, nor does its loss
        x = np.hstack([one, *(hot[i] for i in varied)])
        whole = crossed([hot[i] for i in varied])
        out = {group: key[0], load: later, "separation": _deviance(_newton(x, whole_counts[before], whole_counts[now]), x, whole_counts[before], whole_counts[now]), "auc": whole}
        for i, n in enumerate(names):
            out[f"lost_{n}"] = whole - crossed([hot[j] for j in varied if j != i]) if i in varied else 0.0
        return pd.DataFrame(out)

    return placed.repartition(tasks(placed.sparkSession), group, "__block").groupBy(group, "__block").applyInPandas(lambda key, pdf: train(key, pdf), schema)


def categories(df: DataFrame, c: str) -> tuple[Column, Column]:
    """Two bounded categories of a column's values, null for null: powers of two of numbers and of texts that are numbers, the hour of times, and two of 32 hashes of all else, so that values that share one hash differ in the other."""
    kind = df.schema[c].dataType.typeName()
    none = F.lit(None).cast("string")
    if kind in ("timestamp", "timestamp_ntz"):
        return F.hour(c).cast("string"), none
    value = _plain(df, c)
    number = F.lit(None).cast("double") if kind in ("boolean", "date", "array", "map", "struct") else value.try_cast("double")
    power = F.least(F.greatest(F.floor(F.log2(F.abs(number))), F.lit(-64)), F.lit(64)).cast("string")
    size = F.when(number == 0, "0").when(number.isNotNull(), F.concat(F.when(number < 0, "-").otherwise("+"), power))
    hashed = F.xxhash64(value.cast("string"))
    one = F.concat(F.lit("#"), F.pmod(hashed, F.lit(32)).cast("string"))
    other = F.pmod(F.shiftright(hashed, 32), F.lit(32)).cast("string")
    return F.when(value.isNotNull(), F.coalesce(size, one)), F.when(value.isNotNull() & size.isNull(), other)


def drift_by_column(df: DataFrame, load: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, load, separation, auc): classifier test of every column in every load against the load before it.

    Loads are taken in their order, null ones left out. Columns are tested one by one on bounded
    categories, null being one of them, so that the work doesn't grow with distinct values;
    changes inside a category, or only in how columns go together, aren't seen.
    """
    names = list(columns) if columns else [c for c in df.columns if c != load]
    values = [F.struct(F.lit(c).alias("column_name"), one.alias("bin"), other.alias("hash")) for c in names for one, other in [categories(df, c)]]
    cells = df.filter(F.col(load).isNotNull()).select(F.col(load).alias("load"), F.explode(F.array(*values)).alias("c"))
    counts = keep(cells.groupBy("c.column_name", "load", "c.bin", "c.hash").agg(F.count(F.lit(1)).alias("n")), "bins")
    order = counts.select("load").distinct().withColumn("__no", F.row_number().over(Window.orderBy("load")).cast("bigint"))  # few rows: one a load
    tested = two_sample(counts.join(order, "load"), "column_name", "__no", ["bin", "hash"])
    return tested.join(order, "__no").select("column_name", "load", "separation", "auc")


def candidates(graded: DataFrame, group: str, load: str, threshold: float = CANDIDATE_AUC) -> tuple[DataFrame, DataFrame]:
    """Two frames (group, load): loads whose share of nulls, and whose fitting values, a classifier tells from the load before.

    One model looks at all rows and knows two columns, ``missing`` and ``size``: without size,
    its cross-fitted discrimination is that of the nulls. Another looks at the fitting rows alone.
    A share of nulls that differs by 0.25 gives an auc of 0.625, labels that differ by 0.3
    one of 0.65; sizes that don't overlap give one near 1. The threshold lies below all of them.
    """
    sized = F.when(F.col("kind") == "label", F.when(F.col("fit"), F.col("value"))).otherwise(level(F.col("number")))
    counts = graded.groupBy(group, load, F.col("value").isNull().alias("missing"), "fit", sized.alias("size")).agg(F.count(F.lit(1)).alias("n"))
    asked = F.explode(F.array_compact(F.array(F.lit("all"), F.when(F.col("fit"), F.lit("fitting"))))).alias("__of")
    cells = counts.select(group, load, "missing", "size", "n", asked).withColumn("__group", F.concat_ws("\x1f", "__of", group))
    tested = keep(two_sample(cells, "__group", load, ["missing", "size"]), "tested")
    named = tested.withColumns({"__of": F.substring_index("__group", "\x1f", 1), group: F.expr("substring(__group, locate('\x1f', __group) + 1)")})
    nulls = named.filter((F.col("__of") == "all") & (F.col("auc") - F.col("lost_size") >= threshold)).select(group, load)
    return nulls, named.filter((F.col("__of") == "fitting") & (F.col("auc") >= threshold)).select(group, load)


def shifts(graded: DataFrame, group: str, load: str, threshold: float = CANDIDATE_AUC) -> DataFrame:
    """(finding, group, load) of shifts between consecutive loads: proposed by the classifier, named by exact aggregates.

    ``graded`` needs the columns group, load, kind, value, fit (boolean) and number. null_shift:
    the share of nulls differs by 0.25 or more; level_shift: the median of fitting numbers at
    least doubles or halves; label_shift: some label's share differs by 0.3 or more. Shares are
    compared in whole numbers. A median of 0 on both sides is no shift. Of the pairs that
    :func:`candidates` doesn't propose none is a shift: a median that jumps although the two
    loads' values can hardly be told apart is chance, not a change of distribution.
    """
    nulls, values = candidates(graded, group, load, threshold)
    base = graded.groupBy(group, load).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("value").isNull().cast("bigint")).alias("nulls"),
        F.sum(F.col("fit").cast("bigint")).alias("fitting"),
    )
    medians = multiset.figures(multiset.counted(graded.filter("fit and number is not null"), [group, load], "number"), [group, load], "number", "n").select(group, load, "median")
    base = base.join(medians, [group, load], "left")
    renamed = lambda df, mark: df.select(group, *(F.col(c).alias(f"{mark}_{c}") for c in df.columns if c not in (group, load)), (F.col(load) + (1 if mark == "old" else 0)).alias(load))
    paired = renamed(base, "new").join(renamed(base, "old"), [group, load])
    null_shift = F.abs(F.col("new_nulls") * F.col("old_n") - F.col("old_nulls") * F.col("new_n")) * 4 >= F.col("old_n") * F.col("new_n")
    grown = ((F.col("new_median") >= 2 * F.col("old_median")) | (2 * F.col("new_median") <= F.col("old_median"))) & ((F.col("new_median") != 0) | (F.col("old_median") != 0))
    nulled = nulls.join(paired, [group, load]).filter(null_shift).select(F.lit("null_shift").alias("finding"), group, load)
    moved_level = values.join(paired, [group, load]).filter(grown).select(F.lit("level_shift").alias("finding"), group, load)
    labels = graded.filter("fit and kind = 'label'").groupBy(group, load, F.col("value").alias("label")).agg(F.count(F.lit(1)).alias("count"))
    fitting = base.select(group, load, F.col("fitting").alias("of")).filter("of > 0")
    ends = values.join(fitting, [group, load]).join(fitting.select(group, (F.col(load) + 1).alias(load), F.col("of").alias("old_of")), [group, load])
    sides = labels.select(group, load, "label", "count", F.lit(0).alias("old")).unionByName(labels.select(group, (F.col(load) + 1).alias(load), "label", F.lit(0).alias("count"), F.col("count").alias("old")))
    moved = sides.groupBy(group, load, "label").agg(F.sum("count").alias("now"), F.sum("old").alias("was")).join(ends, [group, load])
    label_shift = moved.filter(F.abs(F.col("now") * F.col("old_of") - F.col("was") * F.col("of")) * 10 >= 3 * F.col("of") * F.col("old_of"))
    return nulled.unionByName(moved_level).unionByName(label_shift.select(F.lit("label_shift").alias("finding"), group, load).distinct())
