"""The data-processing operators on small hard inputs: nulls, ties, copies, empty tables, extra columns."""

import io
import json
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marlstone.operators import compaction, components, dedup, diff, drift, grid, lateness, multiset, profile
from marlstone.session import scratch
from marlstone.sources import parquet_blocks
from marlstone.sources.generations import GenerationTable
from pyspark.sql import types as T


# Block-wise compaction --------------------------------------------------------------------


def _file(table, **options):
    out = io.BytesIO()
    pq.write_table(table, out, **options)
    return out.getvalue()


def _join(*files):
    out = io.BytesIO()
    joined = parquet_blocks.join_files([lambda f=f: io.BytesIO(f) for f in files], out)
    out.seek(0)
    parquet_blocks.verify(out, joined)
    return joined, pq.read_table(io.BytesIO(out.getvalue()))


def _sample(n, seed):
    r = random.Random(seed)
    return pa.table({
        "a": pa.array([r.choice([None, "x", "yy", "z" * 300]) for _ in range(n)], pa.string()),
        "b": pa.array([r.choice([None, r.randrange(10**12)]) for _ in range(n)], pa.int64()),
        "l": pa.array([r.choice([None, [], ["p", None]]) for _ in range(n)], pa.list_(pa.string())),
        "t": pa.array([r.randrange(10**15) for _ in range(n)], pa.timestamp("us", "UTC")),
        "f": pa.array([r.random() < 0.5 for _ in range(n)], pa.bool_()),
    })


@pytest.mark.parametrize("options", [{}, {"compression": "zstd", "use_dictionary": False}, {"compression": "none", "write_page_index": True}, {"row_group_size": 7, "data_page_version": "2.0"}])
def test_joined_files_hold_the_same_rows(options):
    tables = [_sample(n, n) for n in (1, 40, 0, 23)]
    joined, read = _join(*(_file(t, **options) for t in tables))
    assert read.equals(pa.concat_tables(tables))
    assert joined.rows == 64 and joined.files == 4


def test_more_blocks_than_a_short_list_header_holds():
    tables = [_sample(3, n) for n in range(40)]
    joined, read = _join(*(_file(t) for t in tables))
    assert joined.blocks == 40 and read.equals(pa.concat_tables(tables))


def test_different_schemas_and_broken_files_are_refused():
    with pytest.raises(parquet_blocks.BlockError, match="schemas differ"):
        _join(_file(pa.table({"a": [1]})), _file(pa.table({"a": ["1"]})))
    with pytest.raises(parquet_blocks.BlockError):
        _join(b"nothing of the kind")
    with pytest.raises(parquet_blocks.BlockError):
        _join()


MANIFEST = "relative_path string, manifest_record_number bigint, dataset_class string, parquet_sha256 string, n_rows bigint, n_bytes bigint, bin int"


def test_plan(spark, rows):
    big = 1 << 20
    manifest = spark.createDataFrame([
        ("./d//a", 1, "x", "h1", 1, 10, 0), ("d\\a", 5, None, "h2", 2, 20, 0),  # one path, the later record counts
        ("d/b", 2, "x", "h3", 1, 10, 0), ("d/c", 3, "x", "h3", 1, 10, 0),  # one content, c is the copy
        ("d/e", 4, "x", None, 1, big, 0), ("e/only", 6, "x", None, 1, 5, 0), ("f/n", 7, "x", None, None, None, 0), (None, 8, "x", "h2", 1, 1, 0),
        ("d/b", 2, "x", "h3", 1, 10, 0), ("top", 9, "x", "h9", 1, 1, 0), ("top2", 10, "x", "h10", 1, 1, 0),
    ], MANIFEST)
    fates = {p: f for p, f in rows(compaction.plan(manifest).select("relative_path", "fate"))}
    assert fates == {"d/a": "merge", "d/b": "merge", "d/c": "copy", "d/e": "keep", "e/only": "keep", "f/n": "keep", "top": "merge", "top2": "merge"}
    assert compaction.plan(manifest.limit(0)).count() == 0


def test_execute_copies_blocks_and_reports_what_it_cannot_join(spark, tmp_path):
    inside, out = tmp_path / "in", tmp_path / "out"
    made = []
    for d in ("x", "y", "z"):
        (inside / d).mkdir(parents=True)
        for i in range(5):
            t = _sample(i, i) if d != "y" or i else pa.table({"other": [1, 2]})
            pq.write_table(t, inside / d / f"{i}.parquet")
            made.append((f"{d}/{i}.parquet", i + 1, "c", f"{d}{i}", 999 if d == "z" and i == 3 else t.num_rows, 100, 0))
    plan = compaction.plan(spark.createDataFrame(made, MANIFEST))
    report = compaction.execute(plan, f"file://{inside}", f"file://{out}").collect()
    ok = [r for r in report if r["problem"] is None]
    assert sorted((r["directory"], r["files"], r["rows"]) for r in ok) == [("x/", 5, 10), ("y/", 1, 2), ("y/", 4, 10)]
    assert [(r["directory"], "1006 rows" in r["problem"]) for r in report if r["problem"]] == [("z/", True)]
    assert sorted(m for r in report for m in r["members"]) == sorted(m[0] for m in made)  # every file in exactly one row
    assert not list(out.rglob("*.partial")) and not list((out / "z").glob("merged*"))
    read = pa.concat_tables(pq.read_table(out / r["output_path"]) for r in ok if r["directory"] == "x/")
    assert read.equals(pa.concat_tables(_sample(i, i) for i in range(5)))
    assert spark.read.parquet(*(f"file://{out}/{r['output_path']}" for r in ok if r["directory"] == "x/")).count() == 10


def test_a_bad_schema_group_leaves_the_others_of_its_bin_alone(spark, tmp_path):
    inside, out = tmp_path / "in" / "d", tmp_path / "out"
    inside.mkdir(parents=True)
    for name, t in (("a", pa.table({"n": [1]})), ("b", pa.table({"n": [2, 3]})), ("c", pa.table({"s": ["x"]})), ("e", pa.table({"n": [4]}))):
        pq.write_table(t, inside / name)
    (inside / "f").write_bytes(b"not a file of this kind")
    made = [("d/a", 1, "c", "1", 1, 9, 0), ("d/b", 2, "c", "2", 2, 9, 0), ("d/c", 3, "c", "3", 7, 9, 0), ("d/e", 4, "other", "4", None, 9, 0), ("d/f", 5, "c", "5", 1, 9, 0)]
    report = compaction.execute(compaction.plan(spark.createDataFrame(made, MANIFEST)), f"file://{tmp_path / 'in'}", f"file://{out}").collect()
    got = {tuple(r["members"]): (r["rows"], r["problem"] is None) for r in report}
    assert got == {("d/a", "d/b"): (3, True), ("d/c",): (0, False), ("d/e",): (1, True), ("d/f",): (0, False)}
    assert len(list((out / "d").iterdir())) == 2


def test_compaction_holds_files_against_the_manifest_and_reports_lost_ones(spark, tmp_path, monkeypatch):
    from marlstone.plans import data_queries

    ref = lambda i: f"normalized/individual_trade/{i}.parquet"
    trades = spark.createDataFrame([(ref(i), k) for i in range(4) for k in range(2)] + [(f"x/individual_trade/{i}", 0) for i in range(2)], "raw_object_ref string, source_ordinal bigint")
    made = [(ref(i), i, "c", f"h{i}", 0 if i == 5 else 2, 10, 0) for i in range(6)] + [(f"x/individual_trade/{i}", 10 + i, "c", f"x{i}", 7, 10, 0) for i in range(2)] + [("other/1", 20, "ohlcv", "o", 9, 10, 0)]
    tables = {"archive_trade": trades, "active_artifact": spark.createDataFrame(made, MANIFEST)}
    monkeypatch.setattr(data_queries, "table", lambda spark, folder, name, *columns: tables[name])
    report = data_queries._compacted(spark, "", scratch(spark, "files")).collect()
    assert [(r["files"], r["rows"], r["listed_rows"]) for r in report if r["problem"] is None] == [(4, 8, 8)]
    assert sorted((r["listed_rows"], "14 rows" in r["problem"], r["problem"].endswith(ref(4))) for r in report if r["problem"]) == [(2, False, True), (14, True, False)]


# Copies of messages -----------------------------------------------------------------------


def _components(edges):
    parent = {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    first = {}
    for node, token in edges:
        parent.setdefault(node, node)
        if token in first:
            a, b = find(first[token]), find(node)
            parent[max(a, b)] = min(a, b)
        else:
            first[token] = node
    return {n: find(n) for n in parent}


def test_components_of_chains_stars_and_noise(spark):
    chain = [(n, f"c{k}") for n in range(100, 140) for k in (n, n + 1)]
    star = [(n, "hot") for n in range(300)] + [(n, f"own{n}") for n in range(300)]
    r = random.Random(1)
    noise = [(r.randrange(400, 600), f"t{r.randrange(250)}") for _ in range(300)]
    edges = chain + star + noise
    found = components.smallest_member(spark.createDataFrame([*edges, (999, None), (None, "hot")], "node bigint, token string"), "node", "token")
    assert {n: lab for n, lab in found.collect()} == _components(edges)


IDS = "dataset string, seq bigint, segment bigint, a string, b string, part string, winner string"


def _tokens(df):
    return df.select("dataset", "seq", "segment", dedup.token("d", "a", dedup.plain_identifier("a")).alias("first"), dedup.token("d", "b", dedup.plain_identifier("b")).alias("second"))


def test_message_store_keeps_one_copy_through_chains_and_batches(spark, rows):
    data = [
        ("d", 1, 0, "A", "x", "", ""), ("d", 2, 0, "sha256:a", None, "", ""), ("d", 3, 300, None, None, "", ""), ("d", 4, 600, "b", "X", "", ""),
        ("d", 5, 900, "B", "y", "", ""), ("d", 6, 900, "c", "z", "", ""), ("d", 7, None, "q", "Y", "", ""), ("d", 8, 901, "a", "a", "", ""), ("d", 9, 901, "SHA256:C", None, "", ""),
    ]
    df = _tokens(spark.createDataFrame(data, IDS))
    want = [("d", s) for s in (2, 4, 5, 7, 8, 9)]
    assert rows(dedup.intake(spark, df, ["d"], []).surplus()) == want
    assert rows(dedup.intake(spark, df, ["d"], [300, 700, 901]).surplus()) == want
    assert rows(dedup.intake(spark, df.limit(0), ["d"], [5]).surplus()) == []


def test_later_links_reach_back_and_leave_other_partitions_alone(spark, rows):
    store = dedup.MessageStore(spark, scratch(spark, "t"), ["d"], segments_per_part=1)
    make = lambda data: _tokens(spark.createDataFrame([(*d, "", "") for d in data], IDS))
    store.ingest(make([("d", 10, 0, "a", None), ("d", 11, 1, "b", None), ("d", 12, 2, "b", "k"), ("d", 13, 3, "lonely", None)]))
    before = store.table.manifest()
    store.ingest(make([("d", 14, 4, "a", "k")]))  # joins what stood apart
    assert rows(store.surplus()) == [("d", 11), ("d", 12), ("d", 14)]
    after = store.table.manifest()
    assert after[3] == before[3] and all(after[p] != before[p] for p in (0, 1, 2))


def test_unrelated_partitions_are_never_opened(spark, rows):
    import shutil

    store = dedup.MessageStore(spark, scratch(spark, "t"), ["d"], segments_per_part=1)
    make = lambda data: _tokens(spark.createDataFrame([(*d, "", "") for d in data], IDS))
    store.ingest(make([("d", 20 + i, i, f"a{i}", f"b{i}") for i in range(6)]))
    folders = {p: f"{store.table.root}/{gs[0]}/part={p}".removeprefix("file://") for p, gs in store.table.manifest().items()}
    for p in (0, 1, 4, 5):
        shutil.move(folders[p], f"{folders[p]}.away".replace("part=", "away-"))
    store.ingest(make([("d", 40, 5, "a2", None), ("d", 41, 9, "new", "b3")]))
    for p in (0, 1, 4, 5):
        shutil.move(f"{folders[p]}.away".replace("part=", "away-"), folders[p])
    assert rows(store.surplus()) == [("d", 40), ("d", 41)] and len(store.table.manifest()[5]) == 2  # a row was added beside the unread ones
    store.vacuum()
    assert rows(store.surplus()) == [("d", 40), ("d", 41)] and store.table.vacuum() == 0


def test_scattered_index_buckets_are_put_together(spark, rows, monkeypatch):
    monkeypatch.setattr(dedup, "MOST_GENERATIONS", 2)
    monkeypatch.setattr(dedup, "BUCKETS", 2)
    store = dedup.MessageStore(spark, scratch(spark, "t"), ["d"], segments_per_part=1)
    for i in range(5):
        store.ingest(_tokens(spark.createDataFrame([("d", i, i, f"a{i // 2}", f"c{i}", "", "")], IDS)))
    assert rows(store.surplus()) == [("d", 1), ("d", 3)] and all(len(gs) <= 2 for gs in store.index.manifest().values())


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d", None]), st.sampled_from(["x", "y", "z", None]), st.integers(0, 5)), max_size=25), st.integers(0, 5))
def test_message_store_equals_union_find(spark, data, cut):
    df = spark.createDataFrame([("d", i, s, a, b, "", "") for i, (a, b, s) in enumerate(data)], IDS)
    edges = [(i, (k, v)) for i, (a, b, _) in enumerate(data) for k, v in (("a", a), ("b", b)) if v]
    want = {n for n, lab in _components(edges).items() if n != lab}
    assert {r["seq"] for r in dedup.intake(spark, _tokens(df), ["d"], [cut]).surplus().collect()} == want


def test_generation_table_switches_all_or_nothing(spark, rows):
    t = GenerationTable(spark, scratch(spark, "g"), T.StructType([T.StructField("v", T.StringType())]))
    make = lambda *x: spark.createDataFrame(x, "v string, part bigint")
    assert rows(t.read()) == [] and t.mark() == -1
    t.overwrite(make(("a", 1), ("b", 2)), [1, 2], mark=7)
    held = t.read()
    t.overwrite(make(("c", 2)), [2, 3])
    assert rows(t.read()) == [("a", 1), ("c", 2)] and rows(held) == [("a", 1), ("b", 2)] and t.mark() == 7
    t.publish(make(("d", 2), ("e", 5)))
    assert rows(t.read()) == [("a", 1), ("c", 2), ("d", 2), ("e", 5)] and t.version() == 3
    t.overwrite(make(("c", 2)), [2, 5])
    t.overwrite(make(("x", 9)).limit(0), [1])
    assert rows(t.read([1, 2])) == [("c", 2)]


def test_two_writers_of_one_table(spark, rows, monkeypatch):
    from marlstone.sources import generations

    root, schema = scratch(spark, "g"), T.StructType([T.StructField("v", T.StringType())])
    one, two = GenerationTable(spark, root, schema), GenerationTable(spark, root, schema)
    make = lambda *x: spark.createDataFrame(x, "v string, part bigint")
    one.overwrite(make(("a", 1), ("b", 2)), [1, 2])
    commit, raced = one._commit, []

    def race(number, content):
        if not raced:
            raced.append(1)
            two.publish(make(("other", raced_part)), [raced_part])
        return commit(number, content)

    monkeypatch.setattr(one, "_commit", race)
    raced_part = 2
    one.overwrite(make(("c", 1)), [1])  # another partition: both changes stand
    assert rows(two.read()) == [("c", 1), ("other", 2)]
    raced.clear()
    raced_part = 1
    with pytest.raises(generations.Conflict):
        one.overwrite(make(("d", 1)), [1])
    assert rows(one.read()) == [("other", 1), ("other", 2)]
    assert one.vacuum() == 2 and rows(one.read()) == [("other", 1), ("other", 2)]



def test_scratch_folders_go_when_asked(spark, tmp_path, monkeypatch):
    from marlstone import session

    monkeypatch.setattr(session, "_made", [])
    held = session.keep(spark.range(3), "held")
    folder = session._made[0].removeprefix("file://")
    assert held.count() == 3 and session.clean(spark) == 1 and session.clean(spark) == 0
    import os

    assert not os.path.exists(folder)


# Late records and multisets ---------------------------------------------------------------


def test_late_records_correct_or_drop(spark, rows):
    minute = 60_000_000
    data = [
        ("i", 1 * minute, 2 * minute, 5), ("i", 2 * minute, 5 * minute, 7),  # at the very end: on time
        ("i", 3 * minute, 5 * minute + 1, 9), ("i", 4 * minute, 35 * minute, None), ("i", 4 * minute, 35 * minute + 1, 100),
        ("j", None, 1, 1), ("j", 1, None, 1), (None, -1, minute, 3),
    ]
    df = spark.createDataFrame(data, "k string, e bigint, a bigint, v int")
    state = lateness.adjust(df, ["k"], F.col("e"), F.col("a"), F.col("v"), 5 * minute, 30 * minute)
    assert rows(lateness.outcomes(state, ["k"])) == [("i", 0, "corrected"), ("i", 0, "dropped"), (None, -5 * minute, "corrected")]
    got = {(r["k"], r["period_us"]): r for r in lateness.corrected(state, ["k"]).collect()}
    r = got["i", 0]
    assert (r["first_n"], r["first_median"], r["final_n"], r["final_distinct"], r["final_median"], r["final_max"]) == (2, 6.0, 4, 3, 7.0, 9.0)
    assert got[None, -5 * minute]["first_n"] is None
    halves = df.filter("v is null or v > 6"), df.filter("v <= 6")
    one, two = (lateness.adjust(h, ["k"], F.col("e"), F.col("a"), F.col("v"), 5 * minute, 30 * minute) for h in halves)
    assert rows(lateness.merge(two, one, ["k"])) == rows(state) and state.filter("k = 'none'").count() == 0


def test_figures_equal_plain_aggregates(spark):
    r = random.Random(3)
    data = [(r.choice("ab"), r.choice([None, *range(6)])) for _ in range(200)] + [("n", None)]
    df = spark.createDataFrame(data, "k string, v int")
    got = {x["k"]: x for x in multiset.figures(multiset.counted(df, ["k"], "v"), ["k"], "v", "n").collect()}
    for x in df.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("v").alias("d"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.median("v").alias("m")).collect():
        y = got[x["k"]]
        assert (y["n"], y["distinct"], y["min"], y["max"], y["median"]) == (x["n"], x["d"], x["lo"], x["hi"], x["m"])


# Differences ------------------------------------------------------------------------------


def test_differences(spark, rows):
    left = spark.createDataFrame([(1, "a", 1), (1, "a", 1), (2, "b", 2), (3, None, 3), (4, "d", 4), (5, "e", 5), (5, "E", 5), (7, None, 7), (8, "h", 8), (9, None, None), (None, "n", 0)], "k int, v string, w int")
    right = spark.createDataFrame([(1, "a", 1), (2, "B", 9), (3, None, 3), (5, "e", 5), (6, "f", 6), (6, "f", 6), (7, "g", 7), (8, None, 8), (9, None, None), (None, "n", 0)], "k int, v string, w int").withColumn("field", F.lit(1)).withColumn("__left", F.lit(2))
    key, fields = {"k": F.col("k")}, {"v": F.col("v"), "w": F.col("w")}
    run = lambda a, b: rows(diff.differences(a, b, key, key, fields, fields, "no_left", "no_right"))
    assert run(left, right) == sorted([(2, "v"), (2, "w"), (4, "no_right"), (5, "v"), (6, "no_left"), (7, "v"), (8, "v")], key=repr)  # null equals null alone
    assert run(left.limit(0), right.limit(0)) == []
    assert run(left.limit(0), right.filter("k = 1")) == [(1, "no_left")]


# Regular grids ----------------------------------------------------------------------------


def test_grid_fills_across_blocks_and_marks_long_gaps(spark, rows):
    data = [("a", 0, 1.0), ("a", 1, 2.0), ("a", 7, 14.0), ("a", 7, 12.0), ("a", 30, None), ("b", 5, 1.0), ("c", None, 1.0), (None, 3, 1.0)]
    df = spark.createDataFrame(data, "s string, t bigint, v double")
    for block in (1, 3, 1000):
        got = {(r["s"], r["slot_us"]): (r["status"], r["v"]) for r in grid.regular(df, "s", F.col("t"), 1, ["v"], gap_limit_us=10, block_steps=block).collect()}
        assert len(got) == 32 and got["a", 4] == ("filled", 2.0 + 12.0 * 3 / 6) and got["a", 7] == ("observed", 14.0)
        assert got["a", 20] == ("missing", None) and got["a", 30] == ("observed", None) and got["b", 5] == ("observed", 1.0)
    assert rows(grid.uncovered(df, "s", F.col("t"), 10)) == [("a", 10), ("a", 20)]
    assert grid.regular(df.limit(0), "s", F.col("t"), 1, ["v"]).count() == 0


def test_grid_values_lie_on_the_line_between_real_reading_times(spark):
    data = [("a", t, float(t)) for t in (0, 50, 260, 305, 900, 905)] + [("b", 30, 30.0), ("b", 59, 59.0), ("b", 59, 1.0), ("b", 130, 130.0)]
    df = spark.createDataFrame(data, "s string, t bigint, v double")
    for block in (1, 2, 50):
        got = {(r["s"], r["slot_us"]): (r["status"], r["v"] and round(r["v"], 9)) for r in grid.regular(df, "s", F.col("t"), 60, ["v"], gap_limit_us=210, block_steps=block).collect()}
        assert got == {
            ("a", 0): ("observed", 0.0), ("a", 60): ("filled", 60.0), ("a", 120): ("filled", 120.0), ("a", 180): ("filled", 180.0), ("a", 240): ("observed", 240.0), ("a", 300): ("observed", 300.0),
            **{("a", t): ("missing", None) for t in range(360, 900, 60)}, ("a", 900): ("observed", 900.0), ("b", 0): ("observed", 30.0), ("b", 60): ("filled", 60.0), ("b", 120): ("observed", 120.0),
        }, (block, got)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-40, 200)), min_size=1, max_size=20), st.integers(1, 9))
def test_uncovered_equals_brute_force(spark, data, block):
    df = spark.createDataFrame(data, "s string, t bigint")
    got = grid.regular(df, "s", F.col("t"), 10, block_steps=block).filter("status <> 'observed'").select("s", "slot_us").collect()
    want = set()
    for s in {d[0] for d in data}:
        slots = {t // 10 * 10 for k, t in data if k == s}
        want |= {(s, t) for t in range(min(slots), max(slots), 10) if t not in slots}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


# Profiles ---------------------------------------------------------------------------------


def test_column_profile(spark):
    df = spark.createDataFrame([(1, "x", [1], None), (1, None, [1], None), (None, "y", None, None)], "load int, c string, l array<int>, n int")
    got = {(r["column_name"], r["load"]): tuple(r)[2:] for r in profile.columns_by_load(df, "load").collect()}
    assert got["c", 1] == (2, 1, 1, "x", "x", None) and got["l", 1] == (2, 0, 1, "[1]", "[1]", None) and got["n", None] == (1, 1, 0, None, None, None)
    shaped = {(r["column_name"], r["load"]): r["violations"] for r in profile.columns_by_load(df, "load", patterns={"c": r"\Ax\z"}).collect()}
    assert (shaped["c", 1], shaped["c", None], shaped["n", 1]) == (0, 1, None) and profile.columns_by_load(df.limit(0), "load").count() == 0


def test_ranges_are_those_of_the_columns_type(spark):
    df = spark.createDataFrame([(1, 9_998, "9"), (1, 10_001, "10"), (1, 502, None), (None, 7, "b")], "load int, n bigint, c string").withColumn("d", F.col("n").cast("decimal(38,2)"))
    got = {(r["column_name"], r["load"]): (r["lowest"], r["highest"]) for r in profile.columns_by_load(df, "load").collect()}
    assert got["n", 1] == ("502", "10001") and got["d", 1] == ("502.00", "10001.00") and got["c", 1] == ("10", "9") and got["n", None] == ("7", "7") and len(got) == 6


def test_every_column_of_every_large_table_is_tested_for_drift(spark, monkeypatch):
    from marlstone.plans import data_queries

    assert {"dq_metric_result", "archive_trade", "ws_trade", "ws_envelope", "liquidation", "ohlcv_candle", "active_artifact"} == set(data_queries.LOADS)
    assert {"p4_column_drift", "p4_table_profile"} <= set(data_queries.QUERIES)
    data = [(load, "bybit" if load == 7 and i % 2 else "binance", None if load == 9 and i % 2 else "r", i, [i % 3], None) for load in (3, 7, 9) for i in range(200)]
    df = spark.createDataFrame(data, "load int, exchange string, reason string, size int, flags array<int>, none string")
    got = {(r["column_name"], r["load"]): r["separation"] for r in profile.drift_by_column(df, "load").collect()}
    assert len(got) == 10 and {k for k, v in got.items() if v > 1} == {("exchange", 7), ("exchange", 9), ("reason", 9)}, got


@pytest.mark.parametrize("kind, good, bad", [
    ("rate", ["0", "0.5", "1e-3", ".5", "1"], ["-0", "+0.5", " 0.5", "0.5\n", "1.1", "0,5", "5%", "NaN", "", "0.0.1", "Infinity"]),
    ("count", ["0", "12"], ["-1", "1.0", "0x1F", "1e2", "", "99999999"]),
    ("label", ["UP", "DOWN"], ["up", "UP ", "", "SIDE"]),
    ("counts", ["{}", '{"UP":1}', ' { "UP": 0 , "DOWN": 5 } '], ['{"UP":1.5}', '{"UP":"1"}', "{'UP':1}", '{"UP":1', '["UP",1]', '{"X":1}', '{"UP":-1}', '{"UP":01}', '{"UP"=1}', ""]),
])
def test_value_forms(spark, kind, good, bad):
    df = spark.createDataFrame([(v,) for v in good + bad], "v string")
    top = 1.0 if kind == "rate" else 1000.0
    fit = profile.fits(F.col("v"), F.lit(kind), F.lit(0.0), F.lit(top), F.lit("UP|DOWN"))
    assert [r[0] for r in df.select(fit).collect()] == [True] * len(good) + [False] * len(bad)


def test_classifier_names_the_changed_column_and_shifts_are_exact(spark):
    r = random.Random(5)
    data = []
    for load in range(4):
        for _ in range(200):
            null = r.random() < (0.5 if load == 2 else 0.05)
            number = r.uniform(1, 2) * (3 if load == 3 else 1)
            data.append(("m", load, None if null else str(number), not null, None if null else number, r.choice("xyz"), len(data)))
    graded = spark.createDataFrame(data, "metric string, load bigint, value string, fit boolean, number double, other string, id bigint").withColumn("kind", F.lit("rate"))
    cells = graded.groupBy("metric", "load", F.col("value").isNull().alias("missing"), profile.level(F.col("number")).alias("size"), "other").agg(F.count(F.lit(1)).alias("n"))
    tested = profile.two_sample(cells, "metric", "load", ["missing", "size", "other"])
    got = {x["load"]: x for x in tested.collect()}
    assert set(got) == {1, 2, 3} and abs(got[1]["auc"] - 0.5) < 0.08 and got[3]["auc"] > 0.9 and got[2]["auc"] > 0.65
    assert got[3]["lost_size"] > 0.2 > abs(got[3]["lost_other"]) and all(x["separation"] >= 0 for x in got.values())
    found = {tuple(x) for x in profile.shifts(graded, "metric", "load").collect()}
    assert found == {("null_shift", "m", 2), ("null_shift", "m", 3), ("level_shift", "m", 3)}
    assert profile.two_sample(cells.limit(0), "metric", "load", ["missing"]).count() == 0


def test_two_sample_equals_plain_gradient_descent(spark):
    import numpy as np

    counts = {"x": {("a", "u"): (8, 2), ("a", "v"): (2, 2), ("b", "u"): (4, 12), ("b", "v"): (6, 4), (None, "v"): (0, 6)}, "flat": {("a", "u"): (4, 4), ("b", "u"): (6, 6)}}
    data = [(g, load, a, b, n[load]) for g, cells in counts.items() for (a, b), n in cells.items() for load in (0, 1) if n[load]]
    got = {r["g"]: r for r in profile.two_sample(spark.createDataFrame(data, "g string, load bigint, a string, b string, n bigint"), "g", "load", ["a", "b"]).collect()}

    def fitted(x, w0, w1):
        start = np.r_[np.log(w1.sum() / w0.sum()), np.zeros(x.shape[1] - 1)]
        ridge, t = np.r_[1e-6, np.full(x.shape[1] - 1, profile.RIDGE)], np.zeros(x.shape[1])
        for _ in range(60_000):
            p = 1 / (1 + np.exp(-(x @ t)))
            t -= 0.02 * (x.T @ ((w0 + w1) * p - w1) + ridge * (t - start))
        return t

    def auc(score, w0, w1):
        s = np.round(score, 6)
        return sum(a * b * (1.0 if j > i else 0.5 if j == i else 0.0) for i, a in zip(s, w0) for j, b in zip(s, w1)) / (w0.sum() * w1.sum())

    for g, cells in counts.items():
        w0, w1 = (np.array([float(c[i]) for c in cells.values()]) for i in (0, 1))
        columns = [[k[i] for k in cells] for i in (0, 1)]
        hot = [np.array([[float(v == u) for u in sorted(set(map(str, c)))] for v in map(str, c)]) for c in columns]
        varied = [i for i in (0, 1) if hot[i].shape[1] > 1]
        one = np.ones((len(w0), 1))
        full = lambda use: auc(np.hstack([one, *(hot[i] for i in use)]) @ fitted(np.hstack([one, *(hot[i] for i in use)]), w0 / 2, w1 / 2), w0, w1) if use else 0.5  # noqa: E731, B023  (every count is even: both folds are alike)
        x = np.hstack([one, *(hot[i] for i in varied)])
        z, share = x @ fitted(x, w0, w1), w1.sum() / (w0.sum() + w1.sum())
        gain = -(w1.sum() * np.log(share) + w0.sum() * np.log(1 - share)) - (w1 * np.log1p(np.exp(-z)) + w0 * np.log1p(np.exp(z))).sum()
        assert abs(got[g]["separation"] - gain) < 1e-3 and abs(got[g]["auc"] - full(varied)) < 1e-6, g
        for i, n in enumerate("ab"):
            lost = full(varied) - full([j for j in varied if j != i]) if i in varied else 0.0
            assert abs(got[g][f"lost_{n}"] - lost) < 1e-6, (g, n)


def test_loads_of_very_different_size_are_separated(spark):
    sizes = {"grows": [(20, 0), (1_000_000, 900_000)], "shrinks": [(1_000_000, 900_000), (20, 0)], "third": [(20, 0), (130_000, 39_000)], "one": [(1_000_000, 300_000), (1, 0)], "same": [(20, 0), (1_000_000, 0)]}
    data = [(m, t, missing, n) for m, pair in sizes.items() for t, (n_all, nulls) in enumerate(pair) for missing, n in [(False, n_all - nulls), (True, nulls)] if n]
    cells = spark.createDataFrame(data, "metric string, load bigint, missing boolean, n bigint")
    got = {x["metric"]: x["separation"] for x in profile.two_sample(cells, "metric", "load", ["missing"]).collect()}
    assert all(got[m] > 1e-3 for m in sizes if m != "same") and abs(got["same"]) <= 1e-9, got


# Drifting schemas -------------------------------------------------------------------------


def test_migrations_and_the_routed_table(spark, rows):
    files = [
        ("s", 1, {"a": 1, "v": "2.50", "k": None}), ("s", 1, {"a": 2}), ("s", 3, {"a": 1.0, "volume": "1"}), ("s", 4, {"a": "x", "volume": None}), ("s", 5, None), ("u", 9, {"a": True}),
    ]
    data = [(s, o, json.dumps(p) if p is not None else "not json") for s, o, p in files] + [(None, 1, "{}"), ("s", None, "{}")]
    df = spark.createDataFrame(data, "src string, no bigint, p string").withColumn("alias", F.lit(0))
    aliases = spark.createDataFrame([("v", "base"), ("volume", "base")], "alias string, canonical_field string")
    fields = drift.file_fields(df, "src", "no", "p", aliases)
    chain = drift.chain(df, fields, "src", "no")
    got = {(r["src"], r["no"], r["canonical"], r["change_kind"]) for r in drift.migrations(chain, fields, "src", "no").collect()}
    assert got == {("s", 3, "base", "renamed"), ("s", 3, "k", "removed"), ("s", 3, "a", "type_changed"), ("s", 4, "a", "type_changed"), ("s", 5, "a", "removed"), ("s", 5, "base", "removed")}
    more = df.unionByName(df.filter("no = 4").withColumn("no", F.lit(20_004).cast("bigint")))  # the same schema in a later block of files
    numbered = {(r["src"], r["no"]): (r["version"], r["opened"], r["previous"]) for r in drift.chain(more, drift.file_fields(more, "src", "no", "p", aliases), "src", "no").collect()}
    assert numbered == {("s", 1): (1, 1, None), ("s", 3): (2, 3, 1), ("s", 4): (3, 4, 3), ("s", 5): (4, 5, 4), ("s", 20_004): (5, 20_004, 5), ("u", 9): (1, 9, None)}
    routes = drift.rules(chain, fields, "src", "no")
    out = drift.migrate(df.filter("src = 's' and no < 5"), "p", ["no"], routes, ["src", "no"], {"base": "number", "a": "whole"}, {"base": "7"})
    assert [(n, v, float(b), a) for n, v, b, a in rows(out)] == [(1, 1, 2.5, 1), (1, 1, 7.0, 2), (3, 2, 1.0, 1), (4, 3, 7.0, None)]
    lost = drift.migrate(df.filter("src is null or no is null or no = 5"), "p", ["src", "no"], routes, ["src", "no"], {"base": "number"}, {"base": "7"})
    assert sorted((r["version"] or 0, float(r["base"])) for r in lost.collect()) == [(0, 7.0), (0, 7.0), (4, 7.0)]
    assert drift.chain(df.limit(0), drift.file_fields(df.limit(0), "src", "no", "p", aliases), "src", "no").count() == 0
