"""Catalogs, contracts, gaps, audits, baselines, sinks and pages on small hard inputs."""

import datetime as dt
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.functions import normalize, scalars
from marlstone.operators import audit, baseline, contracts, features, gapstates, multiset
from marlstone.session import scratch
from marlstone.sources import archives, catalog, pages, publish


def _at(spark, column):
    return spark.range(1).select(column).first()[0]


# Catalog ----------------------------------------------------------------------------------


def test_paths_that_leave_their_root(spark):
    paths = {"a/b.parquet": False, "a/../b": False, "../a": True, "a/../../b": True, "/etc/x": True, "C:\\x": True, ".\\a\\..\\b": False, "": False}
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    assert {r[0]: r[1] for r in df.select("p", catalog.escapes(F.col("p"))).collect()} == paths
    listed = spark.createDataFrame([("ok", "h"), ("../out", None), ("gone", None), ("bad", "h")], "relative_path string, parquet_sha256 string")
    there = spark.createDataFrame([("ok", "H"), ("bad", "other")], "relative_path string, sha256 string")
    assert {tuple(r) for r in catalog.problems(listed, there).collect()} == {("../out", "escapes_root"), ("gone", "missing"), ("bad", "hash_mismatch")}


def _record(**fields):
    return {f.name: fields.get(f.name) for f in catalog.LOG.fields} | {"manifest": fields.get("manifest", "m.jsonl"), "number": fields["number"]}


def test_generations_removals_and_hash_lists(spark):
    rows = [
        _record(number=1, dataset_class="funding", symbol="A", object_id="f1.parquet"), _record(number=2, dataset_class="funding_rate", symbol="A", created_parquets=["f2.parquet", "f3.parquet"], parquet_sha256='["x"]'), _record(number=3, dataset_class="funding_rate", symbol="B", object_id="g.PARQUET"),
        _record(number=4, dataset_class="individual_trade", object_id="t1.parquet", parquet_sha256="t"), _record(number=5, dataset_class="individual_trade", object_id="t2.parquet"), _record(number=6, dataset_class="individual_trade", action="superseded", superseded_object_ids=["t2.parquet", "no"]),
        _record(number=7, dataset_class="individual_trade", object_id="t2.parquet"), _record(number=8, object_id="derived\\trade_bucket\\b1.parquet", source_parquet_sha256="t"), _record(number=9, object_id="trade_bucket/b2.parquet", source_parquet_sha256="gone"),
        _record(number=10, object_id="trade_bucket/b3.parquet"), _record(number=11, dataset_class="individual_trade", action="QUARANTINED", quarantined_parquets=["q/q.parquet"]), _record(number=12, dataset_class="individual_trade", object_id="z/q.parquet"),
        _record(number=13, dataset_class="other", object_id="o.parquet"), _record(number=14, dataset_class="ohlcv", object_id="notes.txt"), _record(number=15, dataset_class="ohlcv", action="VALIDATED", object_id="v.parquet"),
    ]
    schema = T.StructType([*catalog.LOG.fields, T.StructField("manifest", T.StringType()), T.StructField("number", T.LongType())])
    df = spark.createDataFrame([tuple(r[f.name] for f in schema.fields) for r in rows], schema)
    got = {r["relative_path"]: (r["dataset_class"], r["parquet_sha256"]) for r in catalog.active(df).collect()}
    assert got == {
        "f2.parquet": ("funding_rate", "x"), "f3.parquet": ("funding_rate", None), "g.PARQUET": ("funding_rate", None), "t1.parquet": ("individual_trade", "t"),
        "derived/trade_bucket/b1.parquet": ("derived_trade_bucket", None), "trade_bucket/b3.parquet": ("derived_trade_bucket", None),
    }
    assert catalog.active(df.limit(0)).count() == 0


def test_a_catalog_refuses_changed_files_and_types_empty_views(spark, tmp_path):
    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "normalized/x"))
    file = next((tmp_path / "normalized/x").glob("*.parquet"))
    log = tmp_path / "control/manifests/a.jsonl"
    log.parent.mkdir(parents=True)
    event = {"dataset_class": "ohlcv", "object_id": f"normalized/x/{file.name}", "parquet_sha256": hashlib.sha256(file.read_bytes()).hexdigest()}
    log.write_text("\n" + json.dumps(event) + "\n\n")
    built = catalog.build(spark, f"file://{tmp_path}", {"open_interest": T.StructType([T.StructField("oi", T.LongType())])})
    assert spark.sql("select count(*) from market_ohlcv").first()[0] == 3 and spark.table("market_open_interest").columns == ["oi", "filename"]
    assert [(r["manifest"].rpartition("/")[2], r["number"]) for r in built.files.collect()] == [("a.jsonl", 2)] and spark.table("instrument_metadata_snapshots").count() == 0
    log.write_text(json.dumps(event | {"parquet_sha256": "0" * 64}))
    with pytest.raises(ValueError, match="hash_mismatch"):
        catalog.build(spark, f"file://{tmp_path}")
    assert catalog.inventory(spark, f"file://{tmp_path}", "*.jsonl").first()["sha256"] == hashlib.sha256(log.read_bytes()).hexdigest()


# Contracts and gaps -----------------------------------------------------------------------


def test_contracts_refuse_other_shapes_and_name_broken_rules(spark):
    c = contracts.Contract("c", "1", (contracts.Field("a", "bigint", False), contracts.Field("b", "string")), {"b_short": "length(b) < 3"})
    df = spark.createDataFrame([(1, "x"), (None, "long"), (2, None)], "a bigint, b string")
    assert [r["violations"] for r in c.checked(df).collect()] == [[], ["a_required", "b_short"], ["b_short"]] and c.schema().names == ["a", "b"]
    assert c.shape_problems(df.drop("b").withColumn("z", F.lit(1)).withColumn("a", F.lit("t"))) == ["missing b", "unknown z", "a is string, not bigint"]
    with pytest.raises(ValueError, match="unknown z"):
        c.checked(df.withColumn("z", F.lit(1)))
    with pytest.raises(Exception, match="a is 1"):
        contracts.isolated(df, {"a": "1"}).count()


def test_sequence_issues(spark):
    data = [(1, "i", 5, "1"), (2, "i", 5, "2"), (3, "i", 9, "x"), (4, "i", None, "1"), (5, "j", 1, "-1"), (6, None, 1, "0"), (7, "i", 9, "3")]
    df = spark.createDataFrame(data, "seq bigint, ins string, t bigint, v string")
    found = contracts.sequence_issues(df, {"number": "try_cast(v as double) >= 0"}, ["ins", "t"], ["ins"], "t", "seq")
    assert {r["seq"]: r["issues"] for r in found.collect()} == {1: [], 2: ["duplicate_key", "not_later"], 3: ["number"], 4: ["not_later"], 5: ["number"], 6: [], 7: ["duplicate_key", "not_later"]}
    assert contracts.sequence_issues(df.limit(0), {}, ["ins", "t"], ["ins"], "t", "seq").count() == 0


def test_revisions_states_and_old_records(spark, rows):
    log = spark.createDataFrame([("g", 1, "OPEN"), ("g", 4, "PARTIAL"), ("h", 2, "OPEN"), ("k", 3, "CLOSED")], "id string, seq int, status string")
    changes = spark.createDataFrame([("g", "RECOVERED"), ("h", None), ("unknown", "OPEN")], "id string, status string")
    assert rows(contracts.revised(log, changes, ["id"], "seq").exceptAll(log)) == [("g", 5, "RECOVERED"), ("h", 3, "OPEN")]
    steps = contracts.changes_of_state(log, ["id"], "seq", "status", {"OPEN": ["RECOVERED"]}, "OPEN")
    assert rows(steps) == sorted([("g", 4, "OPEN", "PARTIAL"), ("k", 3, None, "CLOSED")], key=repr)
    old = spark.createDataFrame([("RECOVERED_GAP", None), ("SOURCE_GAP", "n")], "gap_type string, notes string")
    assert rows(contracts.upgraded(old, {"notes": "'-'", "pages": "0"}, {"gap_type": gapstates.OLD_TYPES})) == [("LOCAL_COLLECTOR_GAP", "-", 0), ("SOURCE_GAP", "n", 0)]


def test_gaps_between_overlapping_sessions_and_what_recovers_them(spark, rows):
    s = spark.createDataFrame([("a", 0, 10, "1"), ("a", 2, 50, "2"), ("a", 12, 20, "3"), ("a", 60, 70, "4"), ("a", 70, 80, "5"), ("b", 5, 6, "6")], "k string, a bigint, b bigint, id string")
    assert rows(gapstates.between_sessions(s, ["k"], "a", "b", "id")) == [("a", 50, 60, "2", "4")]
    g = spark.createDataFrame([("individual_trade", "bybit", "spot", 60, False), ("individual_trade", "bybit", "spot", 60, True), ("individual_trade", "binance", "spot", 60, None), ("ohlcv", "bybit", "spot", 9, True), ("individual_trade", "x", "y", None, True)], "dataset_class string, exchange string, market_type string, fetched int, proven boolean")
    assert [(r["status"], r["note"]) for r in gapstates.recovery(g).collect()] == [("PARTIAL", "TRUNCATION_RISK"), ("RECOVERED", "PROVEN"), ("PARTIAL", "UNPROVEN"), ("UNRECOVERABLE", "UNSUPPORTED_CLASS"), ("UNRECOVERABLE", "NO_RECORDS")]
    assert _at(spark, gapstates.failure_reason(F.lit("Read TIMED OUT"))) == "TIMEOUT" and _at(spark, gapstates.failure_reason(F.lit(None).cast("string"))) is None
    waits = [_at(spark, gapstates.backoff_seconds(F.lit(n), seed=3)) for n in (1, 4, 40)]
    assert waits == [_at(spark, gapstates.backoff_seconds(F.lit(n), seed=3)) for n in (1, 4, 40)] and 0.8 <= waits[0] <= 1.2 and 48 <= waits[2] <= 72
    with pytest.raises(ValueError):
        gapstates.records(s, "k", "NO_SUCH_GAP")


# Baseline and audits ----------------------------------------------------------------------


@pytest.mark.parametrize("change", [{"policy_version": " "}, {"policies": None}, {"policies": {"p": {"calibration_state": "CALIBRATED", "comparison": "MAXIMUM"}}}, {"policies": {"p": {"calibration_state": "UNCALIBRATED", "threshold": 1}}}, {"policies": {"p": {"calibration_state": "MAYBE"}}}])
def test_policy_documents_that_are_refused(spark, change):
    with pytest.raises(ValueError):
        baseline.policies(spark, {"policy_version": "1", "policies": {}} | change)


def test_judgements(spark, tmp_path):
    document = {"policy_version": "1", "policies": {"most": {"calibration_state": "CALIBRATED", "comparison": "MAXIMUM", "threshold": 0.5, "failure_impact": "UNAVAILABLE"}, "least": {"calibration_state": "CALIBRATED", "comparison": "MINIMUM", "threshold": 2, "failure_impact": "DEGRADE"},
                "open": {"calibration_state": "UNCALIBRATED", "failure_impact": "DEGRADE"}, "none": {"calibration_state": "NOT_APPLICABLE", "failure_impact": "DEGRADE"}, "any": {"calibration_state": "CALIBRATED", "comparison": "CATEGORICAL"}}}
    (tmp_path / "p.json").write_text(json.dumps(document))
    table = baseline.load_policies(spark, f"file://{tmp_path / 'p.json'}")
    data = [("most", "0.5"), ("most", "0.6"), ("most", None), ("least", "1"), ("open", "1"), ("none", "1"), ("any", "QUIET"), ("unheard of", "1")]
    found = baseline.judged(spark.createDataFrame(data, "policy_id string, observed_value string"), table).select("policy_id", "observed_value", "evaluation", "eligibility_impact")
    assert {tuple(r)[:2]: tuple(r)[2:] for r in found.collect()} == {
        ("most", "0.5"): ("PASS", "NONE"), ("most", "0.6"): ("FAIL", "UNAVAILABLE"), ("most", None): ("UNKNOWN", "UNAVAILABLE"), ("least", "1"): ("FAIL", "DEGRADE"), ("open", "1"): ("UNKNOWN", "DEGRADE"), ("none", "1"): ("NOT_APPLICABLE", "NONE"), ("any", "QUIET"): ("PASS", "NONE"), ("unheard of", "1"): ("UNKNOWN", "NONE"),
    }
    assert baseline.verdict(found).first()["eligibility"] == "UNAVAILABLE" and baseline.verdict(found.limit(0)).first()["eligibility"] == "USABLE"


def test_deletions_are_applied_once_and_changed_files_stay(spark, rows):
    plan = audit.deletion_plan(spark.createDataFrame([("s", "a", "1"), ("s", "b", "2"), ("t", "c", "3")], "source string, ref string, sha256 string"), spark.createDataFrame([("s", True), ("t", False)], "source string, complete boolean"))
    there = spark.createDataFrame([("a", "1"), ("b", "changed")], "ref string, sha256 string")
    empty = spark.createDataFrame([], "deletion_id string")
    first = audit.applied(plan.unionByName(plan), empty, there, dry_run=False)
    assert rows(first.select("object_id", "status")) == [("a", "DELETED"), ("b", "CHECKSUM_CHANGED")]
    assert audit.applied(plan, first, there, dry_run=False).count() == 0 and audit.applied(plan, first, there).count() == 2  # a dry run is another event
    log = spark.createDataFrame([("x", 1, "ADDED"), ("x", 2, "REMOVED"), ("y", 1, "REMOVED"), ("y", 2, "ADDED")], "hold string, seq int, event string")
    assert rows(audit.holds(log)) == [("y",)]


def test_quantiles_equal_plain_ones(spark):
    r = random.Random(4)
    data = [(k, v) for k in ("a", "b", None) for v in [0.0, -1.5, None, *(r.choice([-1, 1]) * 10 ** r.uniform(-3, 3) for _ in range(300 if k == "a" else 7))]] + [("none", None), ("one", 5.0)]
    df = spark.createDataFrame(data, "k string, v double")
    shares = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = {x["k"]: [x["n"], *(x[f"q{i}"] for i in range(5))] for x in multiset.quantiles(df, ["k"], "v", shares).collect()}
    want = {x["k"]: [x["n"], *x["q"]] for x in df.filter("v is not null").groupBy("k").agg(F.count("v").alias("n"), F.percentile("v", F.array(*map(F.lit, shares))).alias("q")).collect()}
    assert {k: [round(x, 9) for x in v] for k, v in got.items()} == {k: [round(x, 9) for x in v] for k, v in want.items()}


# Sinks and pages --------------------------------------------------------------------------


def test_downloads_appear_whole_and_as_expected_or_not_at_all(tmp_path):
    target, content = f"file://{tmp_path}/d/x.gz", [b"ab", b"c"]
    digest = hashlib.sha256(b"abc").hexdigest()
    assert publish.fetch(content, target, digest.upper()) == digest and (tmp_path / "d/x.gz").read_bytes() == b"abc"
    with pytest.raises(publish.Refused):
        publish.fetch(content, f"file://{tmp_path}/d/y", "0" * 64)
    assert [p.name for p in (tmp_path / "d").iterdir()] == ["x.gz"]
    at = publish.land(b"abc", f"file://{tmp_path}/raw", ".json")
    assert at == publish.land(b"abc", f"file://{tmp_path}/raw", ".json") and digest in at and publish.sidecar(f" {digest.upper()}  x.zip\n") == digest
    with pytest.raises(publish.Refused):
        publish.sidecar("nothing")
    publish.document({"b": 1, "a": 2}, f"file://{tmp_path}/doc.json")
    assert (tmp_path / "doc.json").read_text() == '{\n  "a": 2,\n  "b": 1\n}\n'


def test_event_logs_take_an_event_once_and_refuse_another_of_its_name(spark, rows):
    log = publish.EventLog(spark, scratch(spark, "log"), "id string, v bigint", "id")
    make = lambda *x: spark.createDataFrame(x, "id string, v bigint")
    assert log.append(make(("a", 1), ("a", 1), ("b", None))) == 2 and log.append(make(("b", None), ("c", 3))) == 1
    assert rows(log.read().drop("append")) == sorted([("a", 1), ("b", None), ("c", 3)], key=repr)
    for bad in (make(("a", 2)), make(("d", 1), ("d", 2)), make(("b", 1))):
        with pytest.raises(publish.Refused):
            log.append(bad)
    assert log.read().count() == 3


def test_leases_and_stale_partials(spark, tmp_path, rows):
    now = [1000.0]
    one, two = (publish.Lease(spark, f"file://{tmp_path}/lease", n, 60, lambda: now[0]) for n in ("one", "two"))
    assert one.acquire() and one.acquire() and not two.acquire()
    two.release()
    now[0] += 61
    assert two.acquire() and not one.acquire()
    two.release()
    assert one.acquire()
    t = dt.datetime(2021, 1, 1)
    files = spark.createDataFrame([("a.partial", t), ("b.partial", t), ("c.partial", dt.datetime(2021, 1, 2)), ("d", t)], "path string, modified timestamp")
    held = spark.createDataFrame([("b.partial",)], "path string")
    assert rows(publish.stale_partials(files, F.lit("2021-01-02 01:00:00").cast("timestamp"), 24, held).select("path")) == [("a.partial",)]


def test_pipeline_quarantines_merges_and_repeats_nothing(spark):
    root = scratch(spark, "run")
    log = publish.EventLog(spark, f"{root}/log", "event_id string, source_dataset_id string, row_count bigint", "event_id")
    run = lambda *x: publish.ingest(spark.createDataFrame(x, "k bigint, v bigint"), root, {"positive": F.col("v") > 0}, ["k"], F.col("k") % 2, log, {"source_dataset_id": "s"})
    first = run((1, 1), (2, 2), (3, -1), (4, None))
    assert (first.accepted, first.quarantined, first.added, first.fresh) == (2, 2, 2, True) and not run((2, 2), (1, 1)).fresh
    second = run((1, 5), (6, 6))
    assert (second.accepted, second.quarantined, second.added) == (2, 0, 1) and log.read().count() == 2
    stored = publish.GenerationTable(spark, f"{root}/data", T._parse_datatype_string("k bigint, v bigint")).read()
    assert {(r["k"], r["v"]) for r in stored.collect()} == {(1, 5), (2, 2), (6, 6)}


@pytest.mark.parametrize("mode", ["forward", "backward", "cursor"])
@pytest.mark.parametrize("limit", [1, 3, 100])
def test_walks_cover_the_range_once(mode, limit):
    held = [(t, f"r{t}") for t in (0, 3, 4, 9, 20, 21, 22)]

    def page(low, high, n, cursor):
        inside = [h for h in held if low <= h[0] < high]
        if mode == "cursor":
            first = int(cursor or 0)
            return inside[first : first + n], str(first + n) if first + n < len(inside) else None
        return (inside[:n] if mode == "forward" else inside[-n:][::-1]), None

    got, reason = pages.walk(page, 3, 22, limit, mode)
    assert [g[0] for g in got] == [3, 4, 9, 20, 21] and reason in (pages.RANGE_COVERED, pages.SOURCE_EMPTY, pages.CURSOR_EMPTY)
    part, reason = pages.walk(page, 3, 22, 1, mode, most_pages=2)
    assert len(part) == 2 and reason == pages.PAGE_LIMIT_REACHED and pages.walk(page, 5, 5, 1, mode) == ([], pages.RANGE_COVERED)
    with pytest.raises(ValueError):
        pages.walk(lambda *a: ([(1, "x"), (1, "y")], None), 0, 9, 5, mode)


def test_archives_with_checksums_and_headers(spark, tmp_path, rows):
    import zipfile

    for name, text in (("a", "id,x\n1,\"p,q\"\n2,r\n3\n"), ("b", "1,2\n")):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            z.writestr("m.csv", text)
    (tmp_path / "a.zip.CHECKSUM").write_text(hashlib.sha256((tmp_path / "a.zip").read_bytes()).hexdigest() + "  a.zip")
    assert {r["path"].rpartition("/")[2]: r["state"] for r in archives.verified(spark, f"file://{tmp_path}").collect()} == {"a.zip": "ok", "b.zip": "no_checksum"}
    got = archives.zip_csv(spark, f"{tmp_path}/a.zip", ["id", "x"], header="mandatory").select("ordinal", "id", "x", "_corrupt")
    assert rows(got) == sorted([(1, "1", "p,q", None), (2, "2", "r", None), (3, None, None, "3")], key=repr)
    with pytest.raises(Exception, match="no header"):
        archives.zip_csv(spark, f"{tmp_path}/b.zip", ["id", "x"], header="mandatory").count()


# Data sets and texts ----------------------------------------------------------------------


def test_data_sets_never_look_ahead(spark, rows):
    base = spark.createDataFrame([("a", 10), ("a", 20), ("b", 5), ("a", None)], "k string, t bigint")
    other = spark.createDataFrame([("a", 11, 1.0), ("a", 20, 2.0), ("a", 30, 3.0), (None, 1, 4.0)], "k string, t bigint, v double")
    assert rows(features.aligned(base, [(other, ["v"], 5, "o_")], ["k"], "t").select("k", "t", "o_v", "o_quality")) == sorted([("a", 10, None, "missing"), ("a", 20, 2.0, "exact_available"), ("b", 5, None, "missing"), ("a", None, None, "missing")], key=repr)
    split = features.walk_forward(spark.createDataFrame([(t, t + 4) for t in range(0, 40, 2)], "s bigint, e bigint"), "s", "e", 20, 10, 6, 2, 1)
    got = {}
    for r in split.collect():
        got.setdefault((r["fold"], r["role"]), []).append(r["s"])
    assert {k: sorted(v) for k, v in got.items()} == {(0, "train"): [10, 12, 14], (0, "test"): [20, 22, 24], (1, "train"): [16, 18, 20], (1, "test"): [26, 28, 30]}


def test_confusion_divergence_and_imbalance(spark, rows):
    df = spark.createDataFrame([("U", "U"), ("U", "D"), ("N", "U"), (None, "U"), ("D", None)], "l string, g string")
    got = {r["class"]: (r["support"], r["guessed"], r["hits"], r["precision"]) for r in features.confusion(df, "l", "g").collect()}
    assert got == {"U": (2, 2, 1, 0.5), "D": (0, 1, 0, 0.0), "N": (1, 0, 0, None)}
    v = spark.createDataFrame([(1, "a", 3.0), (1, "b", 1.0), (2, "a", 1.0), (3, "a", 0.0), (3, "b", 0.0)], "s int, g string, p double")
    assert rows(features.divergence(v, ["s"], "g", "a", "b", ["p"])) == sorted([(1, 2.0, 1.0), (3, 0.0, None)], key=repr)
    sides = spark.createDataFrame([("k", "buy", 3), ("k", "SELL", 1), ("z", None, 5)], "k string, side string, q int")
    assert rows(features.imbalance(sides, ["k"], "side", "q")) == sorted([("k", 3.0, 1.0, 0.5), ("z", 0.0, 0.0, None)], key=repr)


def test_redaction_locales_and_final_candles(spark, rows):
    text = '{"a.b": {"Key": "s\\"x", "n": {"KEY": -12.5e3}}, "other": "tok"} key=1&y=2'
    assert _at(spark, scalars.redacted(F.lit(text), ["key"], known=["tok"])) == '{"a.b": {"Key": "***", "n": {"KEY": "***"}}, "other": "***"} key=***&y=2'
    assert _at(spark, scalars.redacted(F.lit('{"axb": "1", "a.b": "2"}'), ["a.b"])) == '{"axb": "1", "a.b": "***"}'
    messages = spark.createDataFrame([("en", "k", "hi"), ("de", "k", "hallo"), ("en", "j", "yo")], "locale string, key string, template string")
    asked = spark.createDataFrame([("de", "k"), ("fr", "k"), ("de", "j"), ("de", "none"), (None, "k")], "locale string, key string")
    assert rows(scalars.located(asked, messages, "en")) == sorted([("k", "de", "hallo"), ("k", "fr", "hi"), ("j", "de", "yo"), ("none", "de", None), ("k", None, "hi")], key=repr)
    cut = F.lit("2021-01-01 00:02:00").cast("timestamp")
    one = lambda text: F.lit(text).cast("timestamp")
    assert [_at(spark, normalize.closed_by(cut, open_time=one(t))) for t in ("2021-01-01 00:01:00", "2021-01-01 00:01:00.000001", None)] == [True, False, False]
    assert [_at(spark, normalize.closed_by(cut, close_time=one(t))) for t in ("2021-01-01 00:01:59.999", "2021-01-01 00:02:00", None)] == [True, False, False]


def test_strict_trades_refuse_other_words_and_days(spark):
    df = spark.createDataFrame([("1", "2", "3", "6", "1609459200000", "True", "False"), ("2", "2", "3", "6", "1609459200000", "true", "True"), ("3", "0", "3", "6", "1609545600000", "False", "True")], "id string, price string, qty string, quote_qty string, time string, is_buyer_maker string, is_best_match string")
    made = normalize.archive_trades(df, "ms", strict=True)
    from marlstone.operators import quality

    assert {r["native_trade_id"]: r["v"] for r in made.withColumn("v", quality.violations(normalize.trade_rules("2021-01-01"))).collect()} == {"1": [], "2": ["side"], "3": ["price", "of_the_day"]}


# Operations -------------------------------------------------------------------------------


def test_settings_health_and_gates(spark, tmp_path):
    from marlstone import operations

    path = tmp_path / "c.json"
    path.write_text(json.dumps({"data_root": f"file://{tmp_path}/root", "warn_gib": 3, "degrade_gib": 2, "stop_gib": 0.001}))
    config = operations.load(str(path), {"MARLSTONE_LOG_LEVEL": "DEBUG"})
    assert config.log_level == "DEBUG" and operations.disk_tier(2.5, config) == "WARNING" and operations.disk_tier(0, config) == "CRITICAL"
    for bad in ({"data_root": "x", "unknown": 1}, {"data_root": "x", "warn_gib": 1}, {"data_root": ""}, {"data_root": 5}):
        path.write_text(json.dumps(bad))
        with pytest.raises(ValueError):
            operations.load(str(path), {})
    before = dict((c, s) for c, s, _ in operations.health(spark, config))
    assert before["data_root"] == "WARN" and before["redaction"] == "PASS" and "control/manifests" in operations.make_folders(spark, config) and operations.make_folders(spark, config) == []
    checks = operations.health(spark, config)
    assert {c: s for c, s, _ in checks}["atomic_rename"] == "PASS" and operations.exit_code(checks) in (0, 1) and not [p for p in (tmp_path / "root").iterdir() if "probe" in p.name]
    assert operations.exit_code([("a", "FAIL", "")]) == 2 and operations.admitted(10, {"a": 3, "b": 2}, 5) == (True, 5) and operations.admitted(10, {"a": 6}, 5)[0] is False
    progress = {"numInputRows": 50, "processedRowsPerSecond": 9.5, "sources": [{"metrics": {"numFilesOutstanding": "3"}}], "eventTime": {"max": "2021-01-01T00:10:00.000Z", "watermark": "2021-01-01T00:00:00.000Z"}}
    assert operations.telemetry(progress, 100) == {"state": "APPLICABLE", "utilization": 0.5, "rows": 50, "rows_a_second": 9.5, "behind": 3, "lag_seconds": 600.0} and operations.telemetry(None)["state"] == "NOT_APPLICABLE"


def test_streams_fail_apart_and_are_tried_again(spark, tmp_path):
    from marlstone.streaming import jobs, supervise

    spark.range(6).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = jobs.file_stream(spark, str(tmp_path / "in"), spark.read.parquet(str(tmp_path / "in")).schema)
    tries = []

    def broken(df):
        tries.append(1)
        if len(tries) < 3:
            raise OSError("disk full")
        return df

    capture = lambda name, fn: lambda: jobs.capture(stream, f"{tmp_path}/{name}/raw", f"{tmp_path}/{name}/norm", fn, f"{tmp_path}/{name}/cp")
    slept = []
    sessions = supervise.run_all(spark, {"good": capture("good", lambda df: df), "flaky": capture("flaky", broken), "lost": lambda: 1 / 0}, most_attempts=3, sleep=slept.append)
    got = {}
    for r in sessions.orderBy("attempt").collect():
        got.setdefault(r["stream"], []).append(r["state"])
    assert got == {"good": ["CLOSED"], "flaky": ["FAILED", "FAILED", "CLOSED"], "lost": ["FAILED"] * 3} and slept.count(1.0) == 2
    assert spark.read.parquet(f"{tmp_path}/flaky/norm").count() == 6
    gaps = gapstates.between_sessions(sessions.filter("stream = 'lost'"), ["stream"], "started_us", "ended_us", "session")
    assert gaps.count() <= 2


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    from marlstone import __main__, session

    monkeypatch.setattr(session, "build", lambda *a, **k: spark)
    assert __main__.main(["list"]) == 0 and "p7_found" in capsys.readouterr().out and __main__.main(["run", "nothing", "a", "b"]) == 2
    (tmp_path / "c.json").write_text(json.dumps({"data_root": f"file://{tmp_path}/root"}))
    assert __main__.main(["config-check", str(tmp_path / "c.json")]) == 0 and __main__.main(["config-check", str(tmp_path / "none.json")]) == 2
    assert __main__.main(["paths-init", str(tmp_path / "c.json")]) == 0 and __main__.main(["health", str(tmp_path / "c.json")]) in (0, 1, 2)
    spark.createDataFrame([("binance", "spot", "i", "s", "1", "t1", "BUY"), ("binance", "spot", "i", "s", "1", "t1", "x")], "exchange string, market_type string, instrument_id string, source_dataset_id string, schema_version string, native_trade_id string, taker_side string").coalesce(1).write.parquet(str(tmp_path / "root/normalized/t"))
    file = next((tmp_path / "root/normalized/t").glob("*.parquet"))
    (tmp_path / "root/control/manifests/t.jsonl").write_text(json.dumps({"dataset_class": "individual_trade", "object_id": f"normalized/t/{file.name}"}) + "\n")
    (tmp_path / "root/control/gap_registry/g.jsonl").write_text("".join(json.dumps({"gap_id": "g", "dataset_class": "individual_trade", "exchange": "binance", "market_type": "spot", "instrument_id": "i", "gap_type": "RECOVERED_GAP", "status": s}) + "\n" for s in ("OPEN", "RECOVERED")))
    capsys.readouterr()
    assert __main__.main(["sql", f"file://{tmp_path}/root", "select count(*) as n from market_individual_trade"]) == 0 and "|2" in capsys.readouterr().out
    from marlstone.plans.control_queries import DOCUMENT

    (tmp_path / "p.json").write_text(json.dumps(DOCUMENT))
    assert __main__.main(["dq-baseline", f"file://{tmp_path}/root", "--policy", f"file://{tmp_path}/p.json", "--output", str(tmp_path / "out")]) == 2
    said = json.loads(capsys.readouterr().out)
    assert said["eligibility"] == "UNAVAILABLE" and said["pass"] == 1 and said["fail"] == 2
    lines = [json.loads(x) for p in (tmp_path / "out").glob("*.txt") for x in p.read_text().splitlines()]
    assert len(lines) == said["metrics"] and {x["metric"]: x["evaluation"] for x in lines}["gap_exposure"] == "PASS"


def test_soak_command_captures_folders_side_by_side(spark, tmp_path, capsys, monkeypatch):
    from marlstone import __main__, session

    monkeypatch.setattr(session, "build", lambda *a, **k: spark)
    for name in ("one", "two"):
        spark.range(5).coalesce(1).write.parquet(str(tmp_path / name))
    assert __main__.main(["soak", str(tmp_path / "root"), str(tmp_path / "one"), str(tmp_path / "two"), "--max-attempts", "1"]) == 0
    assert spark.read.parquet(str(tmp_path / "root/normalized/two")).count() == 5 and "CLOSED" in capsys.readouterr().out
