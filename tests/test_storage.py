"""Tables written where they change, logs that count once, and files as users have them."""

import datetime as dt
import os
import subprocess
import sys
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from dimkiln.functions.text import error_line
from dimkiln.operators import evolve as EV
from dimkiln.operators import facts as FX
from dimkiln.operators import metadata as M
from dimkiln.operators.keys import check_active_keys
from dimkiln.plans import pipeline as PL
from dimkiln.plans import scenarios as S
from dimkiln.sinks import store
from dimkiln.sinks.buckets import BUCKET, BucketTable, bucket_of
from dimkiln.sinks.daylog import DayLog
from dimkiln.sources import files
from dimkiln.spec import DimensionSpec
from dimkiln.streaming.incremental import load_increment, read_loaded, stored_mark

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


# --- buckets ---------------------------------------------------------------------------


def test_a_merge_writes_only_the_buckets_it_touches(spark, scratch):
    table = BucketTable(spark, f"{scratch}/a [1] {{b}}", buckets=8)
    rows = spark.range(200).selectExpr("id as sk", "concat('k', id) as k", "'old' as v")
    assert table.read() is None and table.write(rows, ["k"]) == 1
    before = table.manifest()["folders"]
    delta = spark.createDataFrame([(5, "k5", "new"), (900, "k900", "fresh")], "sk long, k string, v string")
    touched = {str(r[0]) for r in delta.select(bucket_of(["k"], 8)).collect()}
    assert table.merge(delta, "sk") == 2
    after = table.manifest()["folders"]
    assert {b for b in after if after[b] != before.get(b)} == touched and len(before) == 8
    assert table.read().count() == 201
    assert {r.v for r in table.read().filter("sk in (5, 900)").collect()} == {"new", "fresh"}
    written = sum(len(f) for _, _, f in os.walk(f"{scratch}/a [1] {{b}}/w000002") if f)
    assert written < sum(len(f) for _, _, f in os.walk(f"{scratch}/a [1] {{b}}/w000001") if f)
    assert table.merge(delta.filter("false"), "sk") == 2                 # nothing to do, nothing written
    gone = table.drop_unnamed(keep=1)
    assert sorted(gone) == sorted(before[b] for b in touched if b in before) and table.read().count() == 201


def test_a_refused_or_cut_off_merge_leaves_the_old_state(spark, scratch):
    table = BucketTable(spark, f"{scratch}/t", buckets=4)
    table.write(spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "sk long, k string, Is_Deleted int"), ["k"])
    twin = spark.createDataFrame([(3, "a", 0)], "sk long, k string, Is_Deleted int")
    with pytest.raises(ValueError, match="not unique"):
        table.merge(twin, "sk", lambda rows: check_active_keys(rows, ["k"], False))
    os.makedirs(f"{scratch}/t/w000009")                                  # a crashed attempt
    assert table.version() == 1 and table.read().count() == 2
    assert table.merge(twin.withColumn("k", F.lit("c")), "sk") == 10
    seen = []
    table.merge(twin.withColumn("k", F.lit("a")).withColumn("sk", F.lit(1).cast("long")), "sk",
                lambda rows: seen.extend(r.k for r in rows.collect()))
    assert seen == ["a"]                                                 # only the touched keys are checked


def test_null_keys_and_an_empty_table(spark, scratch):
    table = BucketTable(spark, f"{scratch}/t", buckets=4)
    schema = "sk long, k string, v int"
    table.write(spark.createDataFrame([], schema), ["k"])
    assert table.read().columns == ["sk", "k", "v"] and table.read().count() == 0
    table.merge(spark.createDataFrame([(1, None, 1), (2, "x", 2)], schema), "sk")
    table.merge(spark.createDataFrame([(1, None, 7)], schema), "sk", lambda rows: rows.collect())
    assert sorted(tuple(r) for r in table.read().select("sk", "v").collect()) == [(1, 7), (2, 2)]


def test_a_merge_through_the_pipeline_checks_keys_and_counts(spark, scratch):
    spec = DimensionSpec("Place", keys=("code",), type1=("name",), types={"code": "VARCHAR(5)", "name": "VARCHAR(9)"})
    table = BucketTable(spark, f"{scratch}/d")
    for names, run, want in ((("A", "B", "C"), "2024-01-01 00:00:00", (3, 0, 0)),
                             (("A", "X"), "2024-02-01 00:00:00", (0, 1, 1)), (("A", "X"), "2024-03-01 00:00:00", (0, 0, 0))):
        staged = spark.createDataFrame([(f"c{i}", n) for i, n in enumerate(names)], "code string, name string")
        counts = PL.merge_dimension(spark, table, staged, spec, run)
        assert (counts["Inserted_Count"], counts["Updated_Count"], counts["Deleted_Count"]) == want
    assert table.version() == 3


# --- day logs --------------------------------------------------------------------------


def test_a_purge_drops_days_unread(spark, scratch):
    log = DayLog(spark, f"{scratch}/log", "at")
    assert log.read() is None and log.purge("2024-01-10 00:00:00", 1) == []
    rows = [(i, dt.datetime(2024, 1, 1 + i % 9, i % 24)) for i in range(90)] + [(1000, None)]
    frame = spark.createDataFrame(rows, "id long, at timestamp_ntz")
    log.append(frame.filter("id % 2 = 0"))
    log.append(frame.filter("id % 2 = 1"))
    before = log.manifest()["folders"]
    now = "2024-01-09 06:30:00"
    for d in before:                                  # an expired day whose files are gone is never opened
        if d < "2024-01-05":
            for folder in before[d]:
                os.rename(f"{scratch}/log/{folder}", f"{scratch}/log/{folder}-moved")
    assert log.purge(now, 4) == ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
    after = log.manifest()["folders"]
    assert all(after[d] == before[d] for d in after if d != "2024-01-05")
    edge = dt.datetime(2024, 1, 5, 6, 30)
    assert sorted(r.id for r in log.read().collect()) == sorted(i for i, t in rows if t is None or t >= edge)
    assert log.compact(1) and all(len(f) == 1 for f in log.manifest()["folders"].values())
    assert log.read().count() == len([1 for _, t in rows if t is None or t >= edge])


# --- logs that count once --------------------------------------------------------------


def test_only_committed_attempts_count(spark, scratch):
    log, runs = f"{scratch}/log", f"{scratch}/runs"
    frame = spark.createDataFrame([("S", 1, "x"), ("S", 1, "y")], "Source_Name string, Audit_Source_Import_SK long, r string")
    first, second, third = (store.new_attempt() for _ in range(3))
    store.append_attempt(frame, log, first)                              # stopped before its commit
    store.append_attempt(frame, log, second)
    store.commit_attempt(spark, runs, "S", 1, second)
    counted = lambda: store.committed(spark.read.parquet(log), spark.read.parquet(runs))
    assert counted().count() == 2 and "Attempt" not in counted().columns
    store.append_attempt(frame.limit(1), log, third)                     # the same run once more
    store.commit_attempt(spark, runs, "S", 1, third)
    assert counted().count() == 1


# --- rebuilds under new keys -----------------------------------------------------------


def test_rekeyed_rows_keep_the_one_changed_last(spark):
    T = lambda d: dt.datetime(2024, 1, d)
    old = spark.createDataFrame(
        [(1, "a", "X", T(1), None, 0), (2, "b", "X", T(1), T(3), 0), (3, "c", "X", T(1), T(3), 0),
         (4, "d", "X", T(9), None, 1), (5, "e", "Y", T(1), None, 0), (6, "f", None, T(1), None, 0)],
        "P_SK long, code string, zone string, Inserted_Datetime timestamp_ntz, Updated_Datetime timestamp_ntz, Is_Deleted int")
    old = old.withColumn("Row_Change_Reason", F.lit("NEW"))
    spec = DimensionSpec("P", keys=("zone",), type1=("code",), sk_col="P_SK")
    kept, rejects = EV.split_rebuild(old, spec, "2024-02-01 00:00:00")
    assert sorted(r.P_SK for r in kept.collect()) == [2, 4, 5]
    assert sorted(r.Rejected_Reason for r in rejects.collect()) == [
        "DUPLICATE_KEY: zone=X stays with SK 2", "DUPLICATE_KEY: zone=X stays with SK 2", "NULL_KEY: zone"]
    check_active_keys(kept, ["zone"], False)
    folded = replace(spec, collation="UTF8_LCASE")
    twins = old.filter("P_SK in (1, 5)").withColumn("zone", F.when(F.col("P_SK") == 1, "y").otherwise(F.col("zone")))
    assert [r.P_SK for r in EV.split_rebuild(twins, folded, "2024-02-01 00:00:00")[0].collect()] == [1]


# --- increments ------------------------------------------------------------------------


def test_rows_that_arrive_late_at_the_mark_s_own_time(spark, scratch):
    schema = "id long, at timestamp_ntz"
    t = lambda h: dt.datetime(2024, 1, 1, h)
    offers = [[(1, t(1)), (2, t(2)), (3, None)], [(1, t(1)), (2, t(2)), (4, t(2)), (5, t(1))], [(2, t(2)), (4, t(2))],
              [(4, t(2)), (6, t(2)), (7, t(3)), (8, t(3))], [(7, t(3)), (8, t(3)), (9, t(3)), (6, t(2))]]
    for rows in offers:
        load_increment(spark, spark.createDataFrame(rows, schema), "at", f"{scratch}/f", f"{scratch}/s", "n")
    loaded = sorted((r.id for r in read_loaded(spark, f"{scratch}/f").collect()))
    assert loaded == [1, 2, 3, 4, 6, 7, 8, 9]                            # 5 is older than the mark
    assert stored_mark(spark, f"{scratch}/s", "n").startswith("2024-01-01 03")


def test_states_of_increments_and_what_is_taken_back(spark):
    rows = [("a", 1.25, 1), ("a", 2.5, 1), ("b", 4.0, 1), (None, 0.1, 1), (None, 0.2, 1)]
    frame = lambda r: spark.createDataFrame(r, "g string, v double, sign int")
    state = lambda r: FX.fact_states(frame(r), ["g"], {"total": "v"}, F.col("sign"))
    stored = state(rows[:3])
    both = FX.add_states(stored, state([*rows[3:], ("a", 2.5, -1), ("b", 4.0, -1)]), ["g"], ["total"])
    assert sorted(r.g or "" for r in both.collect()) == ["", "a", "b"]
    got = FX.finished(both, ["g"], ["total"])
    assert sorted(((r.g or "", str(r.total), r.Row_Count) for r in got.collect())) == [("", "0.30", 2), ("a", "1.25", 1)]


# --- mapping fingerprints --------------------------------------------------------------


def test_fingerprints_see_removed_rows_and_no_order(spark):
    columns = M.MAPPING_SPEC.columns
    row = lambda name, col, **kw: tuple({**{c: "0" for c in columns}, "Source_Name": name, "Source_Column": col, **kw}[c]
                                        for c in columns)
    schema = ", ".join(f"{c} string" for c in columns)
    frame = lambda rows: spark.createDataFrame(rows, schema).withColumns(
        {"Is_Deleted": F.lit(0), "Row_Is_Current": F.lit(1)})
    prints = lambda rows: {r[0]: r[1] for r in M.mapping_fingerprints(frame(rows)).collect()}
    a, b, c = row("S", "a"), row("S", "b"), row("R", "a")
    assert prints([a, b, c]) == prints([c, b, a]) and prints([a, b])["S"] != prints([a])["S"]
    assert prints([a, b, c])["R"] == prints([c])["R"]


# --- files -----------------------------------------------------------------------------


def test_a_damaged_file_from_a_foreign_folder(spark, scratch):
    """Python tasks get the package from Spark, not from where the driver was started."""
    code = f"""
import sys
sys.path.insert(0, {REPO!r})
from dimkiln.session import build_session
spark = build_session(master="local-cluster[1,2,1024]", shuffle_partitions=2,
                      extra={{"spark.checkpoint.dir": {scratch + '/ckpt'!r}, "spark.sql.warehouse.dir": {scratch + '/wh'!r}}})
import __spark_entry__ as e
rows = e.queries()["damaged_file_load"](spark, "/root/testdata/sf0.001").collect()
print("ROWS", len(rows), [r.file_name for r in rows if r.kind == "rejected"])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code.replace("local-cluster[1,2,1024]", "local[2]")], cwd=scratch, env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS 101 ['part 1.parquet']" in out.stdout, out.stderr[-2000:]


def test_manifest_names_sizes_rows_and_errors(spark, scratch):
    folder = f"{scratch}/in {{x}} [1]"
    frame = spark.range(30).selectExpr("id", "cast(id as string) as v")
    S.put_file(frame, "parquet", f"{scratch}/m1", f"{folder}/a 50% +b.parquet")
    S.put_file(frame.limit(0), "parquet", f"{scratch}/m2", f"{folder}/empty.parquet")
    with open(f"{folder}/broken file.parquet", "wb") as fh:
        fh.write(b"no parquet")
    got = {r.File_Name: (r.Rows, r.Error is None, r.Size > 0) for r in files.file_manifest(spark, folder, "*.parquet").collect()}
    assert got == {"a 50% +b.parquet": (30, True, True), "empty.parquet": (0, True, True),
                   "broken file.parquet": (None, False, True)}
    rows = files.scan_source(spark, folder, "*.parquet", exclude=["broken file.parquet"])
    assert rows.count() == 30 and {r[files.FILE_NAME] for r in rows.collect()} == {"a 50% +b.parquet"}


def test_missing_rows_of_a_sound_file_fail_the_load(spark, scratch):
    S.put_file(spark.range(30).selectExpr("id"), "parquet", f"{scratch}/m", f"{scratch}/in/a.parquet")
    manifest = files.file_manifest(spark, f"{scratch}/in", "*.parquet")
    loaded = spark.createDataFrame([("a.parquet", 12)], "File_Name string, Loaded long")
    with pytest.raises(OSError, match="repeat the load"):
        files.damaged_files(manifest, loaded, "parquet")
    whole = loaded.withColumn("Loaded", F.lit(30))
    assert files.damaged_files(manifest, whole, "parquet").count() == 0


def test_csv_headers_blank_lines_quotes_and_options(spark, scratch):
    texts = {"a b.csv": 'k,v\n1,"x, y"\n\n2,"say ""hi"""\n', "b%20.csv": "v,k,,K\nz,3,q,dup\n", "c[1].csv": "k\n4\n",
             "empty.csv": "", "only header.csv": "k,v\n"}
    for name, text in texts.items():
        with open(f"{scratch}/{name}", "w") as fh:
            fh.write(text)
    df = files.scan_source(spark, scratch, "*.csv", options={"escape": '"'})
    assert [c for c in df.columns if not c.startswith("_")] == ["k", "v", "k1", "K3"]
    rows = sorted((r[files.FILE_NAME], r[files.ROW_NUMBER], r["k"] or r["k1"], r["v"]) for r in df.collect())
    assert rows == [("a b.csv", 2, "1", "x, y"), ("a b.csv", 3, "2", 'say "hi"'), ("b%20.csv", 2, "3", "z"),
                    ("c[1].csv", 2, "4", None)]
    os.makedirs(f"{scratch}/semi")
    with open(f"{scratch}/semi/s.csv", "w") as fh:
        fh.write("a;b\n1;'x;y'\n")
    semi = files.scan_source(spark, f"{scratch}/semi", "*.csv", options={"sep": ";", "quote": "'"})
    assert tuple(semi.select("a", "b").first()) == ("1", "x;y")
    assert files.scan_source(spark, scratch, "*.csv", exclude=["b%20.csv"]).count() == 3


def test_error_line_of_a_python_task(spark):
    def fail(batches):
        raise ValueError("the cause itself")
        yield

    with pytest.raises(Exception) as caught:
        spark.range(3).mapInPandas(fail, "id long").collect()
    assert error_line(caught.value).endswith("ValueError: the cause itself")
    assert error_line(ValueError("")) == "ValueError"
    assert error_line(RuntimeError("\n one\n two")) == "RuntimeError: one"
    assert BUCKET.startswith("_")
