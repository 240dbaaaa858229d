"""Pipelines end to end (R-01..R-05) with sources, sinks and audit tables in a scratch folder."""

import os
import shutil
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from dimkiln.operators import dedup as D
from dimkiln.plans import pipeline as PL
from dimkiln.sinks import store
from dimkiln.sinks.buckets import BucketTable
from dimkiln.sources import bulk_log, files
from dimkiln.spec import DimensionSpec, spec_from_mapping
from tests.conftest import SF_SMALL

RUN1 = "2024-02-01 00:00:00"
RUN2 = "2024-02-02 00:00:00"

PLACES_MAPPING = [  # FIXTURES §1 sample plus two columns of our own
    {"Source_Name": "Places", "Source_Column": "Place code", "Target_Column": "Place_Code",
     "Data_Type": "VARCHAR(50)", "Is_PK": "1", "Is_Type2_Attribute": "0", "Is_Required": "1",
     "File_Mapping_SK": 1},
    {"Source_Name": "Places", "Source_Column": "Place Name", "Target_Column": "Place_Name",
     "Data_Type": "VARCHAR(200)", "Is_PK": "0", "Is_Type2_Attribute": "0", "Is_Required": "1",
     "File_Mapping_SK": 2},
    {"Source_Name": "Places", "Source_Column": "Inserted_Datetime", "Target_Column": "Inserted_Datetime",
     "Data_Type": "DATETIME", "Is_PK": "0", "Is_Type2_Attribute": "0", "Is_Required": "0",
     "File_Mapping_SK": 3},
]


def test_spec_from_mapping_drops_reserved(spark):
    spec = spec_from_mapping("Places", spark.createDataFrame(PLACES_MAPPING))
    assert spec.keys == ("Place_Code",) and spec.type1 == ("Place_Name",) and not spec.is_scd2
    assert spec.source_columns == {"Place code": "Place_Code", "Place Name": "Place_Name"}


def test_duplicates_case_from_reference_tests(spark):
    # FIXTURES §3: Place_Code [1,1,2] -> both key-1 rows logged, first kept
    df = spark.createDataFrame([("1", "A", "f.parquet", 2), ("1", "A", "f.parquet", 3),
                                ("2", "B", "f.parquet", 4)],
                               "Place_Code string, Place_Name string, _file_name string, _row_number long")
    order = ["_file_name", "_row_number"]
    dups = D.duplicate_rows(df, ["Place_Code"], order).collect()
    assert sorted((r["_row_number"], r["was_kept"]) for r in dups) == [(2, True), (3, False)]
    first = D.dedup_first(df, ["Place_Code"], order).collect()
    assert sorted((r["Place_Code"], r["_row_number"]) for r in first) == [("1", 2), ("2", 4)]


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, r long")
    assert D.duplicate_rows(df, ["k"], ["r"]).count() == 2
    assert D.dedup_first(df, ["k"], ["r"]).count() == 2


def _write_places(spark, folder, rows, name):
    spark.createDataFrame(rows, "`Place code` string, `Place Name` string, Extra string") \
        .coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")
    part = [f for f in os.listdir(f"{folder}/{name}") if f.endswith(".parquet")][0]
    os.replace(f"{folder}/{name}/{part}", f"{folder}/{name}.parquet")


def _sources(spark):
    return spark.createDataFrame(
        [(1, "Places", "raw/Places", "*.parquet", None, "[ODS].[Places]", "1.4", "1", "0",
          "[DW].[Dim_Places]", None, "0"),
         (2, "Ghost", "raw/Ghost", "*.parquet", None, "[ODS].[Ghost]", "2.0", "1", "0",
          "[DW].[Dim_Ghost]", None, "0")],
        "Source_Import_SK long, Source_Name string, Rel_Path string, Pattern string, Sheet_Name string, "
        "Staging_Table string, Processing_Order string, Is_Active string, Is_Deleted string, "
        "DW_Table_Name string, Merge_Proc_Name string, Force_DDL_Generation string")


def test_run_sources_end_to_end(spark, scratch):
    data = f"{scratch}/data/raw/Places"
    os.makedirs(data)
    _write_places(spark, data, [("P1", "Alpha\n", "x"), ("P1", "Alpha dup", "x"),
                                ("P2", "Beta\\two", "y")], "a")
    _write_places(spark, data, [("P3", "Gamma", "z"), ("", "No key", "z")], "b")
    layout = PL.Layout(f"{scratch}/wh")
    spec = spec_from_mapping("Places", spark.createDataFrame(PLACES_MAPPING))

    rep = PL.run_sources(spark, layout, _sources(spark), {"Places": spec}, RUN1,
                         f"{scratch}/data", audit_id=7)
    # Places loads; Ghost has no mapping -> the run fails there and stops (R-01, D-9)
    assert rep.sources == ["Places"] and rep.status == "Failed" and "Ghost" in rep.error
    c = rep.counts["Places"]
    assert (c["Inserted_Count"], c["files"], c["rows"]) == (3, 2, 5)

    dim = BucketTable(spark, layout.dimension("Places")).read()
    got = {r["Place_Code"]: r["Place_Name"] for r in dim.collect()}
    assert got == {"P1": "Alpha", "P2": "Beta two", "P3": "Gamma"}     # sanitized, first kept
    rej = spark.read.parquet(layout.rejects).collect()
    reasons = sorted(r["Rejected_Reason"] for r in rej)
    assert reasons == ["DUPLICATE_RECORD: PK Place_Code=P1"] * 2 + ["NULL_KEY: Place_Code"]
    assert {r["Row_Number"] for r in rej if r["Rejected_Reason"].startswith("DUP")} == {2, 3}
    audit = spark.read.parquet(layout.audit)
    assert sorted(r["Process_Status"] for r in audit.collect()) == ["Failed", "Running"]
    assert spark.read.parquet(layout.errors).first()["Source_Name"] == "Ghost"
    lineage = spark.read.parquet(layout.lineage).select("Original_File_Name", "File_Row_Count")
    assert sorted(tuple(r) for r in lineage.collect()) == [("a.parquet", 3), ("b.parquet", 2)]
    csv = spark.read.option("header", True).csv(layout.reject_csv("Places"))
    assert csv.columns == ["Inserted_Datetime", "Rejected_Reason", "Raw_Data"] and csv.count() == 3

    # second run with the same files: nothing changes (idempotent), no bucket is written
    rep2 = PL.run_sources(spark, layout, _sources(spark), {"Places": spec}, RUN2,
                          f"{scratch}/data", audit_id=8, requested=["Places"])
    c2 = rep2.counts["Places"]
    assert rep2.status == "Success"
    assert sum(c2[k] for k in ("Inserted_Count", "Updated_Count", "Deleted_Count",
                               "Reactivated_Count", "Expired_Count")) == 0
    assert BucketTable(spark, layout.dimension("Places")).version() == 2
    assert PL.next_audit_id(spark, layout) == 9


def test_refresh_metadata_skipped_without_sheets(spark, scratch):
    rep = PL.refresh_metadata(spark, PL.Layout(scratch), RUN1, 1, workbook_dir=f"{scratch}/none")
    assert rep.status == "Skipped"
    assert spark.read.parquet(f"{scratch}/etl/Fact_Audit_Source_Imports").first()["Process_Status"] == "Skipped"


def test_refresh_metadata_from_workbook(spark, scratch):
    from dimkiln.operators.metadata import MAPPING_COLUMNS, SOURCE_IMPORTS_COLUMNS
    from tests.workbooks import write_workbook
    cfg = f"{scratch}/config"
    os.makedirs(cfg)
    imports = [["Places", "raw/Places", "*.parquet", None, "[ODS].[Places]", "1.4", "1", "places ",
                "[DW].[Dim_Places]", None, "0"],
               ["Source_Imports", "config", "*.xlsx", None, "[ETL].[Source_Imports]", "0", "1", None,
                "[ETL].[Dim_Source_Imports]", None, "0"]]
    mapping = [["Places", "Place code", "Place_Code", "VARCHAR(50)", None, "0", "1", "1", "x"],
               ["Places", "Place  Name", "Place_Name", "VARCHAR(200)", "the\tname", "0", "0", "1", "x"],
               ["Places", "Zone", "Zone_Code", "INT", None, "0", "0", "0", "x"]]
    with open(f"{cfg}/etl_config.xlsx", "wb") as fh:
        fh.write(write_workbook({"Source_Imports": (SOURCE_IMPORTS_COLUMNS, imports),
                                 "Source_File_Mapping": (list(MAPPING_COLUMNS) + ["Extra_Column"], mapping)}))
    layout = PL.Layout(f"{scratch}/wh")
    T = __import__("datetime").datetime(2024, 1, 1)
    old = spark.createDataFrame([(5, "P1", "Alpha", T, None, 0, "NEW")],
                                "Places_SK long, Place_Code string, Place_Name string, "
                                "Inserted_Datetime timestamp_ntz, Updated_Datetime timestamp_ntz, "
                                "Is_Deleted int, Row_Change_Reason string")
    BucketTable(spark, layout.dimension("Places")).write(old, ["Place_Code"])

    rep = PL.refresh_metadata(spark, layout, RUN1, 5, workbook_dir=cfg, pattern="etl_config.xlsx")
    assert rep.status == "Success" and rep.sources == ["Places"]
    assert rep.counts["Source_File_Mapping"]["Inserted_Count"] == 3
    rebuilt = BucketTable(spark, layout.dimension("Places")).read()
    assert "Zone_Code" in rebuilt.columns and rebuilt.first()["Places_SK"] == 5
    mdim = store.SnapshotTable(spark, f"{layout.root}/etl/Dim_Source_Imports_Mapping").read()
    assert "Extra_Column" not in mdim.columns
    assert {r["Source_Column"] for r in mdim.collect()} == {"Place code", "Place Name", "Zone"}

    rep2 = PL.refresh_metadata(spark, layout, RUN2, 6, workbook_dir=cfg, pattern="etl_config.xlsx")
    assert rep2.sources == [] and sum(rep2.counts["Source_File_Mapping"].values()) == 0


def test_unreadable_file_is_logged_and_skipped(spark, scratch):
    data = f"{scratch}/data/raw/Places"
    os.makedirs(data)
    _write_places(spark, data, [("P1", "Alpha", "x")], "a")
    with open(f"{data}/zz_broken.parquet", "wb") as fh:
        fh.write(b"not parquet at all")
    layout = PL.Layout(f"{scratch}/wh")
    spec = spec_from_mapping("Places", spark.createDataFrame(PLACES_MAPPING))
    rep = PL.run_sources(spark, layout, _sources(spark), {"Places": spec}, RUN1,
                         f"{scratch}/data", audit_id=9, requested=["Places"])
    assert rep.status == "Success" and rep.counts["Places"]["Inserted_Count"] == 1
    rej = spark.read.parquet(layout.rejects).collect()
    assert [(r["File_Name"], r["Row_Number"]) for r in rej] == [("zz_broken.parquet", 0)]
    assert rej[0]["Rejected_Reason"].startswith("PROCESSING_ERROR: ")


def test_scan_fallback_and_empty(spark, scratch):
    assert files.resolve_pattern(spark, SF_SMALL, "nothing*.csv") is None
    empty = files.scan_source(spark, scratch, "*.parquet")
    assert empty.columns == [] and empty.count() == 0
    assert files.source_defaults(float("nan"), "  ") == ("*.xlsx", "Sheet1")


def test_probe_reports_unreadable_files(spark, scratch):
    with open(f"{scratch}/broken.parquet", "wb") as fh:
        fh.write(b"not parquet")
    rows = files.probe_files(spark, scratch, "*.parquet", source_name="S").collect()
    assert len(rows) == 1 and rows[0]["Rejected_Reason"].startswith("PROCESSING_ERROR: ")
    assert rows[0]["Row_Number"] == 0


def test_probe_reads_no_bytes_of_sound_files(spark, scratch):
    spark.range(1000).coalesce(1).write.parquet(f"{scratch}/made")
    part = next(f for f in os.listdir(f"{scratch}/made") if f.endswith(".parquet"))
    os.mkdir(f"{scratch}/in")
    shutil.copy(f"{scratch}/made/{part}", f"{scratch}/in/sound.parquet")
    limit = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(limit, "10")
    try:
        assert files.probe_files(spark, f"{scratch}/in", "*.parquet", source_name="S").collect() == []
        with open(f"{scratch}/in/a [1] {{b}}.parquet", "wb") as fh:
            fh.write(b"broken")
        rows = files.probe_files(spark, f"{scratch}/in", "*.parquet", source_name="S").collect()
    finally:
        spark.conf.unset(limit)
    assert [unquote(r["File_Name"]) for r in rows] == ["a [1] {b}.parquet"]


def test_bulk_log_reader(spark, scratch):
    with open(f"{scratch}/bcp_1.log", "w") as fh:
        fh.write("\n@ header\nSQLState = 22001\n row 3: string data truncated \n\n")
    logs = bulk_log.read_logs(spark, scratch)
    out = bulk_log.log_rejects(logs, "text", ["File_Name"]).collect()
    assert [(r["Line_Number"], r["Rejected_Reason"]) for r in out] == [
        (3, "BCP_REJECTED: row 3: string data truncated")]
    full = bulk_log.log_reject_rows(logs, "text", "Places", 4).collect()
    assert [(r["Row_Number"], r["File_Name"]) for r in full] == [(3, "bcp_1.log")]
    assert full[0]["Raw_Data"] == ('{"error_line":3,"bcp_error":"row 3: string data truncated",'
                                   '"file_name":"bcp_1.log"}')


def test_sinks_text_export_and_snapshot(spark, scratch):
    df = spark.createDataFrame([("a", None), ("b", "c")], "x string, y string")
    store.export_staging_text(df, f"{scratch}/txt")
    raw = b"".join(open(f"{scratch}/txt/{f}", "rb").read() for f in sorted(os.listdir(f"{scratch}/txt"))
                   if f.startswith("part-"))
    assert sorted(raw.split(b"\r\n")[:-1]) == [b"a\t", b"b\tc"]
    t = store.SnapshotTable(spark, f"{scratch}/dim")
    assert t.read() is None
    t.write(df)
    t.write(df.filter(F.col("x") == "a"))
    assert t.read().count() == 1 and t.current_path().endswith("v000002")


def test_xlsx_source_through_pipeline(spark, scratch):
    from dimkiln.sources.xlsx import parse_xlsx
    from tests.workbooks import write_xlsx_bytes
    data = f"{scratch}/data/raw/Places"
    os.makedirs(data)
    with open(f"{data}/p1.xlsx", "wb") as fh:
        fh.write(write_xlsx_bytes(["Place code", "Place Name"], [["P1", "Alpha"], [7, "Seven"], ["P1", "Again"]]))
    with open(f"{data}/p2.xlsx", "wb") as fh:
        fh.write(write_xlsx_bytes(["Place Name", "Place code"], [["Beta  two", "P2"]]))
    header, rows = parse_xlsx(open(f"{data}/p1.xlsx", "rb").read(), "Sheet1")
    assert header == ["Place code", "Place Name"] and rows[1] == (3, ["7", "Seven"])
    src = _sources(spark).filter("Source_Name = 'Places'").withColumn("Pattern", F.lit("*.xlsx"))
    spec = spec_from_mapping("Places", spark.createDataFrame(PLACES_MAPPING))
    layout = PL.Layout(f"{scratch}/wh")
    rep = PL.run_sources(spark, layout, src, {"Places": spec}, RUN1, f"{scratch}/data", audit_id=3)
    assert rep.status == "Success"
    dim = BucketTable(spark, layout.dimension("Places")).read()
    assert {r["Place_Code"]: r["Place_Name"] for r in dim.collect()} == {
        "P1": "Alpha", "7": "Seven", "P2": "Beta two"}
    rej = spark.read.parquet(layout.rejects).select("File_Name", "Row_Number").collect()
    assert sorted(tuple(r) for r in rej) == [("p1.xlsx", 2), ("p1.xlsx", 4)]


def test_duplicates_with_equal_payload_and_a_dominant_key(spark):
    rows = [("k", "a", 2), ("k", "a", 3), ("k", "b", 4), ("x", "c", 5)]
    df = spark.createDataFrame(rows, "k string, v string, r long")
    got = D.duplicate_rows(df, ["k"], ["v", "r"]).collect()
    assert sorted((r["r"], r["dup_count"], r["was_kept"]) for r in got) == [(2, 3, True), (3, 3, False), (4, 3, False)]
    # one key holds a third of the rows: all its members come back, one of them kept
    big = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("r"))
    hot = D.duplicate_rows(big.repartition(8), ["k"], ["r"])
    assert (hot.count(), hot.filter("was_kept").count(), hot.filter("was_kept").first()["r"]) == (10000, 1, 0)


def test_rows_that_tie_for_first_stop_the_job(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "c")], "k int, v string")
    with pytest.raises(Exception, match="tie for first"):
        D.duplicate_rows(df, ["k"], ["v"]).collect()
    # a tie behind the first row does no harm
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b")], "k int, v string")
    assert D.duplicate_rows(df, ["k"], ["v"]).filter("was_kept").count() == 1


def _run_places(spark, scratch, requested=("Places",), audit_id=1, spec=None, pattern="*.parquet"):
    spec = spec or spec_from_mapping("Places", spark.createDataFrame(PLACES_MAPPING))
    layout = PL.Layout(f"{scratch}/wh")
    src = _sources(spark).withColumn("Pattern", F.lit(pattern))
    return layout, PL.run_sources(spark, layout, src, {"Places": spec}, RUN1, f"{scratch}/data",
                                  audit_id=audit_id, requested=list(requested))


def test_keys_equal_after_typing_or_under_a_collation_are_one(spark, scratch):
    for name, key_type, collation, keys in (("n", "BIGINT", None, ("1", "01")),
                                            ("c", "VARCHAR(10)", "UTF8_LCASE_RTRIM", ("ab", "AB"))):
        data = f"{scratch}/{name}/data/raw/Places"
        os.makedirs(data)
        _write_places(spark, data, [(keys[0], "first", "x"), (keys[1], "second", "x")], "a")
        spec = DimensionSpec("Places", keys=("Place_Code",), type1=("Place_Name",), collation=collation,
                             types={"Place_Code": key_type, "Place_Name": "VARCHAR(200)"},
                             source_columns={"Place code": "Place_Code", "Place Name": "Place_Name"})
        for run in (1, 2):
            layout, rep = _run_places(spark, f"{scratch}/{name}", audit_id=run, spec=spec)
            assert rep.status == "Success", rep.error
            dim = BucketTable(spark, layout.dimension("Places")).read()
            assert [r["Place_Name"] for r in dim.collect()] == ["first"]
        reasons = {r["Rejected_Reason"] for r in spark.read.parquet(layout.rejects).collect()}
        assert reasons == {f"DUPLICATE_RECORD: PK Place_Code={k}" for k in keys}     # the raw text stays


def test_orc_source_and_all_files_unreadable(spark, scratch):
    data = f"{scratch}/data/raw/Places"
    os.makedirs(data)
    spark.createDataFrame([("P1", "Alpha")], "`Place code` string, `Place Name` string").coalesce(1) \
        .write.mode("append").orc(data)
    layout, rep = _run_places(spark, scratch, pattern="*.orc")
    assert (rep.status, rep.counts["Places"]["Inserted_Count"]) == ("Success", 1)
    bad = f"{scratch}/bad/data/raw/Places"
    os.makedirs(bad)
    with open(f"{bad}/a.parquet", "wb") as fh:
        fh.write(b"not parquet")
    layout, rep = _run_places(spark, f"{scratch}/bad")
    assert rep.status == "Failed" and "none of the 1 files" in rep.error
    assert [r["File_Name"] for r in spark.read.parquet(layout.rejects).collect()] == ["a.parquet"]


def test_one_corrupt_workbook_of_two(spark, scratch):
    from tests.workbooks import write_xlsx_bytes
    data = f"{scratch}/data/raw/Places"
    os.makedirs(data)
    with open(f"{data}/a.xlsx", "wb") as fh:
        fh.write(write_xlsx_bytes(["Place code", "Place Name"], [["P1", "Alpha"]]))
    with open(f"{data}/b.xlsx", "wb") as fh:
        fh.write(b"PK broken")
    layout, rep = _run_places(spark, scratch, pattern="*.xlsx")
    assert (rep.status, rep.counts["Places"]["Inserted_Count"]) == ("Success", 1), rep.error
    rej = spark.read.parquet(layout.rejects).collect()
    assert [(r["File_Name"], r["Row_Number"]) for r in rej] == [("b.xlsx", 0)]


def test_workbook_without_the_key_column_and_late_columns(spark, scratch):
    from dimkiln.sources.xlsx import read_xlsx
    from tests.workbooks import write_xlsx_bytes
    data = f"{scratch}/data/raw/Places"
    os.makedirs(data)
    with open(f"{data}/a.xlsx", "wb") as fh:
        fh.write(write_xlsx_bytes(["Place Name"], [["Alpha"]]))
    _, rep = _run_places(spark, scratch, pattern="*.xlsx")
    assert rep.status == "Failed" and "missing" in rep.error
    with open(f"{data}/b.xlsx", "wb") as fh:
        fh.write(write_xlsx_bytes(["Place Name", "z"], [["Beta", "9"]]))
    assert read_xlsx(spark, data).filter("z = '9'").count() == 1


def test_csv_files_are_read_by_name(spark, scratch):
    for name, text in (("a", "k,v\n1,a\n"), ("b", "v,k\nb,2\n"), ("c", "k\n3\n")):
        with open(f"{scratch}/{name}.csv", "w") as fh:
            fh.write(text)
    got = files.scan_source(spark, scratch, "*.csv").select("k", "v", files.FILE_NAME, files.ROW_NUMBER).collect()
    assert sorted(tuple(r) for r in got) == [("1", "a", "a.csv", 2), ("2", "b", "b.csv", 2), ("3", None, "c.csv", 2)]


def test_unknown_request_fails_and_errors_read_well(spark, scratch):
    os.makedirs(f"{scratch}/data")
    _, rep = _run_places(spark, scratch, requested=["Typo"])
    assert (rep.status, rep.sources) == ("Failed", []) and "Typo" in rep.error
    from dimkiln.functions.text import error_line
    assert error_line(ValueError("\n  first\nsecond\n\n")) == "ValueError: first"
    assert error_line(KeyError()) == "KeyError"


def test_audit_row_has_the_merge_counts(spark, scratch):
    data = f"{scratch}/data/raw/Places"
    os.makedirs(data)
    _write_places(spark, data, [("P1", "Alpha", "x"), ("P2", "Beta", "x")], "a")
    layout, rep = _run_places(spark, scratch)
    row = spark.read.parquet(layout.audit).filter("Process_Status = 'Success'").first()
    assert (row["Inserted_Count"], row["Total_Row_Count"], row["Total_File_Count"]) == (2, 2, 1)


def test_a_snapshot_with_two_active_rows_of_a_key_is_not_committed(spark, scratch):
    from dimkiln.operators.keys import check_active_keys
    t = store.SnapshotTable(spark, f"{scratch}/dim")
    good = spark.createDataFrame([(1, 0)], "k int, Is_Deleted int")
    t.write(good)
    with pytest.raises(ValueError):
        t.write(good.union(good), validate=lambda rows: check_active_keys(rows, ["k"], False))
    assert t.read().count() == 1


def test_rebuild_rejects_what_does_not_fit(spark):
    from dimkiln.operators.evolve import split_rebuild
    old = spark.createDataFrame([(1, "a", "7"), (2, "b", "abc")], "D_SK long, k string, n string")
    spec = DimensionSpec("D", keys=("k",), type1=("n",), types={"k": "VARCHAR(5)", "n": "INT"})
    fit, unfit = split_rebuild(old, spec, RUN1)
    assert [(r["D_SK"], r["n"]) for r in fit.collect()] == [(1, 7)]
    assert [r["Rejected_Reason"] for r in unfit.collect()] == ["TYPE_ERROR: n='abc' is not INT"]


def test_old_snapshots_are_dropped(spark, scratch):
    t = store.SnapshotTable(spark, f"{scratch}/dim")
    for n in range(4):
        t.write(spark.range(n + 1))
    assert store.drop_snapshots(t, keep=2) == ["v000001", "v000002"] and t.read().count() == 4


def test_fact_load_strategies(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "m int, p string")
    path = f"{scratch}/fact"
    store.load_fact(df, path, "append", ["p"])
    store.load_fact(df, path, "append", ["p"])
    assert spark.read.parquet(path).count() == 4
    store.load_fact(df.filter("p = 'a'"), path, "replace_partitions", ["p"])
    assert spark.read.parquet(path).count() == 3
    store.load_fact(df.filter("p = 'b'"), path, "truncate", ["p"])
    assert spark.read.parquet(path).count() == 1


def test_snapshot_survives_a_crashed_write(spark, scratch):
    t = store.SnapshotTable(spark, f"{scratch}/dim")
    df = spark.createDataFrame([("a",)], "x string")
    t.write(df)
    os.makedirs(f"{scratch}/dim/v000002")          # left behind by a crashed attempt
    with open(f"{scratch}/dim/v000002/part-0.parquet", "wb") as fh:
        fh.write(b"partial")
    assert t.read().count() == 1                   # readers still see the committed snapshot
    path = t.write(df.union(df))
    assert path.endswith("v000003") and t.read().count() == 2


def test_csv_row_numbers_across_splits(spark, scratch):
    src = f"{scratch}/csv"
    os.makedirs(src)
    expected = {}
    for f, n in (("a.csv", 700), ("b.csv", 45)):
        with open(f"{src}/{f}", "w") as fh:
            fh.write("code,name\n")
            for i in range(n):
                fh.write(f"K{i % 97},row {i} of {f}\n")
        expected[f] = list(range(2, n + 2))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")    # several splits per file
    try:
        df = files.scan_source(spark, src, "*.csv")
        rows = df.select("name", files.FILE_NAME, files.ROW_NUMBER).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for f in expected:
        got = sorted((r[files.ROW_NUMBER], r["name"]) for r in rows if r[files.FILE_NAME] == f)
        assert [g[0] for g in got] == expected[f]
        assert all(name == f"row {num - 2} of {f}" for num, name in got)


def test_small_public_helpers(spark, scratch):
    from dimkiln.functions.flags import as_bit
    from dimkiln.operators import facts as FX
    from dimkiln.operators import metadata as M
    df = spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "2024-03-01 00:00:00")],
                               "k int, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    mark = FX.next_high_water_mark(df, "t").first()["High_Water_Mark"]
    assert str(mark) == "2024-03-01 00:00:00"
    assert FX.incremental(df, "t", "2024-02-01 00:00:00").count() == 1
    df.write.parquet(f"{scratch}/t")
    assert files.read_table(spark, f"{scratch}/t", ["k"]).columns == ["k"]
    assert [r[0] for r in df.select(as_bit(F.col("k") > 1)).orderBy(F.col("k")).collect()] == [0, 1]
    src = spark.createDataFrame([("A", "[ODS].[A]", "[DW].[Dim_A]", None, None)],
                                "Source_Name string, Staging_Table string, DW_Table_Name string, "
                                "Merge_Proc_Name string, Source_Import_SK long")
    row = M.source_lookup(src).first()
    assert (row["Merge_Proc_Name"], row["Source_Import_SK"]) == ("ETL.SP_Merge_Dim_A", 0)
    mapping = spark.createDataFrame(PLACES_MAPPING)
    assert M.spec_columns_from(mapping, "Places")["Place code"] == "Place_Code"


def test_json_lines_row_numbers(spark, scratch):
    src = f"{scratch}/json"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as fh:
        for i in range(300):
            fh.write('{"code": "K%d", "note": "line %d"}\n' % (i % 50, i))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        rows = files.scan_source(spark, src, "*.json").select("note", files.ROW_NUMBER).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = sorted((r[files.ROW_NUMBER], r["note"]) for r in rows)
    assert got == [(i + 1, f"line {i}") for i in range(300)]
