"""Incremental file stream (X-03) and the physical plans the operators produce."""

import os
import re
import shutil

from dimkiln.plans import catalog as C
from pyspark.sql import functions as F

from dimkiln.streaming.incremental import incremental_stream, read_loaded
from tests.conftest import SF_MID, SF_SMALL


def test_stream_picks_up_only_new_files(spark, scratch):
    src = f"{scratch}/in"
    os.makedirs(src)
    shutil.copy(f"{SF_SMALL}/lineitem.parquet", f"{src}/a.parquet")
    schema = spark.read.parquet(f"{src}/a.parquet").schema
    target, ckpt = f"{scratch}/out", f"{scratch}/ckpt"
    incremental_stream(spark, src, schema, "l_shipdate", "2000-01-01 00:00:00", target,
                       checkpoint_location=ckpt)
    first = read_loaded(spark, target).count()
    shutil.copy(f"{SF_SMALL}/lineitem.parquet", f"{src}/b.parquet")
    incremental_stream(spark, src, schema, "l_shipdate", "2000-01-01 00:00:00", target,
                       checkpoint_location=ckpt)
    assert read_loaded(spark, target).count() == 2 * first > 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cartesian_or_nested_loop_anywhere(spark):
    for name, fn in C.QUERIES.items():
        if name == "fact_incremental_stream":
            continue
        plan = _plan(fn(spark, SF_SMALL))
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_dedup_is_partial_aggregate_not_window(spark):
    plan = _plan(C.QUERIES["dedup_first"](spark, SF_MID))
    assert "Window" not in plan
    assert "SortAggregate" in plan or "ObjectHashAggregate" in plan or "HashAggregate" in plan
    assert plan.count("Exchange hashpartitioning") == 1          # one shuffle of the rows


def test_scan_prunes_and_pushes(spark):
    agg = C.QUERIES["fact_aggregate"](spark, SF_MID)
    agg.collect()
    plan = _plan(agg)
    assert "l_orderkey" not in plan.split("ReadSchema")[1].split("\n")[0]
    inc = _plan(C.QUERIES["fact_incremental"](spark, SF_MID))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThan(l_shipdate" in inc


def test_duplicate_rows_moves_no_row_while_the_key_table_is_small(spark):
    plan = _plan(C.QUERIES["duplicate_rows"](spark, SF_MID))
    assert "Window" not in plan and "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_staged_load_scans_once_and_exchanges_at_most_once(spark):
    plan = _plan(C.lineitem_load(spark, SF_MID).staging)
    # one scan of the rows, one of the duplicate keys found before
    assert plan.count("FileScan parquet") == 2
    assert plan.count("Exchange hashpartitioning") <= 1


def test_reject_counts_shuffle_keys_only(spark):
    plan = _plan(C.QUERIES["reject_counts"](spark, SF_MID))
    assert "l_partkey" not in plan and "Join" not in plan


def test_two_loads_into_one_table_both_stay(spark, scratch):
    src = f"{scratch}/in"
    os.makedirs(src)
    shutil.copy(f"{SF_SMALL}/lineitem.parquet", f"{src}/a.parquet")
    schema = spark.read.parquet(f"{src}/a.parquet").schema
    for n in (1, 2):
        incremental_stream(spark, src, schema, "l_shipdate", "2000-01-01 00:00:00", f"{scratch}/out",
                           f"{scratch}/ckpt{n}")
        assert read_loaded(spark, f"{scratch}/out").count() % n == 0
    one = spark.read.parquet(f"{src}/a.parquet").filter("l_shipdate > '2000-01-01'").count()
    assert read_loaded(spark, f"{scratch}/out").count() == 2 * one


def test_stored_mark_makes_a_repeated_load_a_no_op(spark, scratch):
    from dimkiln.streaming.incremental import load_increment
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "k int, t string") \
        .withColumn("t", F.col("t").cast("timestamp_ntz"))
    for rows, n in ((df.filter("k = 1"), 1), (df, 2), (df, 2)):
        load_increment(spark, rows, "t", f"{scratch}/fact", f"{scratch}/state", "f")
        assert read_loaded(spark, f"{scratch}/fact").count() == n


def test_line_load_leaves_no_method_that_is_never_compiled(spark):
    """HotSpot interprets methods above 8000 bytes of code: such a stage must be above the session's limit."""
    from dimkiln.operators import typed_load
    from dimkiln.plans import scenarios
    from dimkiln.session import tune
    from dimkiln.sources.files import scan_source
    text = scan_source(tune(spark), "/root/testdata/sf0.001", "lineitem.parquet")
    checked = typed_load.check_rows(text, scenarios.LINEITEM_PIPELINE)
    stages = str(checked._jdf.queryExecution().debug().codegenToSeq())
    sizes = [int(n) for n in re.findall(r"ByteCodeStats\((\d+),", stages)]
    limit = int(spark.conf.get("spark.sql.codegen.hugeMethodLimit"))
    assert sizes and not [n for n in sizes if 8000 < n <= limit]
