"""A key holding a third of the rows: the joins that stay shuffle joins are split by AQE."""

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from dimkiln.operators import facts as FX
from dimkiln.operators import scd
from dimkiln.plans import scenarios as S
from tests.conftest import SF_MID

SKEW_CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture()
def skew_conf(spark: SparkSession):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _payload(df):
    # incompressible text so the hot key's share shows in shuffle bytes too; the
    # small test file is spread over several map tasks, as a large input is
    # (AQE splits a hot partition along map outputs)
    return df.withColumn("pad", F.sha2(F.col("o_orderkey").cast("string"), 256)).repartition(8)


def test_fact_lookup_hot_customer_is_split(skew_conf):
    spark = skew_conf
    o = _payload(S.read(spark, SF_MID, "orders"))
    hot = o.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, F.lit(1))
                       .otherwise(F.col("o_custkey")))
    keys = FX.current_keys(S.customer_dim_scd2(S.read(spark, SF_MID, "customer")),
                           ["c_custkey"], "Customer_SK", scd2=True)
    j = FX.lookup_keys(hot, keys, ["o_custkey"], ["c_custkey"], "Customer_SK")
    plan = _final_plan(j)
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    assert j.filter("o_custkey = 1").count() == hot.filter("o_custkey = 1").count()


def test_scd2_merge_hot_key_versions_are_split(skew_conf):
    spark = skew_conf
    o = S.read(spark, SF_MID, "orders")
    dim = _payload(S.orders_dim_scd2(o))
    # a third of the dimension becomes history of one key
    many = (_payload(S.orders_dim_scd2(o)).filter("o_orderkey % 3 = 1")
            .withColumn("o_orderkey", F.lit(1).cast("long"))
            .withColumn("Row_Is_Current", F.lit(0)))
    res = scd.scd2_merge(dim.unionByName(many), S.orders_staging(o), S.ORDERS_SCD2, S.T1)
    plan = _final_plan(res.kept)
    assert "SortMergeJoin(skew=true)" in plan
