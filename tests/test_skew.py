"""The same queries where one device, order, product and customer hold a third of all rows."""

import duckdb
import pytest
from compare import database, differences

import __spark_entry__ as entry

NAMES = [
    "fix_is_new", "unique_visit", "user_jump", "user_jump_hourly", "visitor_stats_hourly", "order_wide_project",
    "order_wide_dims", "payment_wide_project", "dim_lookup_join", "sql_interval_join_hourly", "product_stats_hourly",
    "province_stats_monthly", "window_stats_join", "route_by_rules", "keyword_stats", "upsert_dim", "user_jump_stream",
    "order_wide_stream",
]
HOT = {
    # one user with a third of the events, at their own times
    "events": "SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id, event_type, value, props FROM t",
    "orders": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey, * EXCLUDE (o_orderkey, o_custkey) FROM t",
    "lineitem": """SELECT CASE WHEN l_orderkey % 3 = 0 THEN 7 ELSE l_orderkey END AS l_orderkey,
        CASE WHEN l_suppkey % 3 = 0 THEN 11 ELSE l_partkey END AS l_partkey, * EXCLUDE (l_orderkey, l_partkey) FROM t""",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory, small):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in "nation customer supplier part orders lineitem events documents benchmark".split():
        con.sql(f"CREATE OR REPLACE VIEW t AS SELECT * FROM read_parquet('{small}/{name}.parquet')")
        con.sql(f"COPY ({HOT.get(name, 'SELECT * FROM t')}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys(name, spark, skewed):
    con = database(skewed)
    assert differences(entry.queries()[name](spark, skewed), con, entry.oracle_sql()[name]) == []


def test_hot_device_spreads_over_tasks(spark, skewed):
    """No task of the jump query's shuffle gets the hot device whole."""
    from pyspark.sql import functions as F

    from tidemart.operators.logs import time_slots
    from tidemart.sources import driver_tables as D

    rows = D.page_log(spark, skewed).select(
        F.col("common.mid").alias("mid"), "ts", F.lit(True).alias("entry"), F.lit(1).alias("record")
    )
    slots = time_slots(rows, 10_000, 80_000).filter("mid = 'mid_1' AND own").groupBy("slot").count()
    assert slots.count() > 100
    assert slots.agg(F.max("count")).first()[0] < 10


def test_hot_id_of_a_large_dimension_is_split(spark, skewed):
    """With dimensions too large to broadcast, adaptive execution splits the hot product."""
    from tidemart.operators import joins
    from tidemart.sources import driver_tables as D

    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8192",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        # many map outputs to split by, as on a cluster
        "spark.sql.files.maxPartitionBytes": "32768",
        "spark.sql.files.openCostInBytes": "0",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    lines = D.order_detail(spark, skewed)
    want = lines.count()
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        lines = D.order_detail(spark, skewed).repartition(16)
        found = joins.dim_lookup_join(lines, D.dimensions(spark, skewed)["DIM_SKU_INFO"], "sku_id", {"price": "p"})
        assert len(found.collect()) == want
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_ids_without_adaptive_execution(spark, skewed):
    """As in the micro-batches of stateful streams: the hot product's rows are dealt out, the answer is the plain one."""
    from pyspark.sql import functions as F

    from tidemart.operators import joins
    from tidemart.sources import driver_tables as D

    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    lines = D.order_detail(spark, skewed).select("id", "sku_id").withColumn("sku_id", F.when(F.col("id") % 50 > 0, F.col("sku_id")))
    dim, fields = D.dimensions(spark, skewed)["DIM_SKU_INFO"], {"price": "p"}

    def tasks(hot):
        found = joins.dim_lookup_join(lines, dim, "sku_id", fields, hot=hot)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        return sorted(map(str, found.collect())), sorted(sizes)

    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        hot = joins.hot_ids(lines, ["sku_id"])
        plain, skew = tasks(None)
        split, even = tasks(hot)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "11" in hot["sku_id"] and len(hot["sku_id"]) < 16
    assert split == plain and skew[-1] > 3 * skew[len(skew) // 2]
    assert even[-1] < 2 * even[len(even) // 2]
