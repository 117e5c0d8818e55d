"""Physical plan checks: join strategy, two-step aggregates, pushdown, no Python."""

import datetime as dt


from apiary.operators import joins
from apiary.plans import catalog
from apiary.plans import testbed as tb
from apiary.session import work_path
from support import SF_SMALL, plan_text


def test_hive_average_plan(spark):
    df = catalog.hive_average(spark, SF_SMALL)
    df.collect()
    plan = plan_text(df)
    assert "BroadcastHashJoin" in plan
    assert "partial_count" in plan and "partial_sum" in plan
    assert "PushedFilters" in df._jdf.queryExecution().executedPlan().toString() or "Scan parquet" in plan
    for python_node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF"):
        assert python_node not in plan


def test_scan_reads_only_needed_columns(spark):
    df = catalog.hive_count_sum(spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in text or (
        "props" not in text and "event_id" not in text
    )


def test_partition_pruning_on_stored_table(spark):
    r = tb.readings(spark, SF_SMALL).drop("event_id")
    path = work_path(spark, "t-plan")
    r.write.partitionBy("bucket_date").parquet(path)
    stored = spark.read.parquet(path)
    df = joins.sensor_day_join(stored, tb.sensors(spark, SF_SMALL), as_of=dt.date(2024, 1, 30))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket_date" in text
    assert df.count() == catalog.sensor_day_join(spark, SF_SMALL).count()


def test_range_lookup_is_an_equi_join(spark):
    df = catalog.range_lookup_query(spark, SF_SMALL)
    df.collect()
    plan = plan_text(df)
    assert "BroadcastHashJoin" in plan and "BroadcastNestedLoopJoin" not in plan


def test_time_filter_reaches_the_scan(spark):
    df = catalog.subday_average(spark, SF_SMALL)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts)" in text or "GreaterThanOrEqual(ts" in text


def test_no_python_in_any_query(spark):
    for name, fn in catalog.QUERIES.items():
        if name.startswith("stream_") or name == "upsert_readings":
            continue
        plan = fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan, name
        # no cross joins anywhere: every join has an equality key
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_fallback_join_shuffles_and_salts(spark):
    r = tb.readings(spark, SF_SMALL)
    s = tb.sensors(spark, SF_SMALL)
    df = joins.sensor_day_join(r, s, as_of="2024-01-30", max_broadcast_rows=10, salt_buckets=8)
    n = df.count()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in text
    assert n == joins.sensor_day_join(r, s, as_of="2024-01-30").count()


def test_spread_only_narrow_inputs(spark):
    from apiary.operators.strategy import spread

    narrow = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    assert narrow.rdd.getNumPartitions() == 1
    assert spread(narrow).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        assert spread(narrow) is narrow
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_keyed_join_prunes_partitions(spark):
    from apiary.operators import topology

    r = tb.readings(spark, SF_SMALL).drop("event_id")
    path = work_path(spark, "t-plan-keyed")
    r.write.partitionBy("bucket_date").parquet(path)
    stored = spark.read.parquet(path)
    daily = topology.daily_topology(tb.sensors(spark, SF_SMALL), as_of="2024-01-30")
    df = joins.join_daily_topology(stored, daily)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket_date" in text and "2024-01-23" in text
    assert df.count() == catalog.sensor_day_join(spark, SF_SMALL).count()


def test_bucketed_tables_join_without_exchange(spark):
    from apiary.operators.aggregate import hive_average
    from apiary.sources.bucketed import read_bucketed, save_bucketed

    r = tb.readings(spark, SF_SMALL).drop("event_id")
    s = tb.sensors(spark, SF_SMALL)
    save_bucketed(r, "t_readings_b", work_path(spark, "t-bucketed"), 4, partition_by=["bucket_date"])
    save_bucketed(s, "t_sensors_b", work_path(spark, "t-bucketed"), 4)
    readings, sensors = read_bucketed(spark, "t_readings_b"), read_bucketed(spark, "t_sensors_b")
    # the large-large path: neither our check nor Spark's size estimate may broadcast
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.sensor_day_join(readings, sensors, as_of="2024-01-30", max_broadcast_rows=1, salt_buckets=1)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        got = sorted(hive_average(joined).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = sorted(catalog.hive_average(spark, SF_SMALL).collect())
    assert got == want
