import datetime as dt

from pyspark.sql import types as T

from apiary.operators.upsert import latest_per_key, read_latest, read_table, upsert_partitions
from apiary.session import work_path

SCHEMA = "k string, t timestamp, v double, seq long, d date"


def batch(spark, rows):
    return spark.createDataFrame(
        [(k, dt.datetime(2024, 1, day, 1), v, seq, dt.date(2024, 1, day)) for k, day, v, seq in rows], SCHEMA
    )


def table(spark, path):
    return {(r.k, r.d.day): (r.v, r.seq) for r in read_table(spark, path, batch(spark, []).schema).collect()}


def test_latest_per_key_hot_key(spark):
    rows = [("hot", 1, float(i), i) for i in range(500)] + [("cold", 1, 1.0, 1)]
    out = latest_per_key(batch(spark, rows).repartition(8), ["k", "t"], ["seq"]).collect()
    assert {(r.k, r.v) for r in out} == {("hot", 499.0), ("cold", 1.0)}


def test_upsert_newest_wins_and_other_days_stay(spark):
    path = work_path(spark, "test-tables")
    upsert_partitions(batch(spark, [("a", 1, 1.0, 1), ("b", 2, 2.0, 2)]), path, ["k", "t"], ["seq"], "d")
    upsert_partitions(batch(spark, [("a", 1, 10.0, 5), ("a", 1, 9.0, 4)]), path, ["k", "t"], ["seq"], "d")
    assert table(spark, path) == {("a", 1): (10.0, 5), ("b", 2): (2.0, 2)}
    # an older copy arriving late does not win
    upsert_partitions(batch(spark, [("a", 1, 0.0, 3)]), path, ["k", "t"], ["seq"], "d")
    assert table(spark, path) == {("a", 1): (10.0, 5), ("b", 2): (2.0, 2)}


def test_replay_is_idempotent(spark):
    path = work_path(spark, "test-tables")
    b1 = batch(spark, [("a", 1, 1.0, 1), ("b", 2, 2.0, 2), ("c", 3, 3.0, 3)])
    upsert_partitions(b1, path, ["k", "t"], ["seq"], "d")
    first = table(spark, path)
    upsert_partitions(b1, path, ["k", "t"], ["seq"], "d")
    assert table(spark, path) == first


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from("abc"), st.integers(1, 3), st.integers(0, 50)),
        min_size=1,
        max_size=60,
    )
)
def test_latest_per_key_matches_brute_force(spark, rows):
    # (key, day, seq) with seq unique per key → the newest seq wins
    seen = {}
    data = []
    for i, (k, day, seq) in enumerate(rows):
        order = seq * 1000 + i
        data.append((k, day, float(order), order))
        if (k, day) not in seen or order > seen[(k, day)]:
            seen[(k, day)] = order
    df = batch(spark, data)
    got = {(r.k, r.d.day): r.seq for r in latest_per_key(df.repartition(3), ["k", "t"], ["seq"]).collect()}
    assert got == seen


def test_upsert_reads_only_touched_days(spark):
    path = work_path(spark, "test-tables")
    upsert_partitions(batch(spark, [("a", d, 1.0, d) for d in range(1, 10)]), path, ["k", "t"], ["seq"], "d")
    # the existing-data read of a later batch names only its own day
    from pyspark.sql import functions as F

    b = batch(spark, [("a", 3, 7.0, 99)])
    table = spark.read.schema(b.schema).parquet(path)
    values = [r[0] for r in b.select("d").distinct().collect()]
    plan = table.where(F.col("d").isin(values))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and "2024-01-03" in plan
    upsert_partitions(b, path, ["k", "t"], ["seq"], "d")
    got = {(r.k, r.d.day): (r.v, r.seq) for r in read_table(spark, path, b.schema).collect()}
    assert got[("a", 3)] == (7.0, 99) and len(got) == 9



def test_interrupted_overwrite_is_restored_from_the_stage(spark):
    import shutil

    from apiary.operators.upsert import overwrite_from_stage

    path = work_path(spark, "test-tables")
    upsert_partitions(batch(spark, [("a", 1, 1.0, 1), ("b", 2, 2.0, 2)]), path, ["k", "t"], ["seq"], "d")
    b = batch(spark, [("a", 1, 5.0, 9)])
    stage = upsert_partitions(b, path, ["k", "t"], ["seq"], "d")
    # a commit that died half-way: the touched day's folder is gone
    shutil.rmtree(f"{path}/d=2024-01-01")
    overwrite_from_stage(spark, stage, path, b.schema, "d")
    assert table(spark, path) == {("a", 1): (5.0, 9), ("b", 2): (2.0, 2)}


def test_upsert_keeps_rows_without_a_day(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "k string, v int, o int, bucket_date date"
    for row in (("a", 1, 1, None), ("b", 2, 1, None)):
        upsert_partitions(spark.createDataFrame([row], schema), path, ["k"], ["o"])
    got = spark.read.schema(schema).parquet(path).select("k").collect()
    assert sorted(r.k for r in got) == ["a", "b"]


def test_a_filter_on_values_sees_only_the_newest_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = T.StructType.fromDDL("k string, v int, o int, bucket_date date")
    rows = spark.createDataFrame([("a", 20, 1, None), ("a", 5, 2, None)], schema)
    rows.write.partitionBy("bucket_date").parquet(path)
    assert read_latest(spark, path, schema, ["k"], ["o"], where="v > 10").count() == 0
    assert read_latest(spark, path, schema, ["k"], ["o"], where="k = 'a'").first().v == 5
