"""Stored, streamed and bucketed flows: plans, restarts, late rows, edge cases."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from apiary.operators import aggregate, ingest, lookup, topology, upsert
from apiary.operators import transactions as txn
from apiary.plans import stored_queries as sq
from apiary.plans import testbed as tb
from apiary.session import work_path
from apiary.sources import messages, tables
from apiary.streaming import dedup
from apiary.streaming import ingest as si
from apiary.streaming import progress as sp
from apiary.streaming import summaries as ss
from apiary.streaming import transactions as st
from support import SF_SMALL, plan_text

ONCE = {"availableNow": True}


# Sums


def test_sums_round_nothing_and_take_every_finite_double(spark):
    def total(*values):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
        return df.agg(aggregate.fixed_sum("v")).first()[0]

    assert total(4e-10, 4e-10) == pytest.approx(8e-10, rel=1e-12)
    assert total(3e38, 1.0) == 3e38 and total(-1e300, 1e300, 5.0) == 5.0
    assert total(float("nan"), float("inf"), 2.5) == 2.5
    assert total(None, float("nan")) is None and total(0.0, -0.0) == 0.0
    assert total(1e15, 0.25, -1e15, 2**-30) == 0.25 + 2**-30
    rng = random.Random(5)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-8, 14) for _ in range(2000)]
    assert total(*values) == pytest.approx(math.fsum(values), rel=1e-15)
    shuffled = values[:]
    rng.shuffle(shuffled)
    assert total(*values) == total(*shuffled)


def test_prices_are_added_before_they_are_rounded(spark):
    lines = spark.createDataFrame([(1, p, 0.004) for p in (1, 2, 3)] + [(1, 1, 0.001)], "o long, p long, price double")
    assert txn.basket_totals(txn.baskets(lines, "o", "p", "price"), "o").first().total_text == "0.01"


# Stored tables


def _ingested(spark, batches=2):
    msgs = tb.sensor_messages(spark, SF_SMALL).select("key", "value")
    paths = si.IngestPaths(*(work_path(spark, f"t-{n}") for n in ("tables", "quarantine", "counts", "ck")))
    for i in range(batches):
        si.ingest_batch(msgs.where(F.col("key").cast("long") % batches == i), i, paths)
    return paths


def test_days_of_the_filtered_dimension_prune_both_scans(spark):
    paths = _ingested(spark)
    days = upsert.list_partitions(spark, paths.table)
    si.compact(spark, paths.table, days[:20])
    daily = work_path(spark, "t-daily")
    sensors = tb.sensors(spark, SF_SMALL)
    tables.save_daily_topology(topology.daily_topology(sensors, as_of="2024-01-25", days_back=9), daily)
    got = sq.stored_average(spark, paths.table, daily)
    plan = plan_text(got)
    assert plan.count("dynamicpruningexpression(bucket_date") == 2
    for scan in plan.split("FileScan parquet ")[1:]:
        columns = scan.split("]")[0]
        if "source_pos" in columns:
            assert not any(c in columns for c in ("wing", "latlong", "level", "sensor_type"))
    readings = si.read_readings(spark, paths.table)
    want = (
        readings.where(F.col("bucket_date").between(dt.date(2024, 1, 16), dt.date(2024, 1, 25)))
        .select("sensor_id", "value").join(sensors.where(F.col("wing") == sq.FILTER_WING), "sensor_id")
    )
    assert sorted(got.collect()) == sorted(aggregate.hive_average(want).collect())
    # nothing but key, order, partition and the asked columns is returned or read
    assert set(si.read_readings(spark, paths.table, columns=["value"]).columns) == {
        "sensor_id", "bucket_ts", "time", "bucket_date", "batch_id", "source_pos", "value"
    }


def test_source_order_does_not_depend_on_splits_or_cores(spark):
    feed = sq.source_order_feed(spark, SF_SMALL)
    rows = [sorted(sq.newest_by_source(spark, feed).drop("source_pos").collect())]
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    for size in ("5000", "33333"):
        spark.conf.set(name, size)
        try:
            assert messages.read_messages(spark, feed).rdd.getNumPartitions() > 8
            rows.append(sorted(sq.newest_by_source(spark, feed).drop("source_pos").collect()))
        finally:
            spark.conf.set(name, before)
    assert len(rows[0]) > 500 and rows[1] == rows[0] and rows[2] == rows[0]


def test_a_replayed_stream_batch_picks_the_same_copy(spark):
    feed = sq.source_order_feed(spark, SF_SMALL)
    want = sorted(sq.newest_by_source(spark, feed).drop("source_pos").collect())
    for files in (1, 100):
        paths = si.IngestPaths(*(work_path(spark, f"t-{n}") for n in ("tables", "quarantine", "counts", "ck")))
        stream = messages.message_stream(spark, "text", feed, max_files_per_trigger=files)
        sq.finished(si.start_ingest(stream, paths, ONCE))
        got = si.read_readings(spark, paths.table).select(*[c for c in sq.STORED_COLUMNS])
        assert sorted(got.collect()) == sorted(
            sq.newest_by_source(spark, feed).select(*sq.STORED_COLUMNS).collect()
        ) and len(want) == got.count()


def test_topic_records_are_ordered_by_partition_and_offset(spark):
    rows = [("k", "a", "t", 0, 5), ("k", "b", "t", 0, 12), ("k", "c", "t", 0, 7)]
    records = spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long")
    read = messages._from_topic(records).repartition(3)
    assert upsert.latest_per_key(read, ["key"], ["source_pos"]).first().value == "b"


def test_bucketed_join_has_no_exchange_and_reads_only_the_asked_bucket(spark):
    readings, sensors = sq.bucketed_tables(spark, SF_SMALL)
    joined = sq.bucket_join(readings, sensors)
    plan = plan_text(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    one = readings.select("sensor_id").first()[0]
    pruned = joined.where(F.col("sensor_id") == one)
    assert plan_text(pruned).count("SelectedBucketsCount: 1 out of 4") == 2
    assert pruned.count() == readings.where(F.col("sensor_id") == one).count() > 0


# Streams with state


def test_dedup_keeps_one_row_per_key_over_a_restart(spark):
    feed, table, checkpoint = (work_path(spark, f"t-{n}") for n in ("feed", "dedup", "ck"))
    msgs = tb.sensor_messages(spark, SF_SMALL).select("value")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    counts = []
    for _ in range(2):  # the second run finds every message again
        msgs.repartition(3).write.mode("append").text(feed)
        stream = messages.message_stream(spark, "text", feed, max_files_per_trigger=1)
        q = sq.finished(dedup.start_dedup(stream, table, checkpoint, delay="60 days", trigger=ONCE))
        assert any(o.customMetrics and any("rocksdb" in m for m in o.customMetrics) for p in q.recentProgress for o in p.stateOperators)
        counts.append(dedup.read_dedup(spark, table).count())
    good = ingest.to_readings(ingest.parse_messages(msgs))
    assert counts == [good.count()] * 2
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before


def test_dedup_forgets_keys_after_the_delay(spark):
    feed = work_path(spark, "t-feed")
    schema = "k string, time timestamp, v int"
    t0 = dt.datetime(2024, 1, 1)
    out = work_path(spark, "t-out")
    for i, rows in enumerate([[("a", t0, 1), ("a", t0, 2)], [("b", t0 + dt.timedelta(hours=5), 3)], [("a", t0 + dt.timedelta(hours=5), 4)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(feed)
        stream = spark.readStream.schema(schema).parquet(feed)
        q = dedup.first_per_key(stream, ["k"], "time", "1 hour").writeStream.format("parquet").option("path", out)
        sq.finished(q.option("checkpointLocation", out + "-ck").trigger(**ONCE).start())
    kept = sorted((r.k, r.v) for r in spark.read.schema(schema).parquet(out).collect())
    assert [k for k, _ in kept] == ["a", "a", "b"] and kept[1:] == [("a", 4), ("b", 3)]


def test_hours_come_from_minutes_and_open_hours_are_not_written(spark):
    feed, table, checkpoint = (work_path(spark, f"t-{n}") for n in ("feed", "hours", "ck"))
    t = dt.datetime(2024, 1, 1, 10)
    rows = [("s", t + dt.timedelta(minutes=m), "T", v) for m, v in ((0, 1.0), (0, 2.0), (59, 4.0), (60, 8.0), (200, 16.0))]
    rows.append(("s", t + dt.timedelta(minutes=1), "T", float("nan")))
    df = spark.createDataFrame(rows, sq.FEED_SCHEMA).coalesce(1)
    stream = sq.readings_feed(spark, feed, df)
    sq.finished(ss.start_sensor_hours(stream, table, checkpoint, delay="1 hour", trigger=ONCE))
    got = {r.window_start.hour: (r.n, r.total) for r in spark.read.parquet(table).collect()}
    assert got == {10: (3, 7.0), 11: (1, 8.0)}


def test_a_changed_dimension_takes_effect_with_the_next_batch(spark):
    dimension, feed, table, checkpoint = (work_path(spark, f"t-{n}") for n in ("dim", "feed", "hive", "ck"))
    t = dt.datetime(2024, 1, 1, 10)
    row = [("s", t, "T", 1.5), ("unknown", t, "T", 9.0)]
    for hive in (1, 2):
        spark.createDataFrame([("s", hive, 7, "w", "0, 0", "Any")], tables.SENSOR).write.mode("overwrite").parquet(dimension)
        stream = sq.readings_feed(spark, feed, spark.createDataFrame(row, sq.FEED_SCHEMA).coalesce(1))
        sq.finished(ss.start_hive_summary(stream, lambda s: tables.read_sensors(s, dimension), table, checkpoint, trigger=ONCE))
    got = {(r.hive, r.level): (r.value_sum, r.value_count) for r in ss.read_hive_summary(spark, table).collect()}
    assert got == {(1, 7): (1.5, 1), (2, 7): (1.5, 1), (None, None): (18.0, 2)}
    # a replayed batch replaces its own sums
    ss.hive_batch(spark.createDataFrame(row, sq.FEED_SCHEMA), 1, tables.read_sensors(spark, dimension), table)
    assert ss.read_hive_summary(spark, table).where("hive = 2").first().value_sum == 1.5


def test_progress_counts_add_up_on_a_late_feed(spark):
    row = sq.stream_progress(spark, SF_SMALL).first()
    assert row.late_rows > 0 and row.input_rows == row.counted_rows + row.late_rows + 1


def test_progress_has_one_row_per_batch(spark):
    path, feed = work_path(spark, "t-progress"), work_path(spark, "t-feed")
    df = tb.readings(spark, SF_SMALL).repartition(3)
    stream = sq.readings_feed(spark, feed, df)
    with sp.ProgressLog(spark) as log:
        q = stream.writeStream.format("noop").option("checkpointLocation", feed + "-ck").queryName("kept").trigger(**ONCE).start()
        sq.finished(q)
        log.wait_for(str(q.runId))
        heard = log.save(path)
        assert log.save(path) == 0
    rows = sp.read_progress(spark, path).where("input_rows > 0").collect()
    assert heard >= len(rows) == 2 and {r.query_name for r in rows} == {"kept"}
    assert sum(r.input_rows for r in rows) == df.count() and all(r.batch_ms > 0 for r in rows)
    assert sp.read_progress(spark, path).select("batch_id").distinct().count() == sp.read_progress(spark, path).count()


def _txns(spark, rows):
    df = spark.createDataFrame(rows, "txn_id string, cc_no string, txn_time timestamp, amount double, init_status int")
    return txn.encode_transactions(df)


def test_kept_minutes_follow_late_and_corrected_messages(spark, monkeypatch):
    paths = st.TxnPaths(*(work_path(spark, f"t-{n}") for n in ("txn", "lines", "ck", "bad", "minutes")))
    t = dt.datetime(2024, 1, 1, 10)
    day2 = dt.datetime(2024, 1, 2, 10)
    st.txn_batch(_txns(spark, [("1", "c", t, 1.0, 9), ("2", "d", t, 1.0, 1), ("3", "c", day2, 1.0, 9)]), 0, paths)
    read = []
    newest = st.read_latest

    def spy(*args):
        out = newest(*args)
        read.append(out)
        return out

    monkeypatch.setattr(st, "read_latest", spy)
    # a late row of the first hour, a repeated one, and a correction of its status
    st.txn_batch(_txns(spark, [("4", "e", t + dt.timedelta(minutes=5), 1.0, 9), ("1", "c", t, 1.0, 9), ("2", "d", t, 1.0, 7)]), 1, paths)
    monkeypatch.undo()
    scan = plan_text(read[0]).split("PartitionFilters: [")[1].split("]")[0]
    assert "date_text" in scan and "2024-01-01" in scan and "2024-01-02" not in scan
    want = sorted(st.read_txn_count_min(spark, paths.table).collect())
    assert sorted(st.read_minutes(spark, paths.minutes).collect()) == want
    assert [(r.ttl_txn_min, r.approved_txn_min, r.ttl_txn_hr) for r in want] == [(2, 2, 3), (1, 1, 3), (1, 1, 1)]
    assert st.read_minutes(spark, paths.minutes, ["2024-01-02"]).count() == 1
    # the same batch again, an empty batch, and a merge change nothing
    st.txn_batch(_txns(spark, [("4", "e", t + dt.timedelta(minutes=5), 1.0, 9), ("1", "c", t, 1.0, 9), ("2", "d", t, 1.0, 7)]), 1, paths)
    st.txn_batch(spark.createDataFrame([("{",)], "value string"), 2, paths)
    assert sorted(st.read_minutes(spark, paths.minutes).collect()) == want
    assert st.compact_minutes(spark, paths.minutes, ["2024-01-01", "2024-01-02"]) == 3
    assert sorted(st.read_minutes(spark, paths.minutes).collect()) == want


def test_published_text_is_exactly_once_over_a_restart(spark):
    feed, out, checkpoint = (work_path(spark, f"t-{n}") for n in ("feed", "text", "ck"))
    readings = ingest.to_readings(tb.sensor_records(spark, SF_SMALL)).persist()
    half = F.pmod(F.xxhash64("sensor_id", "time"), F.lit(2))
    for i in (0, 1):
        readings.where(half == i).write.mode("append").parquet(feed)
        stream = ingest.encode_readings(spark.readStream.schema(readings.schema).parquet(feed))
        sq.finished(messages.start_write_messages(stream, out, checkpoint, ONCE))
    # a file that no commit names, as a failed attempt may leave it
    with open(f"{out}/part-99999-left.txt", "w") as f:
        f.write('{"sensor_id":"x"}\n')
    columns = [c for c in ingest.READING_COLUMNS if c != "time"]
    got = ingest.decode_readings(messages.read_messages(spark, out))
    assert sorted(got.select(*columns).collect(), key=str) == sorted(readings.select(*columns).collect(), key=str)


def test_messages_written_in_a_batch_are_read_back(spark):
    out = work_path(spark, "t-text")
    msgs = tb.sensor_messages(spark, SF_SMALL).select("value")
    messages.write_messages(msgs, "text", out)
    assert sorted(r.value for r in messages.read_messages(spark, out).collect()) == sorted(r.value for r in msgs.collect())
    with pytest.raises(ValueError):
        messages.write_messages(msgs, "queue")


# Range lookup by merging


def _brute(bounds, u):
    above = [b for b in bounds if b[0] is not None and not math.isnan(b[0]) and u is not None and not math.isnan(u) and b[0] >= u]
    return min(above)[1] if above else lookup.DEFAULT_NAME


def test_sorted_lookup_equals_brute_force(spark):
    rng = random.Random(3)
    bounds = [(round(rng.uniform(0, 50), 1), f"n{i}") for i in range(300)] + [(None, "none"), (float("nan"), "nan")]
    # a third of the numbers is one value, many lie on a bound, some above all bounds
    numbers = [25.05] * 400 + [rng.choice(bounds[:300])[0] for _ in range(300)] + [rng.uniform(-5, 60) for _ in range(500)]
    rows = [(i, u) for i, u in enumerate([*numbers, None, float("nan"), float("inf"), float("-inf")])]
    df = spark.createDataFrame(rows, "id long, u double").repartition(5)
    b = spark.createDataFrame(bounds, "hi double, name string").repartition(3)
    for parts in (1, 7, 40):
        got = {r.id: r.name for r in lookup.range_lookup_sorted(df, "u", b, parts=parts).collect()}
        assert got == {i: _brute(bounds, u) for i, u in rows}
    empty = lookup.range_lookup_sorted(df, "u", b.limit(0))
    assert {r.name for r in empty.collect()} == {lookup.DEFAULT_NAME} and empty.count() == len(rows)
    assert lookup.range_lookup_sorted(df.limit(0), "u", b).count() == 0


def test_sorted_lookup_cuts_a_hot_number_and_takes_millions_of_bounds(spark):
    df = spark.range(200_000).select("id", F.when(F.col("id") % 3 > 0, 0.5).otherwise(F.rand(1)).alias("u"))
    bounds = spark.range(1, 2_000_001).select((F.col("id") / 2_000_000).alias("hi"), F.col("id").cast("string").alias("name"))
    got = lookup.range_lookup_sorted(df, "u", bounds, parts=16)
    wrong = got.where(F.col("name") != F.ceil(F.col("u") * 2_000_000).cast("string"))
    # a number within rounding of a bound may fall to its neighbour; the hot one must not
    assert got.count() == 200_000 and wrong.where("u = 0.5").count() == 0
    assert wrong.where(F.abs(F.col("name").cast("double") - F.col("u") * 2_000_000) > 1.000001).count() == 0
    stored = spark.read.parquet(next(f for f in [got.inputFiles()[0].rsplit("/", 1)[0]]))
    largest = max(r["count"] for r in stored.groupBy("_part").count().collect())
    assert largest < 3 * stored.count() / 16
    assert "BroadcastNestedLoop" not in plan_text(got)


# Plans


def test_newest_copy_needs_one_exchange_with_a_partial_step(spark):
    df = sq.newest_by_source(spark, sq.source_order_feed(spark, SF_SMALL))
    plan = plan_text(df)
    assert "partial_max_by" in plan and "Python" not in plan
    # one exchange spreads the narrow test feed, one deals the keys
    assert plan.count("Exchange hashpartitioning") <= 2 and "BroadcastNestedLoop" not in plan


def test_chained_windows_are_two_state_stores_of_one_query(spark):
    feed = work_path(spark, "t-feed")
    stream = sq.readings_feed(spark, feed, tb.readings(spark, SF_SMALL), sq.end_of_feed(spark, SF_SMALL))
    q = sq.finished(ss.start_sensor_hours(stream, work_path(spark, "t-h"), work_path(spark, "t-ck"), delay="60 days", trigger=ONCE))
    assert {len(p.stateOperators) for p in q.recentProgress if p.stateOperators} == {2}
    # all windows of the feed were closed and written: what is left is the end mark
    assert q.recentProgress[-1].stateOperators[0].numRowsTotal <= 1


def test_stream_join_broadcasts_the_dimension_and_sums_before_the_shuffle(spark, monkeypatch):
    seen = []
    summary = ss.hive_summary
    monkeypatch.setattr(ss, "hive_summary", lambda df: seen.append(summary(df)) or seen[-1])
    ss.hive_batch(tb.readings(spark, SF_SMALL), 0, tb.sensors(spark, SF_SMALL), work_path(spark, "t-hive"))
    plan = plan_text(seen[0])
    assert "BroadcastHashJoin" in plan and plan.count("partial_sum") >= 2 and "Python" not in plan


def test_many_bounds_are_merged_not_broadcast(spark):
    df = spark.createDataFrame([(i, i / 7) for i in range(8)], "id long, u double")
    bounds = spark.createDataFrame([(i / 10, f"n{i}") for i in range(1, 11)], "hi double, name string")
    few, many = (lookup.range_lookup(df, "u", bounds, max_broadcast_rows=n) for n in (100, 3))
    assert sorted(few.collect()) == sorted(many.collect())
    assert "Window" in plan_text(many) and "_part" in plan_text(many)
