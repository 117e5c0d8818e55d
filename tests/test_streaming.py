import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from apiary.operators import ingest, upsert, windows
from apiary.plans import testbed as tb
from apiary.session import work_path
from apiary.streaming import ingest as si
from support import SF_SMALL

COLS = ["sensor_id", "bucket_ts", "time", "hive", "level", "wing", "sensor_type", "value", "latlong", "bucket_date"]


def _paths(spark):
    return si.IngestPaths(
        table=work_path(spark, "t-tables"),
        quarantine=work_path(spark, "t-quarantine"),
        counts=work_path(spark, "t-counts"),
        checkpoint=work_path(spark, "t-checkpoints"),
    )


def _write_feed(spark, df, path):
    df.select("value").repartition(4).write.mode("append").text(path)


def _run(spark, feed, paths):
    q = si.start_ingest(si.message_stream(spark, "text", feed, max_files_per_trigger=1), paths, {"availableNow": True})
    q.awaitTermination()
    assert q.exception() is None


def test_stream_equals_batch_and_restart_resumes(spark):
    msgs = tb.sensor_messages(spark, SF_SMALL).select("key", "value")
    first = msgs.where(F.col("key").cast("long") % 2 == 0)
    second = msgs.where(F.col("key").cast("long") % 2 == 1)
    feed = work_path(spark, "t-feed")
    paths = _paths(spark)
    _write_feed(spark, first, feed)
    _run(spark, feed, paths)
    n_batches_1 = si.read_counts(spark, paths.counts).count()
    _write_feed(spark, second, feed)
    _run(spark, feed, paths)  # same checkpoint: only the new files are read
    counts = si.read_counts(spark, paths.counts)
    assert counts.count() == n_batches_1 + 4
    total = counts.agg(F.sum("lines"), F.sum("good"), F.sum("quarantined")).first()
    assert total[0] == msgs.count() == total[1] + total[2]

    batch = ingest.to_readings(ingest.parse_messages(msgs)).select(COLS)
    stored = si.read_readings(spark, paths.table).select(COLS)
    assert sorted(stored.collect()) == sorted(batch.collect())
    # compaction leaves one merged folder per day and the same rows
    days = upsert.list_partitions(spark, paths.table)
    si.compact(spark, paths.table, days)
    assert sorted(si.read_readings(spark, paths.table).select(COLS).collect()) == sorted(batch.collect())
    raw = spark.read.parquet(upsert.compacted_path(paths.table))
    assert raw.count() == batch.count()
    assert raw.select("bucket_date", "_generation").distinct().count() == len(days)
    assert upsert.last_committed(spark, paths.checkpoint) == counts.count() - 1
    q = spark.read.parquet(paths.quarantine)
    assert q.count() == total[2]


def test_newest_copy_wins_across_batches(spark):
    msgs = tb.sensor_messages(spark, SF_SMALL).select("key", "value")
    paths = _paths(spark)
    si.ingest_batch(msgs, 0, paths)
    n_good = si.read_readings(spark, paths.table).count()
    corrected = msgs.select("key", F.regexp_replace("value", '"temperature":[-0-9.E]+', '"temperature":-1.0').alias("value"))
    si.ingest_batch(corrected, 1, paths)
    latest = si.read_readings(spark, paths.table)
    assert latest.count() == n_good
    temps = latest.where(F.col("sensor_type") == "Temperature").select("value").distinct().collect()
    assert [r.value for r in temps] == [-1.0]
    assert latest.where(F.col("sensor_type") != "Temperature").where(F.col("value") == -1.0).count() == 0


def test_replayed_batch_leaves_outputs_unchanged(spark):
    msgs = tb.sensor_messages(spark, SF_SMALL).select("key", "value")
    paths = _paths(spark)
    si.ingest_batch(msgs, 0, paths)
    before = sorted(spark.read.parquet(paths.table).collect())
    si.ingest_batch(msgs, 0, paths)
    assert sorted(spark.read.parquet(paths.table).collect()) == before
    assert si.read_counts(spark, paths.counts).count() == 1


def test_streaming_window_equals_batch(spark):
    r = tb.readings(spark, SF_SMALL).select("time", "sensor_type", "value")
    src = work_path(spark, "t-readings")
    r.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(r.schema).option("maxFilesPerTrigger", 1).parquet(src)
    agg = windows.windowed(windows.with_watermark(stream, "time", "1 hour"), "time", "1 hour", keys=["sensor_type"])
    q = agg.writeStream.outputMode("complete").format("memory").queryName("win_test").trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted(spark.table("win_test").collect())
    want = sorted(windows.windowed(r, "time", "1 hour", keys=["sensor_type"]).collect())
    assert got == want


def test_compact_today_keeps_every_row(spark):
    msgs = tb.sensor_messages(spark, SF_SMALL).select("key", "value")
    good = ingest.to_readings(ingest.parse_messages(msgs)).select(COLS)
    paths = _paths(spark)
    parts = [msgs.where(F.col("key").cast("long") % 3 == i) for i in range(3)]
    for i, part in enumerate(parts):
        si.ingest_batch(part, i, paths)
    day = upsert.list_partitions(spark, paths.table)[5]
    merged = si.compact_today(spark, paths.table, day, upto_batch=1)
    assert merged == 2
    folders = spark.read.parquet(paths.table).where(F.col("bucket_date") == day).select("batch_id").distinct()
    assert sorted(r.batch_id for r in folders.collect()) == [2]
    assert sorted(si.read_readings(spark, paths.table).select(COLS).collect()) == sorted(good.collect())


def test_strict_stream_batch_fails_on_a_bad_message(spark):
    import pytest

    msgs = tb.sensor_messages(spark, SF_SMALL).select("key", "value")
    records = tb.sensor_records(spark, SF_SMALL).where(F.col("event_type").isin(list(tb.EVENT_SENSOR_TYPES)))
    clean = ingest.encode_messages(records)
    paths = _paths(spark)
    si.ingest_batch(clean, 0, paths, strict=True)
    assert si.read_readings(spark, paths.table).count() == clean.count()
    with pytest.raises(Exception):
        si.ingest_batch(msgs, 1, _paths(spark), strict=True)


def test_window_stream_drops_rows_later_than_the_watermark(spark):
    from apiary.streaming import windows as sw

    schema = "time timestamp, sensor_type string, value float"
    feed = work_path(spark, "t-late-feed")
    first = [(dt.datetime(2024, 1, 1, h, 15), "Temperature", 1.0) for h in (10, 11, 12)]
    second = [(dt.datetime(2024, 1, 1, 12, 30), "Temperature", 2.0)]
    third = [(dt.datetime(2024, 1, 1, 9, 30), "Temperature", 5.0), (dt.datetime(2024, 1, 1, 13, 0), "Temperature", 4.0)]
    for rows in (first, second, third):  # one file per batch, in this order
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(feed)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed)
    table = work_path(spark, "t-late-table")
    q = sw.start_windowed(stream, "time", "1 hour", table, work_path(spark, "t-late-ck"),
                          keys=["sensor_type"], delay="1 hour", trigger={"availableNow": True})
    q.awaitTermination()
    got = {r.window_start.hour: (r.n, r.total) for r in sw.read_windows(spark, table, ["sensor_type"]).collect()}
    # Spark judges a batch's input against the watermark of the batch before
    # it: by the third batch that is 11:15 (12:15 - 1 h), so 09:30 is dropped.
    assert got == {10: (1, 1.0), 11: (1, 1.0), 12: (2, 3.0), 13: (1, 4.0)}


def test_day_filter_on_merge_on_read_view_prunes_partitions(spark):
    from apiary.operators import joins

    msgs = tb.sensor_messages(spark, SF_SMALL).select("key", "value")
    paths = _paths(spark)
    si.ingest_batch(msgs, 0, paths)
    view = si.read_readings(spark, paths.table)
    joined = joins.sensor_day_join(view, tb.sensors(spark, SF_SMALL), as_of=tb.AS_OF)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket_date" in plan and "2024-01-23" in plan
    batch = ingest.to_readings(ingest.parse_messages(msgs))
    assert joined.count() == joins.sensor_day_join(batch, tb.sensors(spark, SF_SMALL), as_of=tb.AS_OF).count()



def test_window_stream_append_mode_and_compaction(spark):
    from apiary.streaming import windows as sw

    schema = "time timestamp, sensor_type string, value float"
    feed = work_path(spark, "t-append-feed")
    days = [[(dt.datetime(2024, 1, d, h, 10), "T", 1.0) for h in range(0, 24, 6)] for d in (1, 2, 3)]
    for rows in days:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(feed)
    # update mode, then compaction of the repeated emissions
    table = work_path(spark, "t-upd")
    q = sw.start_windowed(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed),
                          "time", "1 day", table, work_path(spark, "t-upd-ck"), keys=["sensor_type"],
                          delay="1 hour", trigger={"availableNow": True})
    q.awaitTermination()
    before = sorted(sw.read_windows(spark, table, ["sensor_type"]).collect())
    merged = sw.compact_windows(spark, table, ["sensor_type"], upto_batch=10**9)
    assert merged >= 1
    assert sorted(sw.read_windows(spark, table, ["sensor_type"]).collect()) == before
    assert spark.read.parquet(upsert.compacted_path(table)).count() == len(before) == 3
    # append mode: closed windows only, each once (the last day stays open)
    table2 = work_path(spark, "t-app")
    q = sw.start_windowed(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(feed),
                          "time", "1 day", table2, work_path(spark, "t-app-ck"), keys=["sensor_type"],
                          delay="1 hour", trigger={"availableNow": True}, output_mode="append")
    q.awaitTermination()
    raw = spark.read.parquet(table2)
    assert raw.count() == raw.select("window_start").distinct().count()
    assert {r.window_start.day for r in raw.collect()} <= {1, 2}


def test_transaction_stream_compaction_keeps_rows(spark):
    from apiary.operators import transactions as txn
    from apiary.streaming import transactions as st

    msgs = txn.encode_transactions(tb.transactions_input(spark, SF_SMALL))
    paths = st.TxnPaths(table=work_path(spark, "t-txn"),
                        counts=work_path(spark, "t-txn-lines"), checkpoint=work_path(spark, "t-txn-ck"))
    halves = [msgs.where(F.pmod(F.xxhash64("value"), F.lit(2)) == i) for i in (0, 1)]
    for i, part in enumerate([*halves, halves[0]]):  # the first half is sent twice
        st.txn_batch(part, i, paths)
    minutes = sorted(st.read_txn_count_min(spark, paths.table).collect())
    assert minutes == sorted(txn.txn_count_min(txn.parse_transactions(msgs)).collect())
    assert sum(r.ttl_txn_min for r in minutes) == msgs.count()
    day = upsert.list_partitions(spark, paths.table, "date_text")[0]
    one = st.read_txn_count_min(spark, paths.table, [day])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "date_text#" in plan.split("PartitionFilters: [")[1].split("]")[0] and "merchant" not in plan
    assert 0 < one.count() < len(minutes)
    before = sorted(st.read_transactions(spark, paths.table).drop("batch_id", "batch_seq").collect())
    days = upsert.list_partitions(spark, paths.table, "date_text")
    st.compact_transactions(spark, paths.table, days)
    after = sorted(st.read_transactions(spark, paths.table).drop("batch_id", "batch_seq").collect())
    assert after == before and len(before) == msgs.count()
    merged = spark.read.parquet(upsert.compacted_path(paths.table))
    assert merged.select("date_text", "_generation").distinct().count() == len(days)


KEYED = "k string, v int, batch_seq long, bucket_date date, batch_id long"


def _append(spark, path, batch_id, *rows):
    df = spark.createDataFrame([(k, v, i, d, batch_id) for i, (k, v, d) in enumerate(rows)], KEYED)
    upsert.append_batch(df, path)


def _keyed(spark, path):
    got = upsert.read_latest(spark, path, T._parse_datatype_string(KEYED), ["k", "bucket_date"], ["batch_id", "batch_seq"])
    return sorted((r.k, r.v) for r in got.collect())


def _compact(spark, path, upto=None):
    return upsert.compact_batches(
        spark, path, T._parse_datatype_string(KEYED), ["k", "bucket_date"], ["batch_id", "batch_seq"],
        upsert.list_partitions(spark, path), upto,
    )


def test_replay_after_compaction_loses_nothing(spark):
    path, day = work_path(spark, "t-replay"), dt.date(2024, 1, 1)
    for i, k in enumerate("abc"):
        _append(spark, path, i, (k, i, day))
    assert _compact(spark, path) == 3 and _compact(spark, path) == 0
    _append(spark, path, 2, ("c", 2, day))  # the stream replays its last batch
    assert _keyed(spark, path) == [("a", 0), ("b", 1), ("c", 2)]
    # a later update wins over the merged row, before and after the next merge
    _append(spark, path, 3, ("a", 9, day))
    assert _keyed(spark, path) == [("a", 9), ("b", 1), ("c", 2)]
    assert _compact(spark, path) == 2
    assert _keyed(spark, path) == [("a", 9), ("b", 1), ("c", 2)]
    assert spark.read.parquet(upsert.compacted_path(path)).count() == 3


def test_batch_that_lands_during_compaction_is_kept(spark, monkeypatch):
    path, day = work_path(spark, "t-during"), dt.date(2024, 1, 1)
    _append(spark, path, 0, ("a", 0, day))
    newest = upsert.latest_per_key

    def late(*args):
        _append(spark, path, 1, ("b", 1, day))
        return newest(*args)

    monkeypatch.setattr(upsert, "latest_per_key", late)
    assert _compact(spark, path) == 1
    monkeypatch.undo()
    assert _keyed(spark, path) == [("a", 0), ("b", 1)]


def test_compaction_keeps_the_null_day_and_later_batches(spark):
    path = work_path(spark, "t-null-day")
    _append(spark, path, 0, ("a", 0, None), ("b", 0, dt.date(2024, 1, 1)))
    _append(spark, path, 1, ("c", 1, None))
    _append(spark, path, 2, ("c", 2, None))
    assert _compact(spark, path, upto=1) == 3
    assert _keyed(spark, path) == [("a", 0), ("b", 0), ("c", 2)]
    assert spark.read.parquet(path).select("batch_id").distinct().collect()[0].batch_id == 2
