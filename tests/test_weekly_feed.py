"""Feeds written week by week: any number of files a week, one micro-batch per week."""

from pyspark.sql import functions as F

from apiary.plans import catalog
from apiary.plans import testbed as tb
from support import SF_SMALL


def test_a_week_has_many_files_and_one_batch(spark, monkeypatch):
    monkeypatch.setattr(catalog, "WEEK_PARTITION_BYTES", "4k")
    feeds, read = [], catalog.stream_ingest.message_stream
    monkeypatch.setattr(
        catalog.stream_ingest, "message_stream", lambda s, kind, path, **kw: feeds.append(path) or read(s, kind, path, **kw)
    )
    got = sorted(catalog.stream_batch_counts(spark, SF_SMALL).collect())
    weeks = tb.readings(spark, SF_SMALL).groupBy(F.date_trunc("week", "time").alias("w")).count().orderBy("w").collect()
    assert [(r.batch_id, r.lines) for r in got] == [(i, w["count"]) for i, w in enumerate(weeks)]
    assert len(spark.read.text(feeds[0]).inputFiles()) > len(weeks)


def test_weeks_are_whole_and_in_order(spark):
    rows = spark.createDataFrame(
        [(1, "2024-01-07 23:59:59"), (2, "2024-01-08 00:00:00"), (3, "2023-12-31 12:00:00"), (4, None), (5, "2024-01-01 00:00:00")],
        "id int, t string",
    ).select("id", F.col("t").cast("timestamp").alias("t"))
    weeks = [sorted(r.id for r in w.collect()) for w in catalog._by_week(spark, rows, "t")]
    assert weeks == [[3], [1, 5], [2], [4]]
