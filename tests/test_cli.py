from apiary import cli
from apiary.plans import testbed as tb
from apiary.session import work_path
from support import SF_SMALL


def test_ingest_then_hive_average_then_compact(spark, capsys):
    root = work_path(spark, "t-cli")
    feed = work_path(spark, "t-cli-feed")
    tb.sensor_messages(spark, SF_SMALL).select("value").coalesce(2).write.text(feed)
    cli.main(["ingest", "--kind", "text", "--path", feed, "--root", root, "--available-now", "--max-files", "1"], spark)
    out = capsys.readouterr().out
    assert "lines processed" in out

    sensors = work_path(spark, "t-cli-sensors")
    tb.sensors(spark, SF_SMALL).write.parquet(sensors)
    cli.main(["hive-average", "--readings", f"{root}/sensor_data", "--sensors", sensors, "--as-of", tb.AS_OF], spark)
    lines = [ln for ln in capsys.readouterr().out.splitlines() if ln.startswith("Average for hive")]
    assert len(lines) > 0

    cli.main(["compact", "--table", f"{root}/sensor_data"], spark)
    assert "compacted" in capsys.readouterr().out
    cli.main(["hive-average", "--readings", f"{root}/sensor_data", "--sensors", sensors, "--as-of", tb.AS_OF], spark)
    again = [ln for ln in capsys.readouterr().out.splitlines() if ln.startswith("Average for hive")]
    assert again == lines


def test_summaries_job_is_rerunnable(spark, capsys):
    from pyspark.sql import functions as F

    from apiary.sources.tables import read_hive_summary, read_sensor_summary

    root = work_path(spark, "t-cli-sum")
    feed = work_path(spark, "t-cli-sum-feed")
    tb.sensor_messages(spark, SF_SMALL).select("value").coalesce(1).write.text(feed)
    cli.main(["ingest", "--kind", "text", "--path", feed, "--root", root, "--available-now"], spark)
    sensors = work_path(spark, "t-cli-sum-sensors")
    tb.sensors(spark, SF_SMALL).write.parquet(sensors)
    out = work_path(spark, "t-cli-sum-out")
    args = ["summaries", "--readings", f"{root}/sensor_data", "--sensors", sensors, "--out", out,
            "--as-of", tb.AS_OF, "--days-back", "7"]
    cli.main(args, spark)
    first = sorted(read_sensor_summary(spark, f"{out}/sensor_data_summary").drop("run_id").collect())
    cli.main(args, spark)  # a re-run replaces, it does not add
    again = sorted(read_sensor_summary(spark, f"{out}/sensor_data_summary").drop("run_id").collect())
    assert again == first
    hive = read_hive_summary(spark, f"{out}/hive_summary")
    total = hive.where(F.col("precision") == 60).agg(F.sum("value_count")).first()[0]
    assert total == sum(r.value_count for r in first if r.precision == 60)
    assert {r.precision for r in first} == {60, 3600}


def _lines(capsys):
    return sorted(ln for ln in capsys.readouterr().out.splitlines() if ln.startswith("Average for hive"))


def test_hive_average_flags(spark, capsys):
    from apiary.operators import aggregate, joins
    from apiary.streaming import ingest as si

    root, sensors = work_path(spark, "t-cli"), work_path(spark, "t-cli-sensors")
    tb.sensors(spark, SF_SMALL).write.parquet(sensors)
    si.ingest_batch(tb.sensor_messages(spark, SF_SMALL).select("value"), 0, cli._ingest_paths(root))
    view = si.read_readings(spark, f"{root}/sensor_data")
    base = ["hive-average", "--readings", f"{root}/sensor_data", "--sensors", sensors, "--as-of", tb.AS_OF]
    dim = tb.sensors(spark, SF_SMALL)
    for flags, readings, chosen in (
        (["--wing", "AUTOMOBILE", "MACHINERY"], view, dim.where("wing in ('AUTOMOBILE', 'MACHINERY')")),
        (["--hive", "3", "7", "--level", "1", "2", "3", "4", "5"], view, dim.where("hive in (3, 7) and level between 1 and 5")),
        (["--since", "2024-01-28T06:00", "--until", "2024-01-29T18:00:00"], view.where("time >= '2024-01-28 06:00:00' and time < '2024-01-29 18:00:00'"), dim),
    ):
        cli.main([*base, *flags], spark)
        want = aggregate.report_lines(aggregate.hive_average(joins.sensor_day_join(readings, chosen, as_of=tb.AS_OF)))
        assert _lines(capsys) == sorted(r.line for r in want.collect())
    everything = [*base, "--days-back", "40"]
    cli.main(everything, spark)
    assert len(_lines(capsys)) > 0


def test_strict_jobs_end_on_a_bad_message_and_progress_is_kept(spark, capsys):
    import pytest

    from apiary.streaming import progress, transactions

    feed, root = work_path(spark, "t-cli-feed"), work_path(spark, "t-cli")
    good = '{"txn_id": "t%d", "cc_no": "c", "txn_time": "2024-01-01 10:0%d:00.000", "init_status": 7}'
    for rows in ([good % (i, i) for i in range(3)], [good % (9, 9), "{"]):
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("append").text(feed)
    args = ["--kind", "text", "--path", feed, "--available-now", "--max-files", "1"]
    cli.main(["txn-ingest", *args, "--root", root, "--minutes", "--progress"], spark)
    rows = progress.read_progress(spark, f"{root}/progress").where("input_rows > 0").collect()
    assert sorted(r.input_rows for r in rows) == [2, 3]
    kept = transactions.read_minutes(spark, f"{root}/txn_count_min")
    assert sorted(kept.collect()) == sorted(transactions.read_txn_count_min(spark, f"{root}/transactions").collect())
    assert kept.count() == 4
    # side tables are merged too, and keep every row
    counts = sorted(transactions.read_line_counts(spark, f"{root}/txn_lines").collect())
    bad = transactions.read_txn_quarantine(spark, f"{root}/transactions-quarantine").collect()
    assert [(r.value, r.reason) for r in bad] == [("{", "malformed")] and len(counts) == 2
    capsys.readouterr()
    for name in ("txn_lines", "transactions-quarantine", "txn_count_min"):
        cli.main(["compact", "--table", f"{root}/{name}"], spark)
    assert capsys.readouterr().out.count("compacted 0") == 0
    assert sorted(transactions.read_line_counts(spark, f"{root}/txn_lines").collect()) == counts
    assert transactions.read_txn_quarantine(spark, f"{root}/transactions-quarantine").collect() == bad
    assert transactions.read_minutes(spark, f"{root}/txn_count_min").count() == 4
    with pytest.raises(Exception, match="(?i)malformed|parse|json|record"):
        cli.main(["txn-ingest", *args, "--root", work_path(spark, "t-cli"), "--strict"], spark)


def test_quarantined_messages_survive_a_merge(spark):
    from apiary.streaming import ingest as si

    paths = si.IngestPaths(*(work_path(spark, f"t-{n}") for n in ("tables", "quarantine", "counts", "ck")))
    msgs = tb.sensor_messages(spark, SF_SMALL).select("key", "value")
    for i in range(3):  # equal messages are kept as often as they came
        si.ingest_batch(msgs, i, paths)
    before = sorted(si.read_quarantine(spark, paths.quarantine).collect())
    counts = sorted(si.read_counts(spark, paths.counts).collect())
    assert si.compact_quarantine(spark, paths.quarantine, upto_batch=1) == 2
    assert si.compact_counts(spark, paths.counts, upto_batch=1) == 2
    assert sorted(si.read_quarantine(spark, paths.quarantine).collect()) == before and len(before) == sum(r.quarantined for r in counts)
    assert sorted(si.read_counts(spark, paths.counts).collect()) == counts
    si.ingest_batch(msgs, 1, paths)  # a replayed batch, already merged
    assert sorted(si.read_quarantine(spark, paths.quarantine).collect()) == before
