import datetime as dt

from pyspark.sql import functions as F

from apiary.operators import retention, upsert
from apiary.plans import testbed as tb
from apiary.session import work_path
from support import SF_SMALL


def test_retained_filter_and_expire(spark):
    r = tb.readings(spark, SF_SMALL)
    kept = retention.retained(r, as_of="2024-04-15")
    assert kept.agg(F.min("time")).first()[0] >= dt.datetime(2024, 1, 16)
    assert kept.count() == r.where(F.col("time") >= F.lit("2024-01-16").cast("timestamp")).count()

    path = work_path(spark, "t-retention")
    r.write.partitionBy("bucket_date").parquet(path)
    r.write.partitionBy("bucket_date").parquet(upsert.compacted_path(path))
    days = upsert.list_partitions(spark, path)
    dropped = retention.expire(spark, path, dt.date(2024, 4, 15))
    assert dropped == [d for d in days if d < "2024-01-16"]
    assert upsert.list_partitions(spark, path) == [d for d in days if d >= "2024-01-16"]
    assert spark.read.parquet(path).count() == kept.count()
    assert upsert.list_partitions(spark, upsert.compacted_path(path)) == [d for d in days if d >= "2024-01-16"]
