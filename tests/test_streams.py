from pyspark.sql import functions as F

from crateloom.plans import stream_queries as Q
from tests.tables import day


def test_window_counts_are_those_of_a_batch(spark, tmp_path):
    rows = [(k, day(k // 30).replace(hour=k * 7 % 24, minute=k % 60), "ab"[k % 2], float(k)) for k in range(100)]
    schema = "event_id long, ts timestamp_ntz, event_type string, value double"
    for name, some in (("days", rows), ("hours", rows[:20]), ("none", [])):
        spark.createDataFrame(some, schema).coalesce(1).write.parquet(str(tmp_path / name / "events.parquet"))
        events = spark.read.parquet(str(tmp_path / name / "events.parquet"))
        want = events.groupBy(F.date_trunc("hour", "ts").alias("w"), "event_type").agg(F.count("*"), F.round(F.sum("value"), 4)).collect()
        got = Q.stream_window_counts(spark, str(tmp_path / name)).select(F.col("window_start").cast("timestamp"), "event_type", "n_events", "total").collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and sum(r.n_events for r in got) == len(some)
