"""Queries that run streams over the files of a table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crateloom.operators.orphans import OrphanState, deletions, parents, references
from crateloom.runtime import scratch_root, table
from crateloom.streaming import flows


def stream_window_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by hour and type, with the windows that are still open when the files end."""
    return flows.latest(flows.window_counts(flows.source(spark, sf_dir, "events")), ["window_start", "event_type"])


def stream_first_credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credits once per id, as a stream."""
    credits = flows.source(spark, sf_dir, "credits").select("credit_id", "loaded_at")
    return flows.first_ever(credits, ["credit_id"]).groupBy().agg(F.count("*").alias("n_credits"))


def stream_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphan references of credits from a stream, with the final kinds."""
    refs = references(flows.source(spark, sf_dir, "credits"), "credits", "recording_id", "credit_id")
    root = f"{scratch_root(spark)}/crateloom-stream-{uuid.uuid4().hex}"
    sink = flows.orphan_sink(root, parents(table(spark, sf_dir, "recordings")), deletions(table(spark, sf_dir, "deleted_recordings")))
    running = refs.writeStream.foreachBatch(sink).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    running.awaitTermination()
    state = OrphanState()
    state.pending = flows.pending_of(spark, root)
    if state.pending is None:  # a table without files runs no batch
        state.pending = spark.createDataFrame([], flows.PENDING)
    return state.report()


QUERIES = {"stream_window_counts": stream_window_counts, "stream_first_credits": stream_first_credits, "stream_orphans": stream_orphans}
SQL = {
    "stream_window_counts": "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n_events, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "stream_first_credits": "SELECT count(DISTINCT credit_id) AS n_credits FROM credits",
    "stream_orphans": """
WITH idx AS (SELECT recording_id AS ref_id, min(loaded_at) AS first_loaded FROM recordings GROUP BY 1),
gone AS (SELECT DISTINCT recording_id AS ref_id FROM deleted_recordings)
SELECT DISTINCT 'credits' AS table_name, 'recording_id' AS field_name, strftime(r.loaded_at, '%Y-%m') AS load_month, credit_id AS record_id,
       CASE WHEN g.ref_id IS NOT NULL THEN 'deleted' WHEN i.ref_id IS NOT NULL THEN 'later' ELSE 'missing' END AS kind
FROM credits r LEFT JOIN idx i ON i.ref_id = r.recording_id LEFT JOIN gone g ON g.ref_id = r.recording_id
WHERE trim(r.recording_id) <> '' AND (i.ref_id IS NULL OR i.first_loaded > r.loaded_at)
""",
}
