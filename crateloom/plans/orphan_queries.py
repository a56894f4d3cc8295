"""Queries p6: orphan references of credits and relationships."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crateloom.operators.orphans import OrphanState, deletions, months, parents, references, replay
from crateloom.runtime import table

FIELDS = (
    ("credits", "recording_id", "credit_id"),
    ("relationships", "source_recording_id", "relationship_id"),
    ("relationships", "target_recording_id", "relationship_id"),
)


def inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    refs = reduce(DataFrame.unionByName, (references(table(spark, sf_dir, t), t, f, k) for t, f, k in FIELDS))
    return refs, parents(table(spark, sf_dir, "recordings")), deletions(table(spark, sf_dir, "deleted_recordings"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = OrphanState()
    for state in replay(*inputs(spark, sf_dir)):
        pass
    return state.report()


def p6_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts after each calendar month of the history, numbered from its first; deletions reopen references."""
    rows = inputs(spark, sf_dir)
    shots = [
        state.counts().withColumn("snapshot_no", F.lit(k)) for k, state in enumerate(replay(*rows, cuts=months(*rows), reopen=True, keep=True), 1)
    ]
    return reduce(DataFrame.unionByName, shots)


QUERIES = {"p6_found": p6_found, "p6_snapshots": p6_snapshots}

_REF = """
SELECT 'credits' AS table_name, 'recording_id' AS field_name, credit_id AS record_id, recording_id AS ref_id, loaded_at FROM credits
UNION ALL
SELECT 'relationships', 'source_recording_id', relationship_id, source_recording_id, loaded_at FROM relationships
UNION ALL
SELECT 'relationships', 'target_recording_id', relationship_id, target_recording_id, loaded_at FROM relationships
"""

SQL = {
    "p6_found": f"""
WITH ref AS ({_REF}),
idx AS (SELECT recording_id AS ref_id, min(loaded_at) AS first_loaded FROM recordings GROUP BY 1),
gone AS (SELECT DISTINCT recording_id AS ref_id FROM deleted_recordings)
SELECT DISTINCT table_name, field_name, strftime(r.loaded_at, '%Y-%m') AS load_month, record_id,
       CASE WHEN g.ref_id IS NOT NULL THEN 'deleted' WHEN i.ref_id IS NOT NULL THEN 'later' ELSE 'missing' END AS kind
FROM ref r LEFT JOIN idx i USING (ref_id) LEFT JOIN gone g USING (ref_id)
WHERE trim(r.ref_id) <> '' AND (i.ref_id IS NULL OR i.first_loaded > r.loaded_at)
""",
    "p6_snapshots": f"""
WITH ref AS (SELECT DISTINCT * FROM ({_REF}) WHERE trim(ref_id) <> ''),
idx AS (SELECT recording_id AS ref_id, min(coalesce(loaded_at, TIMESTAMP '0001-01-01')) AS f FROM recordings WHERE trim(recording_id) <> '' GROUP BY 1),
gone AS (SELECT recording_id AS ref_id, min(coalesce(deleted_at, TIMESTAMP '0001-01-01')) AS g FROM deleted_recordings WHERE trim(recording_id) <> '' GROUP BY 1),
t AS (SELECT loaded_at AS t FROM ref UNION ALL SELECT loaded_at FROM recordings WHERE trim(recording_id) <> '' UNION ALL SELECT deleted_at FROM deleted_recordings WHERE trim(recording_id) <> ''),
m AS (SELECT unnest(generate_series(date_trunc('month', min(t))::timestamp, date_trunc('month', max(t))::timestamp, INTERVAL 1 MONTH)) AS m FROM t),
n AS (SELECT m + INTERVAL 1 MONTH - INTERVAL 1 MICROSECOND AS cut, row_number() OVER (ORDER BY m) AS k, count(*) OVER () AS last FROM m),
x AS (SELECT k AS snapshot_no, table_name, field_name, strftime(loaded_at, '%Y-%m') AS load_month, record_id,
      CASE WHEN k = last OR g <= cut THEN CASE WHEN g IS NOT NULL THEN 'deleted' END END AS dead, f, cut, k, last, loaded_at
      FROM n JOIN ref ON ref.loaded_at <= n.cut OR (n.k = n.last) LEFT JOIN idx USING (ref_id) LEFT JOIN gone USING (ref_id)),
y AS (SELECT DISTINCT snapshot_no, table_name, field_name, load_month, record_id, CASE WHEN dead IS NOT NULL THEN dead WHEN f IS NULL OR (f > cut AND k < last) THEN 'missing' WHEN f > coalesce(loaded_at, TIMESTAMP '9999-12-31') THEN 'later' END AS kind FROM x)
SELECT CAST(snapshot_no AS int) AS snapshot_no, table_name, field_name, load_month, kind, count(*) AS n_orphans FROM y WHERE kind IS NOT NULL GROUP BY ALL
""",
}
