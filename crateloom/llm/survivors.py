"""Best representative of each duplicate group.

Rows belong together when they carry the same recording id or the same track id, also through a
chain. The component of a key is found on the graph of distinct keys, not of rows, so any number of
copies of one key is one node. Records are ranked by completeness, trust, recency and row id with
window ordering; the top record is kept per group. The filter on the rank makes Spark cut every
group to its best row in each map task, so a hot group never meets in one task.

``golden`` builds one record per group with, for each field, the value of the best-ranked row that
really has one. Blank, null and placeholder values are no values. Rows without any key form groups
of their own. Ties fall to the smaller row id.
Columns beside the schema pass through unless they bear a name of the result. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crateloom.functions.text import clean
from crateloom.operators.components import components
from crateloom.runtime import materialize, table

#: Texts that stand for a missing value, in lower case.
PLACEHOLDERS = ["-", "--", "?", "??", "0", ".", "n/a", "na", "n/d", "nd", "none", "null", "nil", "nan", "tba", "tbd", "tbc", "unknown", "not_found", "not found", "missing", "undefined", "void"]
COMPLETENESS = ["album", "label", "release_year", "duration", "genre", "keywords", "spotify_isrc", "spotify_album_name", "spotify_album_release_date", "whosampled_url", "youtube_video_id", "musicbrainz_recording_id"]
#: Match states from most to least trusted.
TRUST = {"matched": 3, "review": 2, "unresolved": 1}


def real(c: Column) -> Column:
    """True for a value that is neither null, blank nor a placeholder."""
    text = F.lower(clean(c))
    return ~(text.isin("", *PLACEHOLDERS) | text.rlike(r"^unknown( (album|artist|label|title|genre|year|value))?$"))


def track_key(c: Column) -> Column:
    """The 22 letters and digits of a track id in any writing, else null."""
    text = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?i)%3A|%2F", ":")
    return F.nullif(F.regexp_extract(text, r"(?<![A-Za-z0-9])([A-Za-z0-9]{22})(?![A-Za-z0-9])", 1), F.lit(""))


def grouped(rows: DataFrame) -> DataFrame:
    """``rows`` with ``group_key``: the smallest key of the component, or the row id."""
    record = F.when(real(F.col("recording_id")), F.concat(F.lit("R:"), clean(F.col("recording_id"))))
    track = F.concat(F.lit("T:"), track_key(F.col("spotify_track_id")))
    keyed = rows.withColumn("__r", record).withColumn("__t", track)
    pairs = keyed.select(F.coalesce("__r", "__t").alias("u"), F.coalesce("__t", "__r").alias("v")).distinct()
    roots = materialize(components(pairs).toDF("__node", "__root"))
    return (
        keyed.withColumn("__node", F.coalesce("__r", "__t")).join(roots, "__node", "left")
        .withColumn("group_key", F.coalesce("__root", F.concat(F.lit("row:"), F.col("row_id").cast("string"))))
        .drop("__r", "__t", "__node", "__root")
    )


def _rank() -> list[Column]:
    complete = sum((real(F.col(c)).cast("int") for c in COMPLETENESS), F.lit(0))
    state = F.lower(clean(F.col("whosampled_match_status")))
    trust = F.lit(0)
    for name, level in TRUST.items():
        trust = F.when(state == name, level).otherwise(trust)
    return [complete.alias("n_real"), trust.alias("trust")]


def _order() -> list[Column]:
    return [F.desc_nulls_last("n_real"), F.desc("trust"), F.desc_nulls_last("collected_at"), F.desc_nulls_last("loaded_at"), F.asc("row_id")]


def survivors(groups: DataFrame) -> DataFrame:
    """(group_key, survivor_row_id): the top record of every group."""
    window = Window.partitionBy("group_key").orderBy(*_order())
    return (
        groups.withColumn("place", F.row_number().over(window)).where("place = 1")
        .select("group_key", F.col("row_id").alias("survivor_row_id"))
    )


def _narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "recordings")
    return materialize(
        grouped(rows.select("row_id", "recording_id", "spotify_track_id", "collected_at", "loaded_at", *_rank()))
        .select("group_key", "row_id", "n_real", "trust", "collected_at", "loaded_at")
    )


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = _narrow(spark, sf_dir)
    return (
        groups.select("group_key", "row_id").join(survivors(groups), "group_key")
        .where("row_id <> survivor_row_id")
        .select(
            F.least("row_id", "survivor_row_id").alias("row_id_a"),
            F.greatest("row_id", "survivor_row_id").alias("row_id_b"),
            "survivor_row_id",
        )
    )


def p1_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record per recording: each field from the best-ranked row that has a real value."""
    rows = table(spark, sf_dir, "recordings")
    own = {"row_id", "collected_at", "loaded_at", "group_key", "survivor_row_id", "n_rows", "n_real", "trust"}
    fields = [c for c in rows.columns if c not in own]
    ranked = grouped(rows.select("row_id", "collected_at", "loaded_at", *fields, *_rank()))
    # A tuple that sorts as the ranking does; max_by is combined before the shuffle.
    order = F.struct("n_real", "trust", "collected_at", "loaded_at", (-F.col("row_id")).alias("r"))
    best = [
        F.max_by(F.col(c), F.when(real(F.col(c).cast("string")), order)).alias(c) for c in fields
    ]
    return ranked.groupBy("group_key").agg(
        F.max_by("row_id", order).alias("survivor_row_id"), F.count("*").alias("n_rows"), *best
    )


QUERIES = {"p1_found": p1_found, "p1_golden": p1_golden}


def _sql_real(c: str) -> str:
    text = f"lower(trim(coalesce({c}, '')))"
    listed = ", ".join(f"'{x}'" for x in ["", *PLACEHOLDERS])
    return (
        f"NOT ({text} IN ({listed}) OR regexp_full_match({text}, "
        "'unknown( (album|artist|label|title|genre|year|value))?'))"
    )


_GROUPS = f"""
WITH RECURSIVE keyed AS (
  SELECT row_id, collected_at, loaded_at, lower(trim(coalesce(whosampled_match_status, ''))) AS state,
         CASE WHEN {_sql_real("recording_id")} THEN 'R:' || recording_id END AS r,
         'T:' || nullif(regexp_extract(coalesce(spotify_track_id, ''), '(^|[^A-Za-z0-9])([A-Za-z0-9]{{22}})([^A-Za-z0-9]|$)', 2), '') AS t,
         {" + ".join(f"CAST({_sql_real(c)} AS int)" for c in COMPLETENESS)} AS n_real
  FROM recordings),
edge AS (SELECT DISTINCT r AS u, t AS v FROM keyed WHERE r IS NOT NULL AND t IS NOT NULL
         UNION SELECT DISTINCT t, r FROM keyed WHERE r IS NOT NULL AND t IS NOT NULL),
reach AS (
  SELECT DISTINCT coalesce(r, t) AS node, coalesce(r, t) AS root FROM keyed WHERE coalesce(r, t) IS NOT NULL
  UNION SELECT DISTINCT t, t FROM keyed WHERE t IS NOT NULL
  UNION SELECT e.v, x.root FROM reach x JOIN edge e ON e.u = x.node),
root AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
grp AS (SELECT k.*, coalesce(o.root, 'row:' || row_id) AS g FROM keyed k LEFT JOIN root o ON o.node = coalesce(k.r, k.t)),
best AS (SELECT *, first_value(row_id) OVER w AS top, row_number() OVER w AS place FROM grp WINDOW w AS (PARTITION BY g ORDER BY n_real DESC,
         CASE state WHEN 'matched' THEN 3 WHEN 'review' THEN 2 WHEN 'unresolved' THEN 1 ELSE 0 END DESC,
         collected_at DESC NULLS LAST, loaded_at DESC NULLS LAST, row_id))
"""

_SPOTIFY = [f"spotify_{x}" for x in "track_id uri url isrc album_name album_id album_release_date album_release_precision album_image_url album_label duration_ms".split()]
_PAGE = [f"whosampled_{x}" for x in "match_status url title artist_names album label release_year duration genre keywords thumbnail_url thumbnail_path thumbnail_status".split()]
_OTHER = "recording_id title artist_names album label release_year duration genre keywords youtube_video_id youtube_url youtube_thumbnail_url musicbrainz_recording_id musicbrainz_release_id musicbrainz_country musicbrainz_label".split()

SQL = {
    "p1_found": _GROUPS + "SELECT least(row_id, top) AS row_id_a, greatest(row_id, top) AS row_id_b, top AS survivor_row_id FROM best WHERE row_id <> top",
    "p1_golden": _GROUPS + "SELECT b.g AS group_key, min(b.top) AS survivor_row_id, count(*) AS n_rows, " + ", ".join(
        f"arg_min(r.{c}, CASE WHEN {_sql_real(f'CAST(r.{c} AS varchar)')} THEN b.place END) AS {c}" for c in [*_OTHER, *_SPOTIFY, *_PAGE]
    ) + " FROM best b JOIN recordings r ON r.row_id = b.row_id GROUP BY b.g",
}
