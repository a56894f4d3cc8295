"""Queries over whole tables for the operators of the survey, each beside the SQL that must agree."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crateloom.functions import keys as K
from crateloom.functions import similarity as S
from crateloom.functions import titles as TT
from crateloom.functions.text import clean, collapse, fold_ascii_udf, fold_identity_udf, fold_unicode_udf, fold_words_udf
from crateloom.operators import frames as O
from crateloom.operators import integrity as I
from crateloom.runtime import table
from crateloom.sources import html as H

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(*names: str, sql: str | None = None):
    """Register a query that gets the named tables."""

    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(*[table(spark, sf_dir, n) for n in names])

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql:
            SQL[fn.__name__] = sql
        return run

    return register


def c(x: str) -> str:
    """SQL of ``clean``."""
    return rf"regexp_replace(coalesce({x}, ''), '^[\s\p{{Z}}\x{{85}}]+|[\s\p{{Z}}\x{{85}}]+$', '', 'g')"


# ---- keys and addresses

@query("recordings", sql=f"SELECT row_id, 'REC_' || substr(sha1('spotify:' || {c('spotify_track_id')}), 1, 16) AS stable_id FROM recordings")
def key_stable_id(r):
    return r.select("row_id", K.stable_id("REC_", "spotify", clean(F.col("spotify_track_id"))).alias("stable_id"))


@query("credits", sql="""SELECT 'CRD_' || substr(sha1(concat_ws('|', coalesce(recording_id, ''), coalesce(artist_id, ''), coalesce(role, ''))), 1, 16) AS credit_key,
count(*) AS n FROM credits GROUP BY 1""")
def key_credit_parts(cr):
    k = K.parts_id("CRD", F.col("recording_id"), F.col("artist_id"), F.col("role"))
    return cr.groupBy(k.alias("credit_key")).agg(F.count("*").alias("n"))


@query("recordings", sql="SELECT row_id, 'PROP_' || substr(sha256(concat_ws('|', coalesce(recording_id, ''), 'spotify', coalesce(spotify_track_id, ''))), 1, 16) AS proposal_id FROM recordings")
def key_proposal(r):
    return r.select("row_id", K.proposal_id(F.col("recording_id"), F.lit("spotify"), F.col("spotify_track_id")).alias("proposal_id"))


@query("recordings", sql=rf"""WITH u AS (SELECT row_id, {c('whosampled_url')} AS u FROM recordings),
b AS (SELECT row_id, u, regexp_replace(u, '[?#].*$', '') AS bare FROM u),
a AS (SELECT *, CASE WHEN regexp_matches(bare, '^https?://') THEN bare ELSE 'https://pages.example/' || regexp_replace(bare, '^/+', '') END AS abs FROM b)
SELECT row_id, lower(regexp_replace(u, '/+$', '')) AS url_plain, CASE WHEN u = '' THEN '' ELSE regexp_replace(u, '/+$', '') || '/' END AS url_slash,
CASE WHEN bare = '' THEN '' ELSE regexp_replace(regexp_replace(abs, '([^:])/{{2,}}', '\1/', 'g'), '/+$', '') || '/' END AS url_absolute FROM a""")
def url_keys(r):
    u = F.col("whosampled_url")
    return r.select("row_id", K.url_key_plain(u).alias("url_plain"), K.url_slash(u).alias("url_slash"), K.url_absolute(u).alias("url_absolute"))


@query("relationships", sql=rf"""WITH u AS (SELECT {c('whosampled_relationship_url')} AS u FROM relationships)
SELECT CASE WHEN lower(u) LIKE '%/sample/%' THEN 'sampled' WHEN lower(u) LIKE '%/cover/%' THEN 'covered' WHEN lower(u) LIKE '%/interpolation/%' THEN 'interpolated'
WHEN lower(u) LIKE '%/remix/%' THEN 'remixed' ELSE '' END AS relation_type,
CASE WHEN lower(u) LIKE '%/sample/%' THEN 'sampled' WHEN lower(u) LIKE '%/cover/%' THEN 'covers' WHEN lower(u) LIKE '%/interpolation/%' THEN 'interpolates'
WHEN lower(u) LIKE '%/remix/%' THEN 'remix' ELSE '' END AS page_type, regexp_extract(u, '/(sample|cover|remix|interpolation)s?/(\d+)', 1) AS kind,
count(*) AS n, count(DISTINCT regexp_extract(u, '/(sample|cover|remix|interpolation)s?/(\d+)', 2)) AS n_numbers FROM u GROUP BY 1, 2, 3""")
def url_relations(rel):
    u = F.col("whosampled_relationship_url")
    identity = K.relation_identity(u)
    return rel.groupBy(K.relation_type(u).alias("relation_type"), K.relation_of_page(u, F.lit("")).alias("page_type"), identity["kind"].alias("kind")).agg(
        F.count("*").alias("n"), F.countDistinct(identity["number"]).alias("n_numbers"))


_FIRST = """WITH u AS (SELECT whosampled_url AS u, whosampled_name AS owner FROM artists UNION ALL SELECT whosampled_url, whosampled_artist_names FROM recordings UNION ALL SELECT whosampled_relationship_url, related_artist FROM relationships),
k AS (SELECT {u} AS u, lower(replace({o}, ' ', '-')) AS slug FROM u),
p AS (SELECT *, lower(regexp_extract(u, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)) AS host, list_filter(string_split(regexp_replace(regexp_replace(u, '^[a-z]+://[^/]+', ''), '[?#].*$', ''), '/'), lambda x: x <> '') AS p FROM k),
l AS (SELECT *, lower(coalesce(url_decode(p[1]), '')) AS a, lower(coalesce(url_decode(p[2]), '')) AS b FROM p)
SELECT CASE WHEN host <> '' AND host NOT IN ('pages.example', 'www.pages.example') THEN 'external' WHEN len(p) = 0 THEN 'site_root' WHEN a IN ('sample', 'cover', 'interpolation', 'remix') THEN 'relationship_detail'
WHEN a <> slug THEN 'other' """.format(u=c("u"), o=c("owner"))


def _owned(a, r, rel):
    parts = [a.select(F.col("whosampled_url").alias("u"), F.col("whosampled_name").alias("owner")), r.select(F.col("whosampled_url").alias("u"), F.col("whosampled_artist_names").alias("owner")),
             rel.select(F.col("whosampled_relationship_url").alias("u"), F.col("related_artist").alias("owner"))]
    return O.union_all(parts).withColumn("slug", F.replace(clean(F.col("owner")), F.lit(" "), F.lit("-")))


@query("artists", "recordings", "relationships", sql=_FIRST + r"""WHEN len(p) = 1 AND regexp_matches(u, '\?(.*&)?[^=&#]+=[^&#]') THEN 'artist_pagination' WHEN len(p) = 1 THEN 'artist_profile'
WHEN b IN ('samples', 'sampled', 'sample', 'covers', 'covered', 'cover', 'remixes', 'remixed', 'remix', 'interpolations', 'interpolated', 'interpolates', 'connections', 'credits', 'appearances', 'tracks', 'songs') THEN 'artist_catalog_page'
WHEN len(p) = 2 THEN 'artist_track_candidate' ELSE 'artist_internal_other' END AS link_class, count(*) AS n FROM l GROUP BY 1""")
def url_link_classes(a, r, rel):
    return _owned(a, r, rel).groupBy(K.link_class(F.col("u"), F.col("slug")).alias("link_class")).agg(F.count("*").alias("n"))


@query("artists", "recordings", "relationships", sql=_FIRST + """WHEN len(p) = 1 THEN 'artist_listing' WHEN b IN ('facts', 'samples', 'sampled', 'covers', 'covered', 'remixes', 'remixed', 'connections') THEN 'artist_subpage'
WHEN len(p) = 2 THEN 'track_candidate' ELSE 'artist_internal_other' END AS link_class, count(*) AS n FROM l GROUP BY 1""")
def url_listing_classes(a, r, rel):
    return _owned(a, r, rel).groupBy(K.artist_link_class(F.col("u"), F.col("slug")).alias("link_class")).agg(F.count("*").alias("n"))


@query("credits", sql=f"""WITH x AS (SELECT lower({c('source_role')}) AS role FROM credits)
SELECT role AS source_role, CASE WHEN role IN ('producer', 'producer(s)') THEN 'produced_by' WHEN role IN ('composer', 'composer(s)') THEN 'composed_by'
WHEN role IN ('lyricist', 'lyricist(s)', 'songwriter', 'songwriter(s)') THEN 'written_by' WHEN role IN ('arranger', 'arranger(s)') THEN 'arranged_by'
WHEN role IN ('performer', 'performer(s)', 'vocalist', 'instrumentalist') THEN 'performed_by' WHEN role IN ('engineer', 'engineer(s)') THEN 'engineered_by'
WHEN role IN ('mixer', 'mix engineer') THEN 'mixed_by' WHEN role = 'remixer' THEN 'remixed_by' ELSE replace(role, ' ', '_') END AS canonical_role, count(*) AS n FROM x GROUP BY 1, 2""")
def role_canonical(cr):
    return cr.groupBy(F.lower(clean(F.col("source_role"))).alias("source_role"), K.canonical_role(F.col("source_role")).alias("canonical_role")).agg(F.count("*").alias("n"))


# ---- titles, dates, numbers

@query("spotify_tracks", sql=rf"SELECT entry_id, {c('title')} AS cleaned, trim(regexp_replace(coalesce(title, ''), '[\s\p{{Z}}\x{{85}}]+', ' ', 'g')) AS collapsed FROM spotify_tracks")
def text_clean(t):
    return t.select("entry_id", clean(F.col("title")).alias("cleaned"), collapse(F.col("title")).alias("collapsed"))


def _suffixes() -> str:
    out = c("title")
    for p in (r"(?i)\s*-\s*\d{4}\s+digital\s+remaster.*$", r"(?i)\s*-\s*remaster(ed|izado|izada)?.*$", r"(?i)\s*\(\s*remaster(ed)?[^)]*\)\s*$", r"(?i)\s*\[\s*remaster(ed)?[^\]]*\]\s*$",
              r"(?i)\s*-\s*radio\s+edit\s*$", r"(?i)\s*-\s*single\s+version\s*$", r"(?i)\s*-\s*album\s+version\s*$"):
        out = f"regexp_replace({out}, '{p}', '', 'g')"
    return out


@query("spotify_tracks", sql=f"SELECT entry_id, trim({_suffixes()}) AS base_title FROM spotify_tracks")
def title_without_version(t):
    return t.select("entry_id", TT.without_version(F.col("title")).alias("base_title"))


@query("spotify_tracks", sql="""WITH v AS (SELECT unnest(['remix', 'remastered', 'remaster', 'spotify singles', 'live', 'acoustic', 'instrumental', 'demo', 'edit', 'radio edit', 'extended', 'extended mix', 'mono', 'stereo', 'karaoke', 'slowed', 'sped up', 'speed up']) AS term)
SELECT term, count(*) AS n FROM spotify_tracks JOIN v ON contains(lower(coalesce(title, '')), term) GROUP BY 1""")
def title_version_terms(t):
    return t.select(F.explode(TT.version_terms(F.lower(clean(F.col("title"))))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


@query("artist_catalog_recordings_parsed", sql=rf"""WITH x AS (SELECT recording_id, {c('whosampled_duration_iso')} AS iso, {c('whosampled_duration')} AS clock, {c('whosampled_release_year')} AS y, {c('whosampled_duration_ms')} AS ms FROM artist_catalog_recordings_parsed),
p AS (SELECT *, '^PT(?:(\d+(?:\.\d+)?)H)?(?:(\d+(?:\.\d+)?)M)?(?:(\d+(?:\.\d+)?)S)?$' AS pat FROM x)
SELECT DISTINCT recording_id, CASE WHEN iso <> 'PT' AND regexp_matches(iso, '^PT(?:(\d+(?:\.\d+)?)H)?(?:(\d+(?:\.\d+)?)M)?(?:(\d+(?:\.\d+)?)S)?$') THEN CAST(round_even(1000 * (
 coalesce(try_cast(regexp_extract(iso, '(\d+(?:\.\d+)?)H', 1) AS double), 0) * 3600 + coalesce(try_cast(regexp_extract(iso, '(\d+(?:\.\d+)?)M', 1) AS double), 0) * 60 + coalesce(try_cast(regexp_extract(iso, '(\d+(?:\.\d+)?)S', 1) AS double), 0)), 0) AS bigint) END AS iso_ms,
CASE WHEN regexp_matches(clock, '^\d+:\d\d$') THEN CAST(split_part(clock, ':', 1) AS bigint) * 60 + CAST(split_part(clock, ':', 2) AS bigint) END AS clock_s,
try_cast(nullif(regexp_extract(y, '\b(?:18|19|20)\d\d\b', 0), '') AS int) AS year, CAST(round_even(try_cast(ms AS double), 0) AS bigint) AS rounded, CAST(trunc(try_cast(ms AS double)) AS bigint) AS truncated FROM p""")
def dates_and_durations(p):
    return p.select(
        "recording_id", TT.iso_duration_ms(F.col("whosampled_duration_iso")).alias("iso_ms"), TT.clock_seconds(F.col("whosampled_duration")).alias("clock_s"),
        TT.year_of(F.col("whosampled_release_year")).alias("year"), TT.rounded_int(F.col("whosampled_duration_ms")).alias("rounded"),
        TT.truncated_int(F.col("whosampled_duration_ms")).alias("truncated"),
    ).distinct()


@query("spotify_tracks", sql="""SELECT entry_id, CASE WHEN duration_ms > 0 THEN CAST(duration_ms // 60000 AS varchar) || ':' || lpad(CAST(CAST(round_even((duration_ms % 60000) / 1000.0, 0) AS bigint) AS varchar), 2, '0') END AS clock FROM spotify_tracks""")
def duration_text(t):
    return t.select("entry_id", TT.clock_text(F.col("duration_ms")).alias("clock"))


# ---- arrays

@query("spotify_tracks", sql="""WITH x AS (SELECT entry_id, CASE WHEN coalesce(artists_json, '') LIKE '[%' THEN json_array_length(artists_json) ELSE 0 END AS n_json,
list_filter(list_transform(regexp_split_to_array(trim(coalesce(artist_ids, '')), '\\s*[,;|]\\s*|\\s+/\\s+'), lambda v: trim(v)), lambda v: v <> '') AS ids,
list_filter(list_transform(regexp_split_to_array(trim(coalesce(artist_names, '')), '\\s*[,;|]\\s*|\\s+/\\s+'), lambda v: trim(v)), lambda v: v <> '') AS names, artists_json FROM spotify_tracks)
SELECT entry_id, CAST(CASE WHEN n_json > 0 THEN n_json WHEN len(ids) = 1 THEN 1 WHEN len(ids) = len(names) THEN len(ids) ELSE 0 END AS int) AS n_artists,
CASE WHEN n_json > 0 THEN json_extract_string(artists_json, '$[0].id') WHEN len(ids) = 1 OR (len(ids) > 0 AND len(ids) = len(names)) THEN ids[1] END AS first_id FROM x""")
def parse_artist_pairs(t):
    pairs = O.parse_artists(F.col("artists_json"), F.col("artist_ids"), F.col("artist_names"))
    return t.select("entry_id", pairs.alias("p")).select("entry_id", F.size("p").alias("n_artists"), F.try_element_at("p", F.lit(1))["id"].alias("first_id"))


@query("recordings", sql=rf"""SELECT v AS keyword, count(*) AS n FROM (SELECT unnest(list_distinct(list_filter(list_transform(regexp_split_to_array({c('keywords')}, '\s*[,;|]\s*|\s+/\s+'), lambda x: lower(trim(x))), lambda x: x <> ''))) AS v FROM recordings) GROUP BY 1""")
def keyword_counts(r):
    values = O.ordered_unique(O.split_list(F.lower(F.col("keywords"))))
    return r.select(F.explode(values).alias("keyword")).groupBy("keyword").agg(F.count("*").alias("n"))


# ---- scores and decisions

_PAIR = rf"""WITH t AS (SELECT nullif({c('spotify_track_id')}, '') AS tid, max(duration_ms) AS ms, min(try_cast(substr(album_release_date, 1, 4) AS int)) AS y FROM spotify_tracks GROUP BY 1),
p AS (SELECT row_id, r.spotify_duration_ms AS a, t.ms AS b, try_cast({c('release_year')} AS int) AS ya, t.y AS yb FROM recordings r JOIN t ON t.tid = {c('r.spotify_track_id')})"""


def _pairs(r, t):
    tracks = t.where(O.key("spotify_track_id").isNotNull()).groupBy(O.key("spotify_track_id").alias("tid")).agg(
        F.max("duration_ms").alias("b"), F.min(F.substring("album_release_date", 1, 4).try_cast("int")).alias("yb"))
    return r.select("row_id", O.key("spotify_track_id").alias("tid"), F.col("spotify_duration_ms").alias("a"), clean(F.col("release_year")).try_cast("int").alias("ya")).join(tracks, "tid")


def _case(expr: str, steps, beyond="0.0") -> str:
    return f"CASE WHEN {expr} IS NULL THEN NULL " + " ".join(f"WHEN {expr} <= {a} THEN {b}" for a, b in steps) + f" ELSE {beyond} END"


_D = "CASE WHEN a > 0 AND b > 0 THEN abs(a - b) / 1000.0 END"
#: The step tables of the SQL, written out on their own.
_DURATION_A = [(2, 1.0), (5, 0.95), (10, 0.85), (20, 0.65), (30, 0.45), (60, 0.2)]
_DURATION_B = [(2, 1.0), (5, 0.9), (10, 0.7), (20, 0.4)]
_YEAR_A = [(0, 1.0), (2, 0.8), (5, 0.45)]
_YEAR_B = [(0, 1.0), (1, 0.5), (3, 0.25)]


@query("recordings", "spotify_tracks", sql=_PAIR + f""" SELECT row_id, CAST({_case(f"({_D})", _DURATION_A)} AS double) AS duration_a, CAST({_case(f"({_D})", _DURATION_B)} AS double) AS duration_b,
CAST({_case("abs(ya - yb)", _YEAR_A)} AS double) AS year_a, CAST({_case("abs(ya - yb)", _YEAR_B)} AS double) AS year_b, coalesce(ya <> yb, false) AS year_conflict, CAST(CASE WHEN ya = yb THEN 1 ELSE 0 END AS double) AS year_c FROM p""")
def score_buckets(r, t):
    a, b, ya, yb = map(F.col, ("a", "b", "ya", "yb"))
    return _pairs(r, t).select("row_id", S.duration_score(a, b).alias("duration_a"), S.duration_score(a, b, S.DURATION_B).alias("duration_b"),
                               S.year_score(ya, yb).alias("year_a"), S.year_score(ya, yb, S.YEAR_B).alias("year_b"), S.year_conflict(ya, yb).alias("year_conflict"), S.year_equal(ya, yb).alias("year_c"))


_CAND = rf"""WITH c AS (SELECT {c('recording_id')} AS source_id, lower(min({c('whosampled_title')})) AS title, lower(min({c('whosampled_artist_names')})) AS artist, lower(min({c('whosampled_album')})) AS album,
 min(try_cast(nullif(regexp_extract({c('whosampled_release_year')}, '\b(?:18|19|20)\d\d\b', 0), '') AS int)) AS y, min(CAST(round_even(try_cast({c('whosampled_duration_ms')} AS double), 0) AS bigint)) AS ms
 FROM artist_catalog_recordings_parsed WHERE {c('recording_id')} <> '' GROUP BY 1),
t AS (SELECT {c('spotify_track_id')} AS other, lower(min({c('title')})) AS title, lower(min({c('artist_names')})) AS artist, lower(min({c('album_name')})) AS album,
 min(try_cast(nullif(regexp_extract({c('album_release_date')}, '\b(?:18|19|20)\d\d\b', 0), '') AS int)) AS y, min(CAST(duration_ms AS bigint)) AS ms FROM spotify_tracks WHERE {c('spotify_track_id')} <> '' GROUP BY 1),
p AS (SELECT source_id, other, CASE WHEN c.artist <> '' AND t.artist <> '' THEN CASE WHEN c.artist = t.artist THEN 1.0 WHEN contains(c.artist, t.artist) OR contains(t.artist, c.artist) THEN 0.9 ELSE 0.0 END ELSE 0.0 END AS artist,
 abs(c.ms - t.ms) AS gap, {_case("abs(c.ms - t.ms) / 1000.0", _DURATION_A)} AS duration, {_case("abs(c.y - t.y)", _YEAR_A)} AS year, CASE WHEN c.album <> '' AND t.album <> '' THEN CASE WHEN c.album = t.album THEN 1.0 ELSE 0.0 END END AS album
 FROM c JOIN t ON c.title = t.title WHERE c.title <> ''),
e AS (SELECT source_id, other, gap, round((0.40 + artist * 0.35 + coalesce(duration * 0.15, 0) + coalesce(year * 0.05, 0) + coalesce(album * 0.05, 0))
 / (0.75 + CASE WHEN duration IS NULL THEN 0 ELSE 0.15 END + CASE WHEN year IS NULL THEN 0 ELSE 0.05 END + CASE WHEN album IS NULL THEN 0 ELSE 0.05 END), 6) AS score FROM p)"""


def _candidates(p, t):
    """Catalogue recordings and tracks of one title as candidates, with the five weights of the catalogue score.

    Titles are the blocks and equal; artists score 1, 0.9 where one text holds the other, or 0; albums 1 or 0. What is
    missing on a side is null and its weight goes to the others, so candidates without duration stay.
    """
    year = lambda x: F.min(TT.year_of(F.col(x))).alias("y")
    low = lambda x, n: F.lower(F.min(clean(F.col(x)))).alias(n)
    a = p.where(O.key("recording_id").isNotNull()).groupBy(O.key("recording_id").alias("source_id")).agg(
        low("whosampled_title", "title"), low("whosampled_artist_names", "artist"), low("whosampled_album", "album"), year("whosampled_release_year"), F.min(TT.rounded_int(F.col("whosampled_duration_ms"))).alias("ms"))
    b = t.where(O.key("spotify_track_id").isNotNull()).groupBy(O.key("spotify_track_id").alias("other")).agg(
        low("title", "title"), low("artist_names", "artist_b"), low("album_name", "album_b"), year("album_release_date").alias("y_b"), F.min(F.col("duration_ms").cast("bigint")).alias("ms_b"))
    x, z, m, n = map(F.col, ("artist", "artist_b", "album", "album_b"))
    gap = F.abs(F.col("ms") - F.col("ms_b"))
    scores = {
        "title": F.lit(1.0), "artist": F.when((x == "") | (z == ""), 0.0).when(x == z, 1.0).when(F.contains(x, z) | F.contains(z, x), 0.9).otherwise(0.0),
        "duration": S.steps(gap / 1000, S.DURATION_A), "year": S.year_score(F.col("y"), F.col("y_b")), "album": F.when((m != "") & (n != ""), (m == n).cast("double")),
    }
    return a.where("title <> ''").join(b, "title").select("source_id", "other", F.round(S.weighted(scores, S.CATALOG_WEIGHTS), 6).alias("score"), gap.alias("gap"))


@query("artist_catalog_recordings_parsed", "spotify_tracks", sql=_CAND + """, r AS (SELECT source_id, other, score, CAST(rank AS int) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY score DESC, other) AS rank FROM e WHERE score >= 0.45) WHERE rank <= 5)
SELECT c.source_id, r.other, r.score, r.rank, CASE WHEN r.other IS NULL THEN 'no_plausible_candidate' ELSE 'review' END AS candidate_status FROM c LEFT JOIN r USING (source_id)""")
def rank_top_candidates(p, t):
    kept = S.ranked(_candidates(p, t), "source_id", "score", "other").select("source_id", "other", "score", "rank")
    return S.with_empty(p.select(O.key("recording_id").alias("source_id")).where("source_id is not null").distinct(), kept, "source_id", "other")


@query("artist_catalog_recordings_parsed", "spotify_tracks", sql=_CAND + """, m AS (SELECT *, row_number() OVER w AS rank, score - coalesce(lead(score) OVER w, 0) AS margin FROM e WINDOW w AS (PARTITION BY source_id ORDER BY score DESC, other))
SELECT source_id, other, score, round(margin, 6) AS margin, CASE WHEN score >= 0.85 AND margin >= 0.05 THEN 'matched' WHEN score >= 0.75 THEN 'review' ELSE 'unmatched' END AS decision,
CASE WHEN score >= 0.90 AND margin >= 0.05 THEN 'HIGH_CONFIDENCE' WHEN score >= 0.75 THEN 'REVIEW' ELSE 'NO_CONFIDENT_MATCH' END AS cache_decision FROM m WHERE rank = 1""")
def decide_by_margin(p, t):
    best = S.with_margin(_candidates(p, t), "source_id", "score", "other")
    return best.select("source_id", "other", "score", F.round("margin", 6).alias("margin"), S.decision(F.col("score"), F.col("margin")).alias("decision"), S.cache_decision(F.col("score"), F.col("margin")).alias("cache_decision"))


@query("artist_catalog_recordings_parsed", "spotify_tracks", sql=_CAND + """, q AS (SELECT *, score >= max(score) OVER (PARTITION BY source_id) - 0.03 AS near FROM e),
b AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY near DESC, CASE WHEN near THEN gap END ASC NULLS LAST, score DESC, other) = 1 AS first FROM q),
o AS (SELECT *, row_number() OVER w AS rank, score - coalesce(lead(score) OVER w, 0) AS margin FROM b WINDOW w AS (PARTITION BY source_id ORDER BY first DESC, score DESC, other))
SELECT source_id, other, CAST(rank AS int) AS rank, round(margin, 6) AS margin FROM o""")
def duration_tiebreak(p, t):
    return S.duration_tiebreak(_candidates(p, t), "source_id", "score", "gap", "other").select("source_id", "other", "rank", F.round("margin", 6).alias("margin"))


# ---- joins

@query("credits", "recordings", sql=f"""WITH l AS (SELECT {c('recording_id')} AS k, max_by(coalesce(title, ''), row_id) AS title FROM recordings WHERE {c('recording_id')} <> '' GROUP BY 1)
SELECT l.title, count(*) AS n_credits FROM credits x LEFT JOIN l ON l.k = nullif({c('x.recording_id')}, '') GROUP BY 1""")
def join_last_wins(cr, r):
    named = r.withColumn("title", F.coalesce("title", F.lit("")))
    return O.lookup(cr.select("recording_id"), named, "recording_id", {"title": "title_"}, "row_id").groupBy(F.col("title_").alias("title")).agg(F.count("*").alias("n_credits"))


@query("credits", "recordings", sql=f"""WITH l AS (SELECT {c('recording_id')} AS k, min_by(coalesce(title, ''), row_id) AS title FROM recordings WHERE {c('recording_id')} <> '' GROUP BY 1)
SELECT l.title, count(*) AS n_credits FROM credits x LEFT JOIN l ON l.k = nullif({c('x.recording_id')}, '') GROUP BY 1""")
def join_first_wins(cr, r):
    named = r.withColumn("title", F.coalesce("title", F.lit("")))
    return O.lookup(cr.select("recording_id"), named, "recording_id", {"title": "title_"}, "row_id", last=False).groupBy(F.col("title_").alias("title")).agg(F.count("*").alias("n_credits"))


@query("credits", "artists", sql=f"""WITH a AS (SELECT {c('artist_id')} AS artist_id, min({c('canonical_name')}) AS name FROM artists WHERE {c('artist_id')} <> '' GROUP BY 1)
SELECT a.name, count(*) AS n FROM credits x LEFT JOIN a ON a.artist_id = nullif({c('x.artist_id')}, '') GROUP BY 1""")
def join_many_to_one(cr, a):
    one = a.where(O.key("artist_id").isNotNull()).groupBy(O.key("artist_id").alias("artist_id")).agg(F.min(clean(F.col("canonical_name"))).alias("name"))
    return O.many_to_one(cr.select(O.key("artist_id").alias("artist_id")), one, ["artist_id"]).groupBy("name").agg(F.count("*").alias("n"))


_NAME = f"""a AS (SELECT lower({c('canonical_name')}) AS k, min({c('artist_id')}) AS lo, max({c('artist_id')}) AS hi FROM artists WHERE {c('canonical_name')} <> '' AND {c('artist_id')} <> '' GROUP BY 1)"""


@query("credits", "artists", sql=f"""WITH {_NAME} SELECT CASE WHEN lo IS NULL THEN 'unresolved' WHEN lo = hi THEN 'resolved' ELSE 'ambiguous' END AS match_status,
CASE WHEN lo = hi THEN lo END AS match_id, count(*) AS n FROM credits x LEFT JOIN a ON a.k = nullif(lower({c('x.artist_name')}), '') GROUP BY 1, 2""")
def join_unique_match(cr, a):
    out = O.unique_match(cr.select("artist_name"), F.lower(clean(F.col("artist_name"))), a, F.lower(clean(F.col("canonical_name"))), "artist_id")
    return out.groupBy("match_status", "match_id").agg(F.count("*").alias("n"))


@query("credits", "artists", sql=f"""WITH {_NAME}, i AS (SELECT DISTINCT {c('artist_id')} AS id FROM artists WHERE {c('artist_id')} <> ''),
w AS (SELECT lower({c('whosampled_name')}) AS k, min({c('artist_id')}) AS lo, max({c('artist_id')}) AS hi FROM artists WHERE {c('whosampled_name')} <> '' AND {c('artist_id')} <> '' GROUP BY 1),
j AS (SELECT i.id AS i_id, a.lo AS alo, a.hi AS ahi, w.lo AS wlo, w.hi AS whi FROM credits x LEFT JOIN i ON i.id = nullif({c('x.artist_id')}, '')
LEFT JOIN a ON a.k = nullif(lower({c('x.artist_name')}), '') LEFT JOIN w ON w.k = nullif(lower({c('x.artist_name')}), ''))
SELECT CASE WHEN i_id IS NOT NULL THEN 'exact_id' WHEN alo IS NOT NULL THEN 'exact_name' WHEN wlo IS NOT NULL THEN 'page_name' ELSE '' END AS resolution_method,
CASE WHEN i_id IS NOT NULL THEN 'resolved' WHEN alo IS NOT NULL THEN CASE WHEN alo = ahi THEN 'resolved' ELSE 'ambiguous' END
WHEN wlo IS NOT NULL THEN CASE WHEN wlo = whi THEN 'resolved' ELSE 'ambiguous' END ELSE 'unresolved' END AS resolution_status, count(*) AS n FROM j GROUP BY 1, 2""")
def join_precedence_ladder(cr, a):
    name, page = F.lower(clean(F.col("canonical_name"))), F.lower(clean(F.col("whosampled_name")))
    typed = F.lower(clean(F.col("artist_name")))
    out = O.ladder(cr.select("artist_id", "artist_name"), [
        ("exact_id", clean(F.col("artist_id")), a.select(F.col("artist_id").alias("aid")), clean(F.col("aid")), "aid"),
        ("exact_name", typed, a, name, "artist_id"), ("page_name", typed, a, page, "artist_id"),
    ])
    return out.groupBy("resolution_method", "resolution_status").agg(F.count("*").alias("n"))


@query("relationships", "recordings", sql=f"""SELECT relationship_id, source_recording_id, target_recording_id FROM relationships r
WHERE {c('source_recording_id')} IN (SELECT recording_id FROM recordings) AND {c('target_recording_id')} <> '' AND {c('target_recording_id')} NOT IN (SELECT recording_id FROM recordings WHERE recording_id IS NOT NULL)""")
def join_semi_anti(rel, r):
    ids = r.where(O.key("recording_id").isNotNull()).select(F.col("recording_id").alias("id")).distinct()
    kept = rel.join(ids, clean(F.col("source_recording_id")) == F.col("id"), "left_semi").where(clean(F.col("target_recording_id")) != "")
    return kept.join(ids, clean(F.col("target_recording_id")) == F.col("id"), "left_anti").select("relationship_id", "source_recording_id", "target_recording_id")


# ---- grouping, deduplication, sets

@query("credits", sql=f"""SELECT recording_id, artist_name, string_agg(DISTINCT {c('role')}, '|' ORDER BY {c('role')}) AS roles, count(*) AS n_assertions, CAST(min(artist_order) AS int) AS first_order,
count(DISTINCT artist_order) > 1 AS order_conflict FROM credits WHERE {c('recording_id')} <> '' GROUP BY 1, 2""")
def group_evidence(cr):
    # The set of roles is bounded by the vocabulary of roles, whatever the size of the group.
    return cr.where(clean(F.col("recording_id")) != "").groupBy("recording_id", "artist_name").agg(
        F.array_join(F.array_sort(F.collect_set(clean(F.col("role")))), "|").alias("roles"), F.count("*").alias("n_assertions"),
        F.min("artist_order").alias("first_order"), (F.countDistinct("artist_order") > 1).alias("order_conflict"))


@query("recordings", sql=f"SELECT lower({c('whosampled_match_status')}) AS status, count(*) AS n, count(DISTINCT recording_id) AS n_ids FROM recordings GROUP BY 1")
def status_counts(r):
    return r.groupBy(F.lower(clean(F.col("whosampled_match_status"))).alias("status")).agg(F.count("*").alias("n"), F.countDistinct("recording_id").alias("n_ids"))


_COVER = ["recording_id", "title", "artist_names", "album", "label", "release_year", "genre", "spotify_track_id", "whosampled_url", "musicbrainz_recording_id"]


@query("recordings", sql=" UNION ALL ".join(f"SELECT '{x}' AS column_name, count(*) AS n_rows, count(*) FILTER ({c(x)} <> '') AS n_filled FROM recordings" for x in _COVER))
def coverage(r):
    return I.coverage(r, _COVER)


@query("credits", sql="SELECT count(*) AS n, count(DISTINCT credit_id) AS n_distinct, count(*) - count(DISTINCT credit_id) AS n_repeated FROM credits")
def repeated_occurrences(cr):
    return cr.agg(F.count("*").alias("n"), F.countDistinct("credit_id").alias("n_distinct")).withColumn("n_repeated", F.col("n") - F.col("n_distinct"))


@query("recordings", sql="SELECT recording_id, row_id, title FROM recordings QUALIFY row_number() OVER (PARTITION BY recording_id ORDER BY row_id) = 1")
def dedup_first_wins(r):
    return O.first_wins(r.select("recording_id", "row_id", "title"), ["recording_id"], "row_id")


@query("recordings", sql="SELECT recording_id, min(row_id) AS row_id, arg_max_null(title, row_id) AS title FROM recordings GROUP BY 1")
def dedup_last_wins(r):
    return O.last_wins(r.select("recording_id", "row_id", "title"), ["recording_id"], "row_id")


@query("credits", sql="SELECT count(*) AS n_rows FROM (SELECT DISTINCT * FROM credits)")
def dedup_whole_rows(cr):
    return cr.dropDuplicates().agg(F.count("*").alias("n_rows"))


@query("recordings", sql="SELECT recording_id, count(*) AS n FROM recordings GROUP BY 1 HAVING count(*) > 1")
def duplicate_gate(r):
    return r.groupBy("recording_id").agg(F.count("*").alias("n")).where("n > 1")


@query("spotify_tracks", sql="SELECT spotify_track_id, arg_max(title, (length(title), title)) AS title FROM spotify_tracks WHERE title IS NOT NULL GROUP BY 1")
def dedup_longest_title(t):
    return O.longest_wins(t.where("title is not null").select("spotify_track_id", "title"), ["spotify_track_id"], "title")


@query("artists", "credits", sql=f"SELECT DISTINCT {c('artist_name')} AS name FROM credits WHERE {c('artist_name')} <> '' EXCEPT SELECT {c('canonical_name')} FROM artists")
def set_difference(a, cr):
    return cr.select(clean(F.col("artist_name")).alias("name")).where("name <> ''").subtract(a.select(clean(F.col("canonical_name"))))


@query("artists", "credits", sql=f"SELECT {c('artist_name')} AS name FROM credits WHERE {c('artist_name')} <> '' INTERSECT SELECT {c('canonical_name')} FROM artists")
def set_intersection(a, cr):
    return cr.select(clean(F.col("artist_name")).alias("name")).where("name <> ''").intersect(a.select(clean(F.col("canonical_name"))))


# ---- merges, state, integrity

_MERGE = ["title", "album", "label", "release_year"]
_LIB = "SELECT recording_id, " + ", ".join(f"coalesce({x}, '') AS {x}" for x in _MERGE) + " FROM recordings QUALIFY row_number() OVER (PARTITION BY recording_id ORDER BY row_id {}) = 1"


def _sides(r):
    part = r.select("recording_id", "row_id", *[F.coalesce(x, F.lit("")).alias(x) for x in _MERGE])
    first = O.first_wins(part, ["recording_id"], "row_id").drop("row_id")
    return first, O.last_wins(part, ["recording_id"], "row_id").drop("row_id")


def _sql_merge() -> str:
    parts = " UNION ALL ".join(f"""SELECT '{x}' AS column_name, CASE WHEN {c('l.' + x)} = {c('p.' + x)} THEN 'identical' WHEN {c('l.' + x)} = '' THEN 'enriched' WHEN {c('p.' + x)} = '' THEN 'preserved' ELSE 'conflict' END AS outcome FROM l JOIN p USING (recording_id)""" for x in _MERGE)
    return f"WITH l AS ({_LIB.format('')}), p AS ({_LIB.format('DESC')}) SELECT column_name, outcome, count(*) AS n FROM ({parts}) GROUP BY 1, 2"


@query("recordings", sql=_sql_merge())
def merge_cell_outcomes(r):
    """The last row of every id proposed to the library of first rows."""
    return O.merge_cells(*_sides(r), "recording_id")[1].groupBy("column_name", "outcome").agg(F.count("*").alias("n"))


@query("recordings", sql=f"WITH l AS ({_LIB.format('')}), p AS ({_LIB.format('DESC')}) SELECT recording_id, " + ", ".join(
    f"coalesce(nullif({c('l.' + x)}, ''), {c('p.' + x)}) AS {x}" for x in _MERGE) + " FROM l JOIN p USING (recording_id)")
def merge_cells(r):
    return O.merge_cells(*_sides(r), "recording_id")[0]


@query("recordings", sql=f"WITH l AS ({_LIB.format('')}), p AS ({_LIB.format('DESC')}) SELECT recording_id, p.title, p.album, l.label, l.release_year FROM l JOIN p USING (recording_id)")
def upsert(r):
    old, new = _sides(r)
    return O.upsert(old, new.select("recording_id", "title", "album"), "recording_id")


@query("recordings", sql=f"SELECT row_id, coalesce(nullif({c('title')}, ''), {c('whosampled_title')}) AS filled, coalesce(nullif({c('whosampled_title')}, ''), {c('title')}) AS overlaid FROM recordings")
def fill_and_overlay(r):
    t, w = F.col("title"), F.col("whosampled_title")
    return r.select("row_id", O.fill_from(t, w).alias("filled"), O.overlay(t, w).alias("overlaid"))


@query("recordings", "deleted_recordings", sql="""WITH r AS (SELECT * FROM recordings WHERE recording_id IS NULL OR recording_id NOT IN (SELECT recording_id FROM deleted_recordings WHERE recording_id IS NOT NULL))
SELECT row_id, recording_id FROM r WHERE recording_id IS NULL OR recording_id NOT IN (SELECT recording_id FROM r WHERE lower(whosampled_match_status) = 'matched' AND recording_id IS NOT NULL)""")
def resume_pending(r, gone):
    r = r.join(gone.select("recording_id").distinct(), "recording_id", "left_anti")
    done = r.where(F.lower("whosampled_match_status") == "matched").where("recording_id is not null")
    return O.resume(r.select("row_id", "recording_id"), done, ["recording_id"])


def _sql_fk(t: str, f: str, pt: str, pk: str, name: str) -> str:
    return f"SELECT '{name}' AS check_name, 'error' AS severity, count(*) AS failures FROM {t} WHERE {c(f)} <> '' AND {c(f)} NOT IN (SELECT {c(pk)} FROM {pt})"


@query("recordings", "artists", "credits", "relationships", sql="SELECT *, CASE WHEN failures = 0 THEN 'passed' WHEN severity = 'warning' THEN 'passed_with_warnings' ELSE 'failed' END AS verdict FROM (" + " UNION ALL ".join([
    "SELECT 'recordings_unique' AS check_name, 'error' AS severity, count(*) AS failures FROM (SELECT recording_id FROM recordings GROUP BY 1 HAVING count(*) > 1)",
    "SELECT 'artists_unique', 'error', count(*) FROM (SELECT artist_id FROM artists GROUP BY 1 HAVING count(*) > 1)",
    _sql_fk("credits", "recording_id", "recordings", "recording_id", "credit_recording"), _sql_fk("credits", "artist_id", "artists", "artist_id", "credit_artist"),
    _sql_fk("relationships", "source_recording_id", "recordings", "recording_id", "relationship_source"), _sql_fk("relationships", "target_recording_id", "recordings", "recording_id", "relationship_target"),
    f"SELECT 'credit_name_blank', 'warning', count(*) FROM credits WHERE {c('artist_name')} = ''"]) + ")")
def integrity_report(r, a, cr, rel):
    return I.report(
        I.duplicates(r, ["recording_id"], "recordings_unique"), I.duplicates(a, ["artist_id"], "artists_unique"),
        I.dangling(cr, "recording_id", r, "recording_id", "credit_recording"), I.dangling(cr, "artist_id", a, "artist_id", "credit_artist"),
        I.dangling(rel, "source_recording_id", r, "recording_id", "relationship_source"), I.dangling(rel, "target_recording_id", r, "recording_id", "relationship_target"),
        I.blanks(cr, "artist_name", "credit_name_blank"),
    )


# ---- archived pages: built from the tables, parsed back



def _escape(x):
    return F.replace(F.replace(F.replace(collapse(x), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))


def _pages(rel):
    t, u, a, y = (_escape(F.col(x)) for x in ("related_track", "whosampled_relationship_url", "related_artist", "year"))
    row = F.concat(F.lit('<html><body><table><tr><td><a class="trackName" href="'), u, F.lit('">'), t, F.lit('</a></td><td><a href="/Some-Artist/">'), a, F.lit("</a></td><td>"), y, F.lit("</td></tr></table></body></html>"))
    return rel.where((clean(F.col("whosampled_relationship_url")) != "") & (clean(F.col("related_track")) != "")).select(F.col("relationship_id").alias("url"), row.alias("html"))


@query("relationships", sql=rf"""WITH r AS (SELECT * FROM relationships WHERE {c('whosampled_relationship_url')} <> '' AND {c('related_track')} <> '')
SELECT DISTINCT relationship_id AS url, 1 AS position, trim(regexp_replace(related_track, '[\s\p{{Z}}\x{{85}}]+', ' ', 'g')) AS text, trim(regexp_replace(whosampled_relationship_url, '[\s\p{{Z}}\x{{85}}]+', ' ', 'g')) AS href, 'trackName' AS css_class FROM r
UNION SELECT DISTINCT relationship_id, 2, trim(regexp_replace(coalesce(related_artist, ''), '[\s\p{{Z}}\x{{85}}]+', ' ', 'g')), '/Some-Artist/', '' FROM r""")
def html_links(rel):
    return H.links(_pages(rel)).distinct()


@query("relationships", sql=rf"""SELECT count(*) AS n_links, count(DISTINCT trim(regexp_replace(whosampled_relationship_url, '[\s\p{{Z}}\x{{85}}]+', ' ', 'g'))) + 1 AS n_distinct FROM (SELECT whosampled_relationship_url FROM relationships
WHERE {c('whosampled_relationship_url')} <> '' AND {c('related_track')} <> '' UNION ALL SELECT '/Some-Artist/' FROM relationships WHERE {c('whosampled_relationship_url')} <> '' AND {c('related_track')} <> '') WHERE TRUE""".replace("+ 1 AS n_distinct", "AS n_distinct"))
def html_href_counts(rel):
    found = _pages(rel).select(F.explode(H.hrefs(F.col("html"))).alias("href"))
    return found.agg(F.count("*").alias("n_links"), F.countDistinct("href").alias("n_distinct"))


@query("relationships")
def html_relationships(rel):
    return H.relationships(_pages(rel)).distinct()


# ---- Unicode folds and sequence ratios: checked against plain Python in the tests

@query("artists")
def name_folds(a):
    n = F.col("canonical_name")
    return a.select("artist_id", n, fold_unicode_udf(n).alias("unicode_kept"), fold_ascii_udf(n).alias("ascii_fold"), fold_identity_udf(n).alias("identity_fold"), fold_words_udf(n).alias("words_fold")).distinct()


@query("artist_catalog_recordings_parsed")
def sequence_ratio(p):
    return p.where(O.key("spotify_title").isNotNull()).select("recording_id", "spotify_track_id", F.round(S.ratio_udf(fold_words_udf("whosampled_title"), fold_words_udf("spotify_title")), 6).alias("title_ratio")).distinct()


@query("spotify_tracks")
def title_variants(t):
    return t.select("title").distinct().select("title", F.posexplode(TT.title_variants_udf("title")).alias("position", "v")).select("title", "position", "v.variant", "v.strategy")


@query("recordings")
def page_candidates(r):
    return r.select("title", "artist_names").where("title is not null and artist_names is not null").distinct().select("title", "artist_names", F.posexplode(TT.page_candidates_udf("artist_names", "title")).alias("position", "url"))
