"""Addresses, names and lists over whole tables, each beside the SQL that must agree."""

from __future__ import annotations

from pyspark.sql import functions as F

from crateloom.functions import arrays as A
from crateloom.functions import keys as K
from crateloom.functions import pages as P
from crateloom.functions import similarity as S
from crateloom.functions import text as X
from crateloom.functions import titles as TT
from crateloom.functions.text import clean
from crateloom.operators import frames as O
from crateloom.plans.reference_queries import QUERIES as _ALL
from crateloom.plans.reference_queries import SQL as _SQL
from crateloom.plans.reference_queries import c, query

_BEFORE = set(_ALL)
_SPACES = r"[\s\p{Z}\x{85}]+"

_URLS = f"""WITH a AS (SELECT DISTINCT u FROM (SELECT whosampled_url AS u FROM artists UNION ALL SELECT whosampled_url FROM recordings UNION ALL SELECT whosampled_relationship_url FROM relationships UNION ALL SELECT source_url FROM credits UNION ALL SELECT youtube_url FROM recordings) WHERE u IS NOT NULL),
x AS (SELECT u, {c('u')} AS t FROM a),
y AS (SELECT *, regexp_replace(regexp_replace(t, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*', ''), '[?#].*$', '') AS path, lower(regexp_extract(t, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1)) AS host FROM x),
z AS (SELECT *, list_filter(string_split(path, '/'), lambda p: p <> '') AS p, list_transform(list_filter(string_split(path, '/'), lambda p: p <> ''), lambda p: url_decode(p)) AS d FROM y) """


def _urls(a, r, rel, cr):
    parts = [a.select(F.col("whosampled_url").alias("u")), r.select(F.col("whosampled_url").alias("u")), rel.select(F.col("whosampled_relationship_url").alias("u")), cr.select(F.col("source_url").alias("u")), r.select(F.col("youtube_url").alias("u"))]
    return O.union_all(parts).where("u is not null").distinct()


_FOUR = ("artists", "recordings", "relationships", "credits")


@query(*_FOUR, sql=_URLS + r"""SELECT u, CASE WHEN host IN ('pages.example', 'www.pages.example') THEN 'https://www.pages.example' || regexp_replace('/' || path || '/', '/{2,}', '/', 'g') END AS strict,
regexp_replace(t, '/+$', '') AS bare, lower(regexp_replace(url_decode(t), '/+$', '')) AS decoded, lower(regexp_replace(url_decode(regexp_replace(t, '[?#].*$', '')), '/+$', '')) AS no_query,
CASE WHEN t <> '' AND split_part(host, ':', 1) IN ('pages.example', 'www.pages.example') AND len(p) = 1 AND lower(p[1]) NOT IN ('sample', 'cover', 'remix', 'interpolation', 'search') THEN 'https://www.pages.example/' || p[1] || '/' END AS manual_artist,
CASE WHEN t <> '' AND split_part(host, ':', 1) IN ('pages.example', 'www.pages.example') AND len(p) = 2 AND lower(p[1]) NOT IN ('sample', 'cover', 'remix', 'interpolation', 'search') THEN d[2] END AS manual_track FROM z""")
def url_forms(a, r, rel, cr):
    u = F.col("u")
    return _urls(a, r, rel, cr).select("u", P.strict_url(u).alias("strict"), P.bare_url(u).alias("bare"), K.url_key_decoded(u).alias("decoded"), K.url_key_no_query(u).alias("no_query"),
                                       P.manual_url(u, "artist")["url"].alias("manual_artist"), P.manual_url(u, "track")["track_slug"].alias("manual_track"))


_NONE = "'sample', 'cover', 'remix', 'interpolation', 'search'"


@query(*_FOUR, sql=_URLS + rf"""SELECT u, t <> '' AND NOT regexp_matches(lower(t), '/(sample|cover|remix|interpolation|search)/') AND len(p) = 2 AS track_page,
starts_with(t, 'https://pages.example/') AND len(p) = 2 AND lower(d[1]) NOT IN ('user', 'movie', 'tv-show', 'artist', 'sample', 'cover', 'remix', 'interpolation', 'search', 'browse', 'song-tag')
 AND lower(d[2]) NOT IN ('covers', 'covered', 'remixes', 'remixed', 'samples', 'sampled', 'facts', 'interpolations', 'interpolated') AS track_page_strict,
t <> '' AND len(list_filter(string_split(regexp_replace(t, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*', ''), '/'), lambda q: q <> '')) = 1 AS artist_page,
NOT regexp_matches(lower(u), '/(sample|cover|interpolation|remix|album|browse|search|user|movie|tv-show)/') AND starts_with(u, '/') AND len(u) - len(replace(u, '/', '')) = 2 AS artist_link,
contains(host, 'youtube.com') OR contains(host, 'youtu.be') OR contains(host, 'youtube-nocookie.com') AS video, coalesce(d[1], '') AS slug, trim(replace(coalesce(d[1], ''), '-', ' ')) AS slug_name,
CASE WHEN p[1] IS NULL OR lower(p[1]) IN ({_NONE}) THEN '' ELSE coalesce(nullif(regexp_extract(t, '^([a-zA-Z][a-zA-Z0-9+.-]*)://', 1), ''), 'https') || '://' || coalesce(nullif(regexp_extract(t, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)', 1), ''), 'www.pages.example') || '/' || p[1] || '/' END AS profile,
regexp_replace(t, '[?#].*$', '') || '?role=2&sp=3' AS listing FROM z""")
def url_checks(a, r, rel, cr):
    u = F.col("u")
    return _urls(a, r, rel, cr).select(
        "u", P.is_track_page(u).alias("track_page"), P.is_track_page_strict(u).alias("track_page_strict"), P.is_artist_page(u).alias("artist_page"), P.is_artist_link(u).alias("artist_link"), P.is_video(u).alias("video"),
        P.slug_of(u).alias("slug"), P.name_of_slug(u).alias("slug_name"), P.profile_of_track(u).alias("profile"), P.listing_url(u, F.lit("producer"), F.lit(3)).alias("listing"))


@query(*_FOUR, sql=_URLS + r""", n AS (SELECT *, CASE WHEN len(d) >= 2 THEN d[1] ELSE 'artist' END AS f, CASE WHEN len(d) >= 2 THEN d[2] ELSE 'track' END AS s,
 CASE WHEN len(d) >= 2 THEN d[len(d) - 1] || '__' || d[len(d)] WHEN len(d) = 1 THEN d[1] ELSE 'track' END AS base, regexp_extract(t, '/(sample|cover|remix|interpolation)s?/(\d+)', 1) AS kind, regexp_extract(t, '/(sample|cover|remix|interpolation)s?/(\d+)', 2) AS num FROM z),
m AS (SELECT *, regexp_replace(regexp_replace(f, '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g') AS fa, regexp_replace(regexp_replace(s, '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g') AS sa FROM n)
SELECT u, coalesce(nullif(fa, ''), 'track') || '__' || coalesce(nullif(sa, ''), 'track') || '__' || substr(sha1(lower(regexp_replace(url_decode(regexp_replace(t, '[?#].*$', '')), '/+$', ''))), 1, 10) || '.html' AS catalog_name,
substr(regexp_replace(regexp_replace(regexp_replace(base, '[\\/:*?"<>|]+', '_', 'g'), '\s+', '_', 'g'), '^[._]+|[._]+$', '', 'g'), 1, 150) || '__' || substr(sha1(lower(regexp_replace(url_decode(t), '/+$', ''))), 1, 10) || '.html' AS related_name,
CASE WHEN num <> '' THEN 'relationship_detail_' || kind || '_' || num || '.html' END AS detail_name,
CASE WHEN num <> '' THEN 'relationship_detail_' || CASE kind WHEN 'sample' THEN 'sampled' WHEN 'cover' THEN 'covers' WHEN 'remix' THEN 'remix' ELSE 'interpolates' END || '_' || num || '.html' END AS typed_detail_name,
CASE WHEN len(p) > 0 THEN array_to_string(list_transform(d, lambda q: substr(regexp_replace(regexp_replace(q, '[\\/:*?"<>|]+', '_', 'g'), '\s+', '_', 'g'), 1, 150)), '-') || '.html' END AS secondary_name,
'REC_' || substr(sha1(u), 1, 16) AS hash_id FROM m""")
def page_file_names(a, r, rel, cr):
    u = F.col("u")
    return _urls(a, r, rel, cr).select("u", P.catalog_archive_name(u).alias("catalog_name"), P.related_archive_name(u).alias("related_name"), P.detail_archive_name(u).alias("detail_name"),
                                       P.detail_archive_name(u, True).alias("typed_detail_name"), P.secondary_archive_name(u).alias("secondary_name"), K.url_hash_id(u).alias("hash_id"))


@query("spotify_tracks", sql=rf"""SELECT entry_id, coalesce(title, '') AS as_written, nullif(trim(regexp_replace(coalesce(title, ''), '{_SPACES}', ' ', 'g')), '') AS text_or_null, regexp_extract({c('title')}, '\b(?:19|20)\d\d\b', 0) AS title_year,
substr(regexp_replace(regexp_replace(CASE WHEN {c('title')} = '' THEN 'track' ELSE {c('title')} END, '[\\/:*?"<>|]+', '_', 'g'), '{_SPACES}', '_', 'g'), 1, 180) AS media_name,
lower(trim(regexp_replace(coalesce(title, ''), '{_SPACES}', ' ', 'g'))) IN ('', 'sign in', 'sign up', 'ok', 'next', 'previous') AS idle_label,
CASE WHEN {c('spotify_track_id')} = '' THEN '' ELSE 'spotify:track:' || {c('spotify_track_id')} END AS uri, CASE WHEN {c('title')} IN ('0', '0.0', 'false', 'False') THEN '' ELSE {c('title')} END AS truthy FROM spotify_tracks""")
def text_forms(t):
    x = F.col("title")
    return t.select("entry_id", X.text_or_blank(x).alias("as_written"), F.nullif(X.collapse(x), F.lit("")).alias("text_or_null"), TT.title_year(x).alias("title_year"), P.media_name(x).alias("media_name"),
                    P.is_idle_label(x).alias("idle_label"), K.track_uri(F.col("spotify_track_id")).alias("uri"), X.truthy_text(x).alias("truthy"))


_NAMES = "list_filter(list_transform(CAST(json_extract_string(CASE WHEN artists_json LIKE '[%' THEN artists_json ELSE '[]' END, '$[*].name') AS varchar[]), lambda v: trim(v)), lambda v: v <> '')"
_COMMA = f"list_filter(list_transform(string_split(coalesce(artist_names, ''), ','), lambda v: {c('v')}), lambda v: v <> '')"


@query("spotify_tracks", sql=f"""WITH x AS (SELECT entry_id, CASE WHEN coalesce(artists_json, '') LIKE '[%' AND len({_NAMES}) > 0 THEN {_NAMES} ELSE {_COMMA} END AS n FROM spotify_tracks)
SELECT entry_id, array_to_string(n, '|') AS names, CAST(len(n) AS int) AS n_names, array_to_string(n[1:5], '|') AS first_names FROM x""")
def artist_name_lists(t):
    n = A.names(F.col("artists_json"), F.col("artist_names"))
    return t.select("entry_id", F.array_join(n, "|").alias("names"), F.size(n).alias("n_names"), F.array_join(A.first_names(F.col("artists_json"), F.col("artist_names")), "|").alias("first_names"))


_ROLES = """list_sort(list_distinct(list_filter(list_transform(CAST(json_extract_string(CASE WHEN catalog_roles_json LIKE '[%' THEN catalog_roles_json ELSE '[]' END, '$[*]') AS varchar[]), lambda v: trim(v)), lambda v: v <> '')))"""


@query("artist_catalog_recordings_parsed", sql=f"""SELECT DISTINCT recording_id, CASE WHEN len({_ROLES}) = 0 OR {_ROLES} IS NULL THEN '' ELSE '["' || array_to_string({_ROLES}, '","') || '"]' END AS functions,
CASE WHEN {c('recording_id')} <> '' THEN {c('recording_id')} ELSE 'whosampled:' || {c('whosampled_url')} END AS review_key, concat_ws('|', {c('whosampled_url')}, {c('whosampled_title')}, {c('whosampled_artist_names')}, {c('spotify_track_id')}) AS row_key,
{c('whosampled_title')} || '|' || {c('whosampled_artist_names')} AS target_key FROM artist_catalog_recordings_parsed""")
def review_keys(p):
    return p.select(
        "recording_id", A.serialize_functions(A.json_elements(F.col("catalog_roles_json"))).alias("functions"), K.review_key(F.col("recording_id"), F.col("whosampled_url")).alias("review_key"),
        K.review_row_key(*[F.col(x) for x in ("whosampled_url", "whosampled_title", "whosampled_artist_names", "spotify_track_id")]).alias("row_key"),
        K.target_key(clean(F.col("whosampled_title")), clean(F.col("whosampled_artist_names"))).alias("target_key")).distinct()


@query("relationships", sql=f"""WITH x AS (SELECT {c('relationship_type')} AS queued, CASE WHEN contains(lower({c('whosampled_relationship_url')}), '/sample/') THEN 'sampled' WHEN contains(lower({c('whosampled_relationship_url')}), '/cover/') THEN 'covers'
WHEN contains(lower({c('whosampled_relationship_url')}), '/interpolation/') THEN 'interpolates' WHEN contains(lower({c('whosampled_relationship_url')}), '/remix/') THEN 'remix' ELSE '' END AS parsed FROM relationships),
m AS (SELECT *, CASE queued WHEN 'covered' THEN 'covers' WHEN 'remixed' THEN 'remix' WHEN 'interpolated' THEN 'interpolation' ELSE queued END AS q, CASE parsed WHEN 'covered' THEN 'covers' WHEN 'remixed' THEN 'remix' WHEN 'interpolated' THEN 'interpolation' ELSE parsed END AS r FROM x)
SELECT queued, parsed, queued = '' OR parsed = '' OR q = r AS agrees, count(*) AS n FROM m GROUP BY 1, 2, 3""")
def relationship_type_agreement(rel):
    """Types of the queue against those of the address; every interpolation disagrees, since its word has no partner."""
    parsed = K.relation_type(F.col("whosampled_relationship_url"), 1)
    return rel.groupBy(clean(F.col("relationship_type")).alias("queued"), parsed.alias("parsed"), P.same_type(F.col("relationship_type"), parsed).alias("agrees")).agg(F.count("*").alias("n"))


@query("artist_catalog_recordings_parsed", sql=rf"""SELECT DISTINCT recording_id, CASE WHEN regexp_matches(whosampled_duration_iso, '^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?$') THEN coalesce(try_cast(regexp_extract(whosampled_duration_iso, '(\d+)H', 1) AS double), 0) * 3600
 + coalesce(try_cast(regexp_extract(whosampled_duration_iso, '(\d+)M', 1) AS double), 0) * 60 + coalesce(try_cast(regexp_extract(whosampled_duration_iso, '(\d+(?:\.\d+)?)S', 1) AS double), 0) END AS iso_seconds,
CASE WHEN regexp_matches(whosampled_duration, '\b\d+:\d\d\b') THEN CAST(regexp_extract(whosampled_duration, '\b(\d+):(\d\d)\b', 1) AS double) * 60 + CAST(regexp_extract(whosampled_duration, '\b(\d+):(\d\d)\b', 2) AS double) END AS spoken_seconds FROM artist_catalog_recordings_parsed""")
def page_seconds(p):
    return p.select("recording_id", TT.iso_duration_seconds(F.col("whosampled_duration_iso")).alias("iso_seconds"), TT.spoken_seconds(F.col("whosampled_duration")).alias("spoken_seconds")).distinct()


@query("recordings", "spotify_tracks", sql=f"""WITH t AS (SELECT {c('spotify_track_id')} AS tid, lower(min({c('title')})) AS t, lower(min({c('artist_names')})) AS a, min(substr({c('album_release_date')}, 1, 4)) AS y FROM spotify_tracks WHERE {c('spotify_track_id')} <> '' GROUP BY 1),
x AS (SELECT row_id, CASE WHEN lower({c('title')}) = t AND t <> '' THEN 1.0 ELSE 0.0 END AS title, CASE WHEN lower(r.artist_names) = a AND a <> '' THEN 1.0 WHEN contains(a, lower({c('r.artist_names')})) AND {c('r.artist_names')} <> '' THEN 0.9 ELSE 0.0 END AS artist,
 CASE WHEN regexp_full_match({c('release_year')}, '\\d+') AND {c('release_year')} = y THEN 1.0 ELSE 0.0 END AS year FROM recordings r JOIN t ON t.tid = {c('r.spotify_track_id')})
SELECT row_id, round(CAST(title * 0.60 + artist * 0.30 + year * 0.10 AS double), 6) AS enrichment, round(CAST(CASE WHEN title = 1 AND artist >= 0.8 THEN greatest(0.95, title * 0.65 + artist * 0.35) ELSE title * 0.65 + artist * 0.35 END AS double), 6) AS cache FROM x""")
def other_scores(r, t):
    """The enrichment and the cache score of recordings and their tracks, with equality as similarity."""
    tracks = t.where(O.key("spotify_track_id").isNotNull()).groupBy(O.key("spotify_track_id").alias("tid")).agg(
        F.lower(F.min(clean(F.col("title")))).alias("t"), F.lower(F.min(clean(F.col("artist_names")))).alias("a"), F.min(F.substring(clean(F.col("album_release_date")), 1, 4)).alias("y"))
    rows = r.select("row_id", O.key("spotify_track_id").alias("tid"), F.lower(clean(F.col("title"))).alias("rt"), F.lower(clean(F.col("artist_names"))).alias("ra"), clean(F.col("release_year")).alias("ry")).join(tracks, "tid")
    title = F.when((F.col("rt") == F.col("t")) & (F.col("t") != ""), 1.0).otherwise(0.0)
    artist = F.when((F.col("ra") == F.col("a")) & (F.col("a") != ""), 1.0).when(F.contains("a", "ra") & (F.col("ra") != ""), 0.9).otherwise(0.0)
    scores = {"title": title, "artist": artist, "year": S.year_equal(F.col("ry"), F.col("y"))}
    return rows.select("row_id", F.round(S.summed(scores, S.ENRICHMENT_WEIGHTS), 6).alias("enrichment"), F.round(S.cache_score(title, artist, title == 1), 6).alias("cache"))


@query("artists")
def name_folds_more(a):
    n = F.col("canonical_name")
    return a.select("artist_id", n, X.fold_descriptor_udf(n).alias("descriptor_fold"), X.fold_ascii_lower_udf(n).alias("ascii_lower_fold"), P.profile_url(n).alias("profile_url"), TT.compact_title(X.fold_ascii_lower_udf(n)).alias("compact"),
                    F.array_join(TT.title_tokens(X.fold_ascii_lower_udf(n)), " ").alias("tokens")).distinct()


# ---- pages built from the tables and read back

def _esc(x):
    from crateloom.plans.reference_queries import _escape

    return _escape(x)


def _track_pages(r):
    v = {x: _esc(F.col(x)) for x in ("title", "artist_names", "album", "label", "release_year", "genre", "keywords", "whosampled_url", "youtube_video_id")}
    parts = ['<html><head><link rel="canonical" href="', v["whosampled_url"], '"></head><body><h1><meta itemprop="name" content="', v["title"], '">x</h1><div class="trackArtistNames"><a href="/Some-Artist/">', v["artist_names"],
             '</a></div><div itemprop="inAlbum"><span itemprop="name">', v["album"], '</span><span itemprop="recordLabel">', v["label"], '</span><meta itemprop="datePublished" content="', v["release_year"], '"></div><span itemprop="genre">', v["genre"],
             '</span><meta itemprop="keywords" content="', v["keywords"], '"><div class="track-credit-item"><span class="track-credit-title">Composer(s):</span><span itemprop="contributor"><span itemprop="name"><a href="/Some-Artist/">', v["artist_names"],
             '</a></span></span></div><div itemprop="producer"><span itemprop="name">', v["label"], '</span></div><div class="youtube-placeholder" data-id="', v["youtube_video_id"], '"></div><meta itemprop="duration" content="PT3M5.5S"></body></html>']
    return r.select(F.col("row_id").cast("string").alias("url"), F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts]).alias("html"))


_C = lambda x: f"trim(regexp_replace(coalesce({x}, ''), '{_SPACES}', ' ', 'g'))"


@query("recordings", sql=f"""SELECT CAST(row_id AS varchar) AS url, {_C('title')} AS title, {_C('whosampled_url')} AS canonical_url, {_C('artist_names')} AS artists, {_C('album')} AS album, {_C('label')} AS label, {_C('release_year')} AS release_year, {_C('genre')} AS genre,
{_C('youtube_video_id')} AS youtube_video_id, CAST(185500 AS bigint) AS duration_ms, CASE WHEN {_C('artist_names')} <> '' THEN {_C('artist_names')} || '/composed_by/Composer(s)/https://pages.example/Some-Artist/' ELSE '' END AS composer,
CASE WHEN {_C('label')} <> '' THEN {_C('label')} || '/produced_by/Producer/' ELSE '' END AS producer FROM recordings""")
def html_track_pages(r):
    """A page of every recording, read back."""
    from crateloom.sources import html as H

    d = H.recording(_track_pages(r))
    credit = lambda role: F.coalesce(F.try_element_at(F.transform(F.filter("credits", lambda x: x["role"] == role), lambda x: F.concat_ws("/", x["artist"], x["role"], x["source_role"], x["url"])), F.lit(1)), F.lit(""))
    return d.select("url", "title", "canonical_url", F.array_join("artist_names", ", ").alias("artists"), "album", "label", "release_year", "genre", "youtube_video_id", "duration_ms", credit("composed_by").alias("composer"), credit("produced_by").alias("producer"))


def _detail_pages(rel):
    t, a, y, d = (_esc(F.col(x)) for x in ("related_track", "related_artist", "year", "detail"))
    side = lambda name, url: [f'<div id="sampleWrap_{name}"><a itemprop="url" href="{url}"></a><span itemprop="name">', t, '</span><div itemprop="byArtist"><meta itemprop="name" content="', a, '"></div><div itemprop="inAlbum"><span itemprop="name">Album</span><meta itemprop="datePublished" content="', y, f'"></div><div class="sample-{name}-timing">1:0{len(name) % 10}</div></div>']
    parts = ["<html><body>", *side("dest", "/A/B/"), *side("source", "/C/D"), '<span class="sample-type">', d, "</span></body></html>"]
    return rel.where(clean(F.col("whosampled_relationship_url")) != "").select(clean(F.col("whosampled_relationship_url")).alias("url"), F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts]).alias("html"), "relationship_id")


@query("relationships", sql=rf"""SELECT DISTINCT {c('whosampled_relationship_url')} AS url, CASE WHEN contains(whosampled_relationship_url, '/sample/') THEN 'sampled' WHEN contains(whosampled_relationship_url, '/cover/') THEN 'covers' WHEN contains(whosampled_relationship_url, '/remix/') THEN 'remix' WHEN contains(whosampled_relationship_url, '/interpolation/') THEN 'interpolates' END AS relationship_type,
try_cast(nullif(regexp_extract(whosampled_relationship_url, '/(?:sample|cover|remix|interpolation)/(\d+)/', 1), '') AS bigint) AS number, nullif({_C('related_track')}, '') AS name, {_C('related_artist')} AS artists, try_cast(nullif(regexp_extract({_C('year')}, '\b(?:19|20)\d\d\b', 0), '') AS int) AS year,
'https://pages.example/A/B/' AS url_1, 'https://pages.example/C/D/' AS url_2, CAST(64 AS double) AS at_1, CAST(66 AS double) AS at_2 FROM relationships WHERE {c('whosampled_relationship_url')} <> ''""")
def html_relationship_details(rel):
    """A page of every relationship with both of its tracks, read back."""
    from crateloom.sources import html as H

    d = H.relationship_details(_detail_pages(rel).select("url", "html"))
    return d.select("url", "relationship_type", "number", "track_1.name", F.array_join("track_1.artists", ", ").alias("artists"), "track_1.year", F.col("track_1.url").alias("url_1"), F.col("track_2.url").alias("url_2"),
                    F.col("track_1.sample_timestamp_seconds").alias("at_1"), F.col("track_2.sample_timestamp_seconds").alias("at_2")).distinct()


@query("recordings", sql=f"""WITH x AS (SELECT row_id, {_C('title')} AS t, {_C('whosampled_title')} AS e, {_C('whosampled_artist_names')} AS ea, {_C('artist_names')} AS a, {_C('whosampled_url')} AS u FROM recordings)
SELECT row_id, CASE WHEN u = '' THEN 'review' WHEN regexp_matches(lower(u), '/(sample|cover|interpolation|remix|search)/') THEN 'rejected' WHEN lower(t) = lower(e) AND (contains(lower(a), lower(ea)) OR contains(lower(ea), lower(a))) THEN 'matched' ELSE 'review' END AS live_status,
CASE WHEN u = '' OR len(list_filter(string_split(regexp_replace(u, '^[a-z]+://[^/]+', ''), '/'), lambda p: p <> '')) <> 2 THEN 'rejected' WHEN lower(t) = lower(e) AND (contains(lower(a), lower(ea)) OR contains(lower(ea), lower(a))) THEN 'matched' ELSE 'review' END AS cached_status,
t <> '' AND u <> '' AND NOT regexp_matches(lower(u), '/(sample|cover|interpolation|remix|search)/') AS saved FROM x""")
def page_verification(r):
    """Whether the page of a recording is its own, by lower-case titles and artists."""
    low = lambda x: F.lower(X.collapse(F.col(x)))
    u = X.collapse(F.col("whosampled_url"))
    marked = F.lower(u).rlike("/(sample|cover|interpolation|remix|search)/")
    args = (low("whosampled_title"), F.array(low("whosampled_artist_names")), low("title"), F.array(low("artist_names")), u, marked)
    return r.select("row_id", S.page_status(*args).alias("live_status"), S.page_status(*args, cached=True, two_parts=F.size(K.path_parts(u)) == 2).alias("cached_status"), S.saved_page(X.collapse(F.col("title")), u, marked).alias("saved"))


QUERIES = {k: v for k, v in _ALL.items() if k not in _BEFORE}
SQL = {k: v for k, v in _SQL.items() if k in QUERIES}
