"""Flows over whole runs: seeding the canonical tables from playlists, review candidates of artists, caches and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateloom.functions import keys as K
from crateloom.functions import pages as P
from crateloom.functions.text import clean
from crateloom.operators import frames as O
from crateloom.operators.frames import key

#: Where review candidates come from, the most trusted first.
SOURCES = ["learned_slug", "verified_track_match", "observed_artist_profile", "generated_artist_slug", "related_track_profile"]
SEARCHED = ["searched", "no_results"]


def seed(tracks: DataFrame, matches: DataFrame) -> dict[str, DataFrame]:
    """Recordings, artists and performer credits of playlist entries.

    One recording per track id, from its first entry (``entry_id``), with the page of its match; one artist per artist id,
    as its last entry names it; one credit per recording, artist, name, role and source with the least place.
    Entries without track id, and artists without id or name, are left out; artists are never guessed from comma text.
    """
    t = tracks.where(key("spotify_track_id").isNotNull()).withColumn("track", clean(F.col("spotify_track_id"))).withColumn("recording_id", K.stable_id("REC_", "spotify", F.col("track")))
    m = matches.where(key("spotify_track_id").isNotNull()).groupBy(clean(F.col("spotify_track_id")).alias("track")).agg(
        F.max_by(clean(F.col("whosampled_url")), "position").alias("whosampled_url"), F.max_by(clean(F.col("match_status")), "position").alias("whosampled_match_status"))
    columns = {"title": "title", "artist_names": "artist_names", "album": "album_name", "label": "album_label", "spotify_uri": "spotify_uri", "spotify_url": "spotify_url", "spotify_isrc": "isrc", "spotify_album_name": "album_name", "spotify_album_id": "album_id", "spotify_album_release_date": "album_release_date"}
    row = F.struct(*[clean(F.col(c)).alias(n) for n, c in columns.items()], F.col("duration_ms").cast("bigint").alias("spotify_duration_ms"))
    first = t.groupBy("recording_id", "track").agg(F.min_by(row, "entry_id").alias("r")).select("recording_id", F.col("track").alias("spotify_track_id"), "r.*")
    recordings = first.withColumn("release_year", F.substring("spotify_album_release_date", 1, 4)).join(m.withColumnRenamed("track", "spotify_track_id"), "spotify_track_id", "left").fillna("", ["whosampled_url", "whosampled_match_status"])

    pairs = t.select("recording_id", "entry_id", clean(F.col("spotify_url")).alias("source_url"), F.posexplode(O.parse_artists(F.col("artists_json"), F.col("artist_ids"), F.col("artist_names"))).alias("place", "a")).select(
        "recording_id", "entry_id", "source_url", (F.col("place") + 1).alias("artist_order"), clean(F.col("a.id")).alias("sid"), clean(F.col("a.name")).alias("artist_name")).where("sid <> '' and artist_name <> ''")
    pairs = pairs.withColumn("artist_id", K.stable_id("ART_", "spotify", F.col("sid")))
    artists = pairs.groupBy("artist_id", F.col("sid").alias("spotify_artist_id")).agg(F.max_by("artist_name", F.struct("entry_id", "artist_order")).alias("canonical_name")).withColumn("spotify_uri", K.artist_uri(F.col("spotify_artist_id")))
    label = F.concat_ws("|", "recording_id", "artist_id", "artist_name", F.lit("performer"), F.lit("Spotify track artist"), F.lit("Spotify"))
    credits = pairs.groupBy("recording_id", "artist_id", "artist_name").agg(F.min_by(F.struct("artist_order", "source_url"), F.struct("entry_id", "artist_order")).alias("x")).select(
        K.stable_id("CRD_", "credit", label).alias("credit_id"), "recording_id", "artist_id", "artist_name", F.lit("performer").alias("role"), F.lit("Spotify track artist").alias("source_role"), "x.artist_order", F.lit("Spotify").alias("source"), "x.source_url")
    return {"recordings": recordings, "artists": artists, "credits": credits}


def integrate_targets(recordings: DataFrame, relationships: DataFrame, tracks: DataFrame) -> dict[str, DataFrame]:
    """Accepted targets of relationships as recordings, and the relationships with their ids.

    ``relationships``: spotify_match_status, spotify_track_id; ``tracks`` has one row per track id. A target that is no
    recording yet becomes one; the others are referred to.
    """
    accepted = (F.lower(clean(F.col("spotify_match_status"))) == "matched") & (clean(F.col("spotify_track_id")) != "")
    owner = recordings.where(key("spotify_track_id").isNotNull()).groupBy(clean(F.col("spotify_track_id")).alias("_t")).agg(F.min("recording_id").alias("_r"))
    linked = relationships.join(owner, clean(F.col("spotify_track_id")) == F.col("_t"), "left").withColumn("target_recording_id", F.when(
        accepted, O.fill_from(F.col("target_recording_id"), F.coalesce("_r", K.stable_id("REC_", "spotify", clean(F.col("spotify_track_id")))))).otherwise(F.col("target_recording_id"))).drop("_t", "_r")
    wanted = relationships.where(accepted).select(clean(F.col("spotify_track_id")).alias("_t")).distinct().join(owner.select("_t"), "_t", "left_anti")
    new = tracks.join(wanted, clean(F.col("spotify_track_id")) == F.col("_t"), "left_semi").select(K.stable_id("REC_", "spotify", clean(F.col("spotify_track_id"))).alias("recording_id"), *[c for c in tracks.columns if c in recordings.columns and c != "recording_id"])
    return {"recordings": recordings.unionByName(new, allowMissingColumns=True), "relationships": linked}


def review_candidates(observed: DataFrame) -> DataFrame:
    """Candidate pages of artists: (artist, url, slug, sources, n_evidence, first_source) from observed(artist, url, source, evidence).

    One row per artist and address key; its sources in order of trust (at most five) and the number of different texts of
    evidence, which stay in ``observed``.
    """
    rank = F.lit(len(SOURCES))
    for k, s in reversed(list(enumerate(SOURCES))):
        rank = F.when(F.col("source") == s, k).otherwise(rank)
    rows = observed.where(clean(F.col("url")) != "").select("artist", clean(F.col("url")).alias("url"), K.url_key_decoded(F.col("url")).alias("_k"), "source", rank.alias("_r"), clean(F.col("evidence")).alias("evidence")).distinct()
    return rows.groupBy("artist", "_k").agg(
        F.min_by("url", F.struct("_r", "url")).alias("url"), F.array_join(F.transform(F.array_sort(F.collect_set(F.struct("_r", "source"))), lambda x: x["source"]), "|").alias("sources"),
        F.count_distinct(F.nullif(F.col("evidence"), F.lit(""))).alias("n_evidence"), F.min("_r").alias("first_source")).withColumn("slug", P.slug_of(F.col("url"))).drop("_k")


def cached_tracks(wanted: DataFrame, cache: DataFrame) -> DataFrame:
    """Wanted track ids with the cached row's title: status cached, or to_fetch for a miss."""
    one = cache.where(key("spotify_track_id").isNotNull()).groupBy(clean(F.col("spotify_track_id")).alias("_t")).agg(F.min(clean(F.col("title"))).alias("cached_title"))
    out = wanted.join(one, clean(F.col("spotify_track_id")) == F.col("_t"), "left")
    return out.withColumn("status", F.when(F.col("_t").isNotNull(), "cached").otherwise("to_fetch")).drop("_t")


def page_progress(pages: DataFrame, listed: DataFrame, on: list[str]) -> DataFrame:
    """Per listing the last page that was read, the greatest page known, whether it is complete, and the next page."""
    last = pages.groupBy(*on).agg(F.max("page").alias("last_page_processed"))
    known = listed.groupBy(*on).agg(F.max("max_page").alias("max_page"))
    out = known.join(last, on, "left").withColumn("last_page_processed", F.coalesce("last_page_processed", F.lit(0)))
    complete = F.col("last_page_processed") >= F.col("max_page")
    return out.withColumn("complete", complete).withColumn("next_page", F.when(~complete, F.col("last_page_processed") + 1))


def blind(df: DataFrame, ignore: bool) -> DataFrame:
    """A cache as it is, or without its rows where a run ignores all caches."""
    return df.limit(0) if ignore else df


def by_folded(*columns: str) -> list[Column]:
    """A sort order that ignores case, with the texts themselves as last tie."""
    return [F.asc(F.lower(F.coalesce(F.col(c).cast("string"), F.lit("")))) for c in columns] + [F.asc(c) for c in columns]


def search_order(exact: Column, popularity: Column, ident: Column) -> list[Column]:
    """Exact names first, then the more popular, then the id."""
    return [F.asc(~exact), F.desc(F.coalesce(popularity, F.lit(0))), F.asc(ident)]


def largest_image(images: Column) -> Column:
    """The url of the image of greatest scale among array<struct(url, scale)>; the first of equal ones."""
    return F.aggregate(images, F.struct(F.lit("").alias("url"), F.lit(-1.0).alias("scale")), lambda a, x: F.when(x["scale"].cast("double") > a["scale"], F.struct(x["url"].alias("url"), x["scale"].cast("double").alias("scale"))).otherwise(a))["url"]


def limited(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of a total order."""
    return df.orderBy(*order).limit(n)
