"""Addresses of archived pages: strict and manual forms, file names, tests and builders, as JVM column expressions.

Null and blank addresses give '' or false, or null where a struct is returned.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crateloom.functions.keys import HOST, path_parts, relation_identity, relation_type, unquote, url_key_decoded, url_key_no_query
from crateloom.functions.text import clean

#: First segments that are no artist, segments anywhere that are no artist link, second segments that are no track.
NO_ARTIST = ["sample", "cover", "remix", "interpolation", "search"]
NO_ARTIST_LINK = ["sample", "cover", "interpolation", "remix", "album", "browse", "search", "user", "movie", "tv-show"]
NO_FIRST = ["user", "movie", "tv-show", "artist", "sample", "cover", "remix", "interpolation", "search", "browse", "song-tag"]
NO_SECOND = ["covers", "covered", "remixes", "remixed", "samples", "sampled", "facts", "interpolations", "interpolated"]
#: Labels of links that lead nowhere, hosts of videos, number of a role in a listing's query.
IDLE_LABELS = ["sign in", "sign up", "ok", "next", "previous"]
VIDEO_HOSTS = ["youtube.com", "youtu.be", "youtube-nocookie.com"]
LISTING_ROLES = {"artist": "1", "producer": "2"}
#: Relationship words and the word that both sides of a comparison take.
SAME_TYPE = {"sampled": "sampled", "covered": "covers", "covers": "covers", "remixed": "remix", "remix": "remix", "interpolated": "interpolation", "interpolation": "interpolation"}


def host_of(c: Column) -> Column:
    return F.lower(F.regexp_extract(clean(c), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def path_of(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(clean(c), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", ""), r"[?#].*$", "")


def strict_url(c: Column, host: str = HOST) -> Column:
    """https, one host, single slashes, an end slash, no query; null for another host."""
    path = F.regexp_replace(F.concat(F.lit("/"), path_of(c), F.lit("/")), "/{2,}", "/")
    return F.when(host_of(c).isin(host, f"www.{host}"), F.concat(F.lit(f"https://www.{host}"), path))


def strict_url_or_fail(c: Column, host: str = HOST) -> Column:
    return F.coalesce(strict_url(c, host), F.raise_error(F.concat(F.lit("not a page of this host: "), F.coalesce(c, F.lit("")))))


def bare_url(c: Column) -> Column:
    """Without end slashes, otherwise as written."""
    return F.regexp_replace(clean(c), "/+$", "")


def manual_url(c: Column, kind: str, host: str = HOST) -> Column:
    """struct(url, artist_slug, track_slug) of an address that a person gave for an artist or track, else null."""
    text = clean(c)
    full = F.when(text.rlike("^https?://"), text).otherwise(F.concat(F.lit("https://"), F.regexp_replace(text, "^/+", "")))
    known = F.split_part(host_of(full), F.lit(":"), F.lit(1)).isin(host, f"www.{host}")
    parts, n = path_parts(full), {"artist": 1, "track": 2}[kind]
    first = F.lower(F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit("")))
    url = F.concat(F.lit(f"https://www.{host}/"), F.array_join(parts, "/"), F.lit("/"))
    slug = lambda k: unquote(F.try_element_at(parts, F.lit(k)))
    out = F.struct(url.alias("url"), slug(1).alias("artist_slug"), (slug(2) if n == 2 else F.lit(None).cast("string")).alias("track_slug"))
    return F.when((text != "") & known & (F.size(parts) == n) & ~first.isin(NO_ARTIST), out)


# ---- file names

def safe_part(c: Column) -> Column:
    """Decoded, file-safe, blanks as '_', at most 150 characters."""
    return F.substring(F.regexp_replace(F.regexp_replace(unquote(F.coalesce(c, F.lit(""))), r'[\\/:*?"<>|]+', "_"), r"(?U)\s+", "_"), 1, 150)


def media_name(c: Column) -> Column:
    """As ``safe_part`` without decoding, 'track' for nothing, at most 180 characters."""
    text = F.when(clean(c) == "", "track").otherwise(clean(c))
    return F.substring(F.regexp_replace(F.regexp_replace(text, r'[\\/:*?"<>|]+', "_"), r"(?U)\s+", "_"), 1, 180)


def ascii_name(c: Column) -> Column:
    out = F.regexp_replace(F.regexp_replace(clean(c), "[^A-Za-z0-9._-]+", "_"), "^_+|_+$", "")
    return F.when(out == "", "track").otherwise(out)


def _digest(key: Column) -> Column:
    return F.substring(F.sha1(key), 1, 10)


def catalog_archive_name(url: Column) -> Column:
    """artist__track__digest.html in ASCII; the digest is of the key without query."""
    parts = F.transform(path_parts(url), unquote)
    whole = F.size(parts) >= 2
    first = F.when(whole, F.try_element_at(parts, F.lit(1))).otherwise("artist")
    second = F.when(whole, F.try_element_at(parts, F.lit(2))).otherwise("track")
    return F.concat(ascii_name(first), F.lit("__"), ascii_name(second), F.lit("__"), _digest(url_key_no_query(url)), F.lit(".html"))


def related_archive_name(url: Column) -> Column:
    """The last two segments, file-safe, and the digest of the decoded key."""
    parts = F.transform(path_parts(url), unquote)
    last, n = F.try_element_at(parts, F.lit(-1)), F.size(parts)
    base = F.when(n >= 2, F.concat(F.try_element_at(parts, F.lit(-2)), F.lit("__"), last)).when(n == 1, last).otherwise("track")
    base = F.regexp_replace(F.regexp_replace(base, r'[\\/:*?"<>|]+', "_"), r"(?U)\s+", "_")
    base = F.substring(F.regexp_replace(base, r"^[._]+|[._]+$", ""), 1, 150)
    return F.concat(base, F.lit("__"), _digest(url_key_decoded(url)), F.lit(".html"))


def detail_archive_name(url: Column, by_type: bool = False) -> Column:
    """relationship_detail_kind_number.html, with the segment or the relationship type as kind; null without number."""
    identity = relation_identity(url)
    kind = relation_type(url, 1) if by_type else F.lower(identity["kind"])
    return F.when(identity["number"] != "", F.concat(F.lit("relationship_detail_"), kind, F.lit("_"), identity["number"], F.lit(".html")))


def secondary_archive_name(url: Column) -> Column:
    parts = F.transform(path_parts(url), safe_part)
    return F.when(F.size(parts) > 0, F.concat(F.array_join(parts, "-"), F.lit(".html")))


# ---- tests

def _holds(c: Column, words) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(c, F.lit(f"/{w}/"))
    return out


def is_track_page(c: Column) -> Column:
    """Exactly two segments and no relationship or search page."""
    low = F.lower(clean(c))
    return (low != "") & ~_holds(low, NO_ARTIST) & (F.size(F.filter(F.split(path_of(low), "/"), lambda p: p != "")) == 2)


def is_track_page_strict(c: Column, base: str = f"https://{HOST}") -> Column:
    """Also below the base, and with neither segment among the reserved ones."""
    parts = F.transform(path_parts(c), unquote)
    first, second = (F.lower(F.coalesce(F.try_element_at(parts, F.lit(k)), F.lit(""))) for k in (1, 2))
    return clean(c).startswith(base + "/") & (F.size(parts) == 2) & ~first.isin(NO_FIRST) & ~second.isin(NO_SECOND)


def is_artist_page(c: Column) -> Column:
    return (clean(c) != "") & (F.size(F.filter(F.split(F.regexp_replace(clean(c), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/]*", ""), "/"), lambda p: p != "")) == 1)


def is_artist_link(c: Column) -> Column:
    """A relative link /x/ of exactly two slashes that is no reserved page."""
    text = F.coalesce(c, F.lit(""))
    return ~_holds(F.lower(text), NO_ARTIST_LINK) & text.startswith("/") & (F.length(text) - F.length(F.replace(text, F.lit("/"), F.lit(""))) == 2)


def is_idle_label(c: Column) -> Column:
    """A link text that names no track: blank, navigation, or 'see … more connections'."""
    low = F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " ")))
    return (low == "") | low.isin(IDLE_LABELS) | (low.startswith("see ") & F.contains(low, F.lit(" more connection")))


def is_video(c: Column) -> Column:
    host, out = host_of(c), F.lit(False)
    for h in VIDEO_HOSTS:
        out = out | F.contains(host, F.lit(h))
    return out


def video_or_blank(c: Column) -> Column:
    return F.when(is_video(c), clean(c)).otherwise("")


def same_type(queued: Column, parsed: Column) -> Column:
    """Whether two relationship words mean one type; blank agrees with all. 'interpolates' has no partner."""
    def word(c):
        out = clean(c)
        for k, v in SAME_TYPE.items():
            out = F.when(clean(c) == k, v).otherwise(out)
        return out

    return (clean(queued) == "") | (clean(parsed) == "") | (word(queued) == word(parsed))


# ---- builders

def slug_of(c: Column) -> Column:
    """The decoded first segment."""
    return F.coalesce(unquote(F.try_element_at(path_parts(c), F.lit(1))), F.lit(""))


def name_of_slug(c: Column) -> Column:
    """The first segment with blanks for dashes."""
    return F.trim(F.replace(slug_of(c), F.lit("-"), F.lit(" ")))


def name_of_last(c: Column) -> Column:
    """The last segment with blanks for dashes and underscores."""
    last = F.element_at(F.split(F.regexp_replace(clean(c), "/+$", ""), "/"), -1)
    return F.trim(F.regexp_replace(last, "[-_]", " "))


def profile_of_track(c: Column, host: str = f"www.{HOST}") -> Column:
    """The profile that a track's address lies below; '' for relationship and search pages."""
    first = F.try_element_at(path_parts(c), F.lit(1))
    scheme = F.coalesce(F.nullif(F.regexp_extract(clean(c), r"^([a-zA-Z][a-zA-Z0-9+.-]*)://", 1), F.lit("")), F.lit("https"))
    net = F.coalesce(F.nullif(F.regexp_extract(clean(c), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit("")), F.lit(host))
    return F.when(first.isNull() | F.lower(first).isin(NO_ARTIST), "").otherwise(F.concat(scheme, F.lit("://"), net, F.lit("/"), first, F.lit("/")))


def profile_url(slug: Column, host: str = f"www.{HOST}") -> Column:
    """The profile address of a slug, percent-encoded but for -&,.'()"""
    text = F.regexp_replace(unquote(clean(slug)), "^/+|/+$", "")
    quoted = F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
    for code, ch in {"%26": "&", "%2C": ",", "%27": "'", "%28": "(", "%29": ")"}.items():
        quoted = F.replace(quoted, F.lit(code), F.lit(ch))
    quoted = F.replace(F.replace(quoted, F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))
    return F.when(text == "", "").otherwise(F.concat(F.lit(f"https://{host}/"), quoted, F.lit("/")))


def listing_url(artist_url: Column, role: Column, page: Column) -> Column:
    """The address of one page of an artist's listing; page 1 has no number."""
    number = F.lit(None).cast("string")
    for k, v in LISTING_ROLES.items():
        number = F.when(role == k, v).otherwise(number)
    query = F.array_join(F.filter(F.array(F.concat(F.lit("role="), number), F.when(page > 1, F.concat(F.lit("sp="), page.cast("string")))), lambda x: x.isNotNull()), "&")
    return F.concat(F.regexp_replace(clean(artist_url), r"[?#].*$", ""), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))


def video_url(video_id: Column) -> Column:
    return F.when(clean(video_id) == "", "").otherwise(F.concat(F.lit("https://www.youtube.com/watch?v="), clean(video_id)))


def video_thumbnail(video_id: Column) -> Column:
    return F.when(clean(video_id) == "", "").otherwise(F.concat(F.lit("https://i.ytimg.com/vi/"), clean(video_id), F.lit("/hqdefault.jpg")))


def search_url(words: Column, base: str) -> Column:
    return F.concat(F.lit(base), F.url_encode(clean(words)))


def opposite_url(direct: Column, orientation: Column, first: Column, second: Column) -> Column:
    """The other side of a relationship: an explicit address, else that of the side that is not primary (JSON texts)."""
    of = lambda c: F.coalesce(F.get_json_object(clean(c), "$.url"), F.lit(""))
    side = F.when(clean(orientation) == "track_1_primary", of(second)).when(clean(orientation) == "track_2_primary", of(first)).otherwise("")
    return F.coalesce(F.nullif(clean(direct), F.lit("")), clean(side), F.lit(""))

