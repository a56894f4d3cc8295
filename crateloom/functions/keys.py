"""Identity keys, URL keys and classifications, as JVM column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crateloom.functions.text import clean

#: Relationship segments of a page address, in both vocabularies.
RELATION_WORDS = {"sample": ("sampled", "sampled"), "cover": ("covered", "covers"), "interpolation": ("interpolated", "interpolates"), "remix": ("remixed", "remix")}
#: Source role to canonical role.
ROLES = {
    "producer": "produced_by", "producer(s)": "produced_by", "composer": "composed_by", "composer(s)": "composed_by",
    "lyricist": "written_by", "lyricist(s)": "written_by", "songwriter": "written_by", "songwriter(s)": "written_by",
    "arranger": "arranged_by", "arranger(s)": "arranged_by", "performer": "performed_by", "performer(s)": "performed_by",
    "vocalist": "performed_by", "instrumentalist": "performed_by", "engineer": "engineered_by", "engineer(s)": "engineered_by",
    "mixer": "mixed_by", "mix engineer": "mixed_by", "remixer": "remixed_by",
}
#: Canonical role to the older role names.
LEGACY_ROLES = {"produced_by": "producer", "composed_by": "composer", "written_by": "writer", "performed_by": "performer"}
#: Path words of catalogue pages that are not tracks.
CATALOG_WORDS = ["samples", "sampled", "sample", "covers", "covered", "cover", "remixes", "remixed", "remix", "interpolations", "interpolated", "interpolates", "connections", "credits", "appearances", "tracks", "songs"]
SUBPAGES = ["facts", "samples", "sampled", "covers", "covered", "remixes", "remixed", "connections"]


#: Host of the archived pages; a parameter wherever it matters.
HOST = "pages.example"


def stable_id(prefix: str, namespace: str, value: Column) -> Column:
    """prefix + the first 16 hex digits of sha1(namespace:value)."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.concat(F.lit(namespace + ":"), F.coalesce(value, F.lit("")))), 1, 16))


def parts_id(prefix: str, *parts: Column) -> Column:
    """prefix_ + the first 16 hex digits of sha1(a|b|c); nulls count as ''."""
    joined = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha1(joined), 1, 16))


def proposal_id(*parts: Column) -> Column:
    joined = F.concat_ws("|", *[F.coalesce(p, F.lit("")) for p in parts])
    return F.concat(F.lit("PROP_"), F.substring(F.sha2(joined, 256), 1, 16))


def unquote(c: Column) -> Column:
    """Percent-decoding that leaves '+' and broken escapes alone."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def url_key_plain(c: Column) -> Column:
    return F.lower(F.regexp_replace(clean(c), "/+$", ""))


def url_key_decoded(c: Column) -> Column:
    return F.lower(F.regexp_replace(unquote(clean(c)), "/+$", ""))


def url_key_no_query(c: Column) -> Column:
    """scheme://host + decoded path without query, fragment and end slashes."""
    return F.lower(F.regexp_replace(unquote(F.regexp_replace(clean(c), r"[?#].*$", "")), "/+$", ""))


def url_slash(c: Column) -> Column:
    return F.when(clean(c) == "", "").otherwise(F.concat(F.regexp_replace(clean(c), "/+$", ""), F.lit("/")))


def url_absolute(c: Column, base: str = f"https://{HOST}") -> Column:
    """Absolute, without query and fragment, single slashes, one end slash."""
    bare = F.regexp_replace(clean(c), r"[?#].*$", "")
    absolute = F.when(bare.rlike("^https?://"), bare).otherwise(F.concat(F.lit(base + "/"), F.regexp_replace(bare, "^/+", "")))
    single = F.regexp_replace(absolute, "(?<!:)/{2,}", "/")
    return F.when(bare == "", "").otherwise(F.concat(F.regexp_replace(single, "/+$", ""), F.lit("/")))


def foreign(url: Column, host: str = HOST) -> Column:
    """True for an absolute address of another host; relative ones belong here."""
    got = F.lower(F.regexp_extract(clean(url), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))
    return (got != "") & ~got.isin(host, f"www.{host}")


def has_query(url: Column) -> Column:
    """True where the address has a query with at least one value."""
    return F.regexp_extract(clean(url), r"\?([^#]*)", 1).rlike("(^|&)[^=&]+=[^&]")


def path_parts(c: Column) -> Column:
    """The non-empty path segments of an address."""
    path = F.regexp_replace(F.regexp_replace(clean(c), r"^[a-z]+://[^/]+", ""), r"[?#].*$", "")
    return F.filter(F.split(path, "/"), lambda p: p != "")


def relation_type(url: Column, vocabulary: int = 0) -> Column:
    """The relationship that a segment of the address names, in order of ``RELATION_WORDS``; else ''."""
    low, out = F.lower(clean(url)), F.lit("")
    for word in reversed(RELATION_WORDS):
        out = F.when(F.contains(low, F.lit(f"/{word}/")), RELATION_WORDS[word][vocabulary]).otherwise(out)
    return out


def relation_of_page(url: Column, text: Column) -> Column:
    """``relation_type`` in the second vocabulary; without one in the address, the first word that the text holds."""
    low = F.lower(clean(text))
    spoken = (
        F.when(F.contains(low, F.lit("remix")), "remix").when(F.contains(low, F.lit("cover")), "covers")
        .when(low.rlike("interpolat(es|ed|ion)"), "interpolates").when(F.contains(low, F.lit("sample")), "sampled").otherwise("")
    )
    path = F.regexp_replace(F.regexp_replace(clean(url), r"^[a-zA-Z]+://[^/]*", ""), r"[?#].*$", "")
    return F.coalesce(F.nullif(relation_type(path, 1), F.lit("")), spoken)


def relation_identity(url: Column) -> Column:
    """struct(kind, number) of an address with a numbered relationship."""
    pattern = r"/(sample|cover|remix|interpolation)s?/(\d+)"
    return F.struct(F.regexp_extract(clean(url), pattern, 1).alias("kind"), F.regexp_extract(clean(url), pattern, 2).alias("number"))


def link_class(url: Column, artist_slug: Column, host: str = HOST) -> Column:
    """What an address is to the artist whose slug is given; the first rule that holds decides."""
    parts = F.transform(path_parts(url), unquote)
    first, second = F.lower(F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit(""))), F.lower(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")))
    own, n = first == F.lower(clean(artist_slug)), F.size(parts)
    return (
        F.when(foreign(url, host), "external").when(n == 0, "site_root").when(first.isin(*RELATION_WORDS), "relationship_detail")
        .when(~own, "other").when((n == 1) & has_query(url), "artist_pagination").when(n == 1, "artist_profile")
        .when(second.isin(CATALOG_WORDS), "artist_catalog_page").when(n == 2, "artist_track_candidate").otherwise("artist_internal_other")
    )


def artist_link_class(url: Column, artist_slug: Column, host: str = HOST) -> Column:
    """``link_class`` for listings: pages and profile are one class, and subpages are told from tracks."""
    parts = F.transform(path_parts(url), unquote)
    first, second = F.lower(F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit(""))), F.lower(F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")))
    own, n = first == F.lower(clean(artist_slug)), F.size(parts)
    return (
        F.when(foreign(url, host), "external").when(n == 0, "site_root").when(first.isin(*RELATION_WORDS), "relationship_detail")
        .when(~own, "other").when(n == 1, "artist_listing").when(second.isin(SUBPAGES), "artist_subpage")
        .when(n == 2, "track_candidate").otherwise("artist_internal_other")
    )


def canonical_role(c: Column) -> Column:
    """The canonical role of a source role, else the role in lower case with '_' for blanks."""
    role = F.lower(clean(c))
    out = F.replace(role, F.lit(" "), F.lit("_"))
    for source, target in ROLES.items():
        out = F.when(role == source, target).otherwise(out)
    return out


def safe_filename(c: Column, length: int = 150) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(clean(c), r'[\\/:*?"<>|]+', "_"), r"\s+", "_"), 1, length)


def archive_name(url: Column) -> Column:
    """Slug parts and ten hex digits of the address key."""
    return F.concat(
        F.substring(F.regexp_replace(F.array_join(path_parts(url), "-"), r"[^A-Za-z0-9-]+", "_"), 1, 120),
        F.lit("-"), F.substring(F.sha1(url_key_decoded(url)), 1, 10), F.lit(".html"),
    )


def track_uri(track_id: Column) -> Column:
    return F.when(clean(track_id) == "", "").otherwise(F.concat(F.lit("spotify:track:"), clean(track_id)))


def first_filled(*columns: Column) -> Column:
    """The first column that is not blank, else ''."""
    return F.coalesce(*[F.nullif(clean(c), F.lit("")) for c in columns], F.lit(""))


def url_hash_id(url: Column, prefix: str = "REC_") -> Column:
    """prefix + 16 hex digits of sha1 of the address itself, without a namespace."""
    return F.concat(F.lit(prefix), F.substring(F.sha1(F.coalesce(url, F.lit(""))), 1, 16))


def resolution_key(folded_title: Column, folded_artists: Column, year: Column) -> Column:
    """artists::title::year with distinct sorted artists (an array of folded names) and the first four characters of the year."""
    artists = F.array_join(F.array_sort(F.array_distinct(F.filter(folded_artists, lambda a: a != ""))), "|")
    return F.concat_ws("::", artists, F.coalesce(folded_title, F.lit("")), F.substring(clean(year), 1, 4))


def target_key(folded_title: Column, folded_artist: Column) -> Column:
    return F.concat(F.coalesce(folded_title, F.lit("")), F.lit("|"), F.coalesce(folded_artist, F.lit("")))


def review_row_key(*parts: Column) -> Column:
    """The cleaned parts with bars between them: address, track, artist, track id."""
    return F.concat_ws("|", *[clean(p) for p in parts])


def review_key(recording_id: Column, url: Column) -> Column:
    """The recording id, else the address behind 'whosampled:'."""
    return F.when(clean(recording_id) != "", clean(recording_id)).otherwise(F.concat(F.lit("whosampled:"), clean(url)))


def storage_key(artist_id: Column, explicit: Column, stored: Column) -> Column:
    """The artist's own id where a decision is stored under it, else the explicit key, else the id."""
    own = clean(artist_id)
    return F.when((own != "") & F.coalesce(stored, F.lit(False)), own).otherwise(F.coalesce(F.nullif(clean(explicit), F.lit("")), own))


def artist_uri(artist_id: Column) -> Column:
    return F.when(clean(artist_id) == "", "").otherwise(F.concat(F.lit("spotify:artist:"), clean(artist_id)))
