"""Titles, versions, years, durations and numbers, as JVM column expressions where they can be."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crateloom.functions.text import clean, fold_identity, strip_marks

#: Terms of a version (matched as substrings), of another identity and of a safe edition.
VERSION_TERMS = ["remix", "remastered", "remaster", "spotify singles", "live", "acoustic", "instrumental", "demo", "edit", "radio edit", "extended", "extended mix", "mono", "stereo", "karaoke", "slowed", "sped up", "speed up"]
IDENTITY_TERMS = ["remix", "remixed", "mix", "cover", "covered", "dub", "rework", "edit", "radio edit", "live", "acoustic", "instrumental", "demo", "karaoke", "mashup", "bootleg"]
EDITION_TERMS = ["version", "remaster", "remastered", "digital remaster", "mono", "stereo"]
#: Version suffixes, removed in this order.
VERSION_SUFFIXES = [
    r"(?i)\s*-\s*\d{4}\s+digital\s+remaster.*$", r"(?i)\s*-\s*remaster(?:ed|izado|izada)?.*$", r"(?i)\s*\(\s*remaster(?:ed)?[^)]*\)\s*$", r"(?i)\s*\[\s*remaster(?:ed)?[^\]]*\]\s*$",
    r"(?i)\s*-\s*radio\s+edit\s*$", r"(?i)\s*-\s*single\s+version\s*$", r"(?i)\s*-\s*album\s+version\s*$",
]
_IDENTITY = re.compile(r"\b(?:" + "|".join(IDENTITY_TERMS) + r")\b")
_BRACKET = re.compile(r"\s*[(\[]([^()\[\]]*)[)\]]")
_EDITION_TAIL = re.compile(r"^(.+?)\s+-\s+([^-]+)$")


def without_version(c: Column) -> Column:
    out = clean(c)
    for pattern in VERSION_SUFFIXES:
        out = F.regexp_replace(out, pattern, "")
    return F.trim(out)


def title_base(folded: Column) -> Column:
    """The folded title up to feat, featuring, ft or with."""
    return F.trim(F.regexp_replace(folded, r"\b(feat|featuring|ft|with)\b.*$", ""))


def version_terms(folded: Column) -> Column:
    return F.filter(F.array(*map(F.lit, VERSION_TERMS)), lambda t: F.contains(folded, t))


def changes_identity(text: str) -> bool:
    return bool(_IDENTITY.search(fold_identity(text)))


def title_variants(title: str) -> list[tuple[str, str]]:
    """Ordered distinct (variant, strategy): full, without harmless brackets, without edition, without both."""

    def bracketless(t: str) -> str:
        return re.sub(r"\s+", " ", _BRACKET.sub(lambda m: m[0] if changes_identity(m[1]) else "", t)).strip()

    def editionless(t: str) -> str:
        m = _EDITION_TAIL.match(t)
        tail = fold_identity(m[2]) if m else ""
        if m and any(re.search(rf"\b{e}\b", tail) for e in EDITION_TERMS) and not changes_identity(m[2]):
            return m[1].strip()
        return t

    title = (title or "").strip()
    steps = [(title, "full"), (bracketless(title), "bracketless"), (editionless(title), "editionless"), (editionless(bracketless(title)), "both")]
    seen, out = set(), []
    for text, strategy in steps:
        if text and text.casefold() not in seen:
            seen.add(text.casefold())
            out.append((text, strategy))
    return out


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("variant", T.StringType()), T.StructField("strategy", T.StringType())])))
def title_variants_udf(titles: pd.Series) -> pd.Series:
    return titles.map(lambda t: [{"variant": v, "strategy": s} for v, s in title_variants(t)])


def slugs(text: str) -> list[str]:
    """Address forms: words joined by dashes, with and without punctuation, in Unicode and ASCII."""
    joined = re.sub(r"\s+", "-", (text or "").strip())
    reduced = re.sub(r"-{2,}", "-", re.sub(r"[^\w-]+", "", joined)).strip("-")
    forms = [joined, strip_marks(joined).encode("ascii", "ignore").decode(), reduced, strip_marks(reduced).encode("ascii", "ignore").decode()]
    return list(dict.fromkeys(f for f in forms if f))


@F.pandas_udf(T.ArrayType(T.StringType()))
def page_candidates_udf(artist: pd.Series, title: pd.Series) -> pd.Series:
    """Artist slugs times title slugs of all variants, distinct, in order."""
    out = []
    for a, t in zip(artist, title):
        tails = list(dict.fromkeys(s for v, _ in title_variants(t) for s in slugs(v)))
        out.append([f"https://pages.example/{x}/{y}/" for x in slugs(a) for y in tails])
    return pd.Series(out)


def year_of(c: Column, centuries: str = "18|19|20") -> Column:
    """The first whole number of four digits of one of the centuries."""
    return F.nullif(F.regexp_extract(clean(c), rf"\b(?:{centuries})\d\d\b", 0), F.lit("")).cast("int")


def title_year(c: Column) -> Column:
    """The year that a title names, as text; '' without one."""
    return F.regexp_extract(clean(c), r"\b(?:19|20)\d\d\b", 0)


def compact_title(folded: Column) -> Column:
    """A folded title in which only a backslash with letters s behind it would go, so it is left as it is."""
    return F.regexp_replace(folded, r"\\s+", "")


def title_tokens(folded: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.split(folded, " "), lambda t: t != "")))


def iso_duration_seconds(c: Column) -> Column:
    """PT1H2M3.5S with whole hours and minutes to seconds; blank is null, 'PT' is 0."""
    text, pattern = c.cast("string"), r"^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?$"
    part = lambda k: F.coalesce(F.nullif(F.regexp_extract(text, pattern, k), F.lit("")).cast("double"), F.lit(0.0))
    return F.when(text.rlike(pattern), part(1) * 3600 + part(2) * 60 + part(3))


def spoken_seconds(c: Column) -> Column:
    """The first m:ss of a text, else minutes and seconds as words; null without either."""
    text = F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"(?U)\s+", " "))
    clock = r"\b(\d+):(\d\d)\b"
    words = r"(?i)\b(?:(\d+)\s*m(?:in(?:ute)?s?)?\s*)?(\d+(?:\.\d+)?)\s*s(?:ec(?:ond)?s?)?\b"
    part = lambda p, k: F.coalesce(F.nullif(F.regexp_extract(text, p, k), F.lit("")).cast("double"), F.lit(0.0))
    return F.when(text.rlike(clock), part(clock, 1) * 60 + part(clock, 2)).when(text.rlike(words), part(words, 1) * 60 + part(words, 2))


def display_number(c: Column, digits: int) -> Column:
    """A number as text with so many digits, '' where it is none."""
    value = F.bround(clean(c).try_cast("double"), digits)
    return F.when(value.isNull(), "").otherwise(F.format_string(f"%.{digits}f", value))


def year_prefix(c: Column) -> Column:
    return F.nullif(F.substring(clean(c), 1, 4), F.lit(""))


def iso_duration_ms(c: Column) -> Column:
    """PT1H2M3.5S to milliseconds, half-even; 'PT' alone and other text give null."""
    text = clean(c)
    pattern = r"^PT(?:(\d+(?:\.\d+)?)H)?(?:(\d+(?:\.\d+)?)M)?(?:(\d+(?:\.\d+)?)S)?$"

    def part(k: int) -> Column:
        return F.coalesce(F.nullif(F.regexp_extract(text, pattern, k), F.lit("")).cast("decimal(20,6)"), F.lit(0).cast("decimal(20,6)"))

    total = part(1) * 3600 + part(2) * 60 + part(3)
    return F.when(text.rlike(pattern) & (text != "PT"), F.bround(total * 1000).cast("bigint"))


def clock_seconds(c: Column) -> Column:
    """m:ss, h:mm:ss or '2 min 3 sec' to seconds."""
    text = F.lower(clean(c))
    parts = F.split(text, ":")
    clock = F.aggregate(parts, F.lit(0).cast("bigint"), lambda a, p: a * 60 + p.cast("bigint"))
    minutes, seconds = F.regexp_extract(text, r"(\d+)\s*min", 1), F.regexp_extract(text, r"(\d+)\s*sec", 1)
    spoken = F.coalesce(F.nullif(minutes, F.lit("")).cast("bigint"), F.lit(0)) * 60 + F.coalesce(F.nullif(seconds, F.lit("")).cast("bigint"), F.lit(0))
    return F.when(text.rlike(r"^\d+(:\d\d){1,2}$"), clock).when(text.rlike(r"\d+\s*(min|sec)"), spoken)


def clock_text(ms: Column) -> Column:
    minutes = F.floor(ms / 60000)
    return F.when(ms > 0, F.format_string("%d:%02d", minutes, F.bround((ms - minutes * 60000) / 1000).cast("bigint")))


def rounded_int(c: Column) -> Column:
    """Half-even integer of float text, else null."""
    return F.bround(clean(c).try_cast("double")).cast("bigint")


def truncated_int(c: Column) -> Column:
    return clean(c).try_cast("double").cast("bigint")


def boolish(c: Column) -> Column:
    return F.lower(clean(c)).isin("true", "1", "yes")
