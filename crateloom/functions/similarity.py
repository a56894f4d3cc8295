"""Similarity, scores and decisions. Sequence ratio needs Python; everything else stays in the JVM."""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@lru_cache(maxsize=100_000)
def ratio(a: str, b: str) -> float:
    """Blank 0, equal 1, else the order-sensitive sequence ratio."""
    if not a or not b:
        return 0.0
    return 1.0 if a == b else SequenceMatcher(None, a, b).ratio()


@F.pandas_udf(T.DoubleType())
def ratio_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([ratio(x or "", y or "") for x, y in zip(a, b)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def best_name_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    """Best pair of two name lists: equal 1, containment 0.9, else ratio."""

    def one(x, y):
        scores = [1.0 if p == q else 0.9 if p in q or q in p else ratio(p, q) for p in x for q in y if p and q]
        return max(scores, default=0.0)

    return pd.Series([one(x if x is not None else [], y if y is not None else []) for x, y in zip(a, b)], dtype="float64")


def both_ways(x: list[str], y: list[str]) -> float:
    """0.65 of the mean best match forwards and 0.35 backwards; equal sets give 1."""
    x, y = [p for p in (x if x is not None else []) if p], [p for p in (y if y is not None else []) if p]
    if not x or not y:
        return 0.0
    if set(x) == set(y):
        return 1.0
    there = sum(max(ratio(p, q) for q in y) for p in x) / len(x)
    back = sum(max(ratio(p, q) for q in x) for p in y) / len(y)
    return 0.65 * there + 0.35 * back


@F.pandas_udf(T.DoubleType())
def both_ways_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    """``both_ways`` of two name lists."""
    return pd.Series([both_ways(x, y) for x, y in zip(a, b)], dtype="float64")


def steps(difference: Column, table: list[tuple[float, float]], beyond: float = 0.0) -> Column:
    """A score by the first limit that the difference does not exceed; null stays null."""
    out = F.lit(beyond)
    for limit, score in reversed(table):
        out = F.when(difference <= limit, score).otherwise(out)
    return F.when(difference.isNotNull(), out)


#: Seconds or years and their scores.
DURATION_A = [(2, 1.0), (5, 0.95), (10, 0.85), (20, 0.65), (30, 0.45), (60, 0.2)]
DURATION_B = [(2, 1.0), (5, 0.9), (10, 0.7), (20, 0.4)]
YEAR_A = [(0, 1.0), (2, 0.8), (5, 0.45)]
YEAR_B = [(0, 1.0), (1, 0.5), (3, 0.25)]
#: Weights of the catalogue score and of the resolution score.
CATALOG_WEIGHTS = {"title": 0.40, "artist": 0.35, "duration": 0.15, "year": 0.05, "album": 0.05}
RESOLUTION_WEIGHTS = {"title": 0.62, "artist": 0.28, "year": 0.10}


def duration_score(a_ms: Column, b_ms: Column, table=DURATION_A) -> Column:
    return F.when((a_ms > 0) & (b_ms > 0), steps(F.abs(a_ms - b_ms) / 1000, table))


def year_score(a: Column, b: Column, table=YEAR_A) -> Column:
    return steps(F.abs(a - b), table)


def weighted(scores: dict[str, Column], weights: dict[str, float]) -> Column:
    """Weighted mean over the scores that are not null; null when all are."""
    total = reduce(Column.__add__, [F.coalesce(scores[k] * w, F.lit(0.0)) for k, w in weights.items()])
    used = reduce(Column.__add__, [F.when(scores[k].isNotNull(), w).otherwise(0.0) for k, w in weights.items()])
    return F.when(used > 0, total / used)


def ranked(pairs: DataFrame, key: str, score: str, *ties: str, top: int = 5, least: float = 0.45) -> DataFrame:
    """Candidates of each key from rank 1, at most ``top`` with at least ``least``."""
    w = Window.partitionBy(key).orderBy(F.desc(score), *map(F.asc, ties))
    return pairs.where(F.col(score) >= least).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top)


def with_margin(pairs: DataFrame, key: str, score: str, *ties: str) -> DataFrame:
    """The best pair of each key with its margin to the second; alone it is its own margin."""
    w = Window.partitionBy(key).orderBy(F.desc(score), *map(F.asc, ties))
    return (
        pairs.withColumn("second", F.lead(score).over(w)).withColumn("rank", F.row_number().over(w)).where("rank = 1")
        .withColumn("margin", F.col(score) - F.coalesce("second", F.lit(0.0))).drop("rank", "second")
    )


def decision(score: Column, margin: Column, accept: float = 0.85, gap: float = 0.05, review: float = 0.75) -> Column:
    return F.when((score >= accept) & (margin >= gap), "matched").when(score >= review, "review").otherwise("unmatched")


def with_empty(groups: DataFrame, kept: DataFrame, key: str, candidate: str) -> DataFrame:
    """Every group with its ranked candidates; a group without any has one row with status no_plausible_candidate."""
    return groups.join(kept, key, "left").withColumn("candidate_status", F.when(F.col(candidate).isNull(), "no_plausible_candidate").otherwise("review"))


def duration_tiebreak(pairs: DataFrame, key: str, score: str, gap: str, *ties: str, near: float = 0.03) -> DataFrame:
    """Rank by score, but first the pair of least duration gap among those near the top score.

    ``margin`` is the score less that of the next pair in this order, so it may be negative; of the last it is its score.
    """
    best = Window.partitionBy(key)
    close = F.col(score) >= F.max(score).over(best) - near
    choice = Window.partitionBy(key).orderBy(F.desc("_close"), F.asc_nulls_last("_gap"), F.desc(score), *map(F.asc, ties))
    order = Window.partitionBy(key).orderBy(F.desc("_first"), F.desc(score), *map(F.asc, ties))
    return (
        pairs.withColumn("_close", close).withColumn("_gap", F.when(F.col("_close"), F.col(gap)))
        .withColumn("_first", F.row_number().over(choice) == 1).withColumn("rank", F.row_number().over(order))
        .withColumn("margin", F.col(score) - F.coalesce(F.lead(score).over(order), F.lit(0.0))).drop("_close", "_gap", "_first")
    )


#: Weights of the enrichment score and of the cache score, and what an exact title lifts the latter to.
ENRICHMENT_WEIGHTS = {"title": 0.60, "artist": 0.30, "year": 0.10}
CACHE_WEIGHTS, CACHE_FLOOR, CACHE_ARTIST = {"title": 0.65, "artist": 0.35}, 0.95, 0.80
#: Points of a knowledge-base candidate, occupations, kinds, and words that speak against music.
KB_POINTS = {"name": 100, "alias": 95, "human": 60, "group": 55, "occupation": 50, "description": 20, "bad": -100, "invalid": -120}
KB_OCCUPATIONS = ["Q639669", "Q177220", "Q36834", "Q488205", "Q753110", "Q158852", "Q130857", "Q855091"]
KB_HUMAN, KB_GROUP = "Q5", "Q215380"
KB_BAD_WORDS = ["album", "discography", "concert", "given name", "song", "film", "book", "episode", "box set"]
KB_GROUP_WORDS = ["band", "musical group", "music group", "rock band", "rock group", "duo", "trio", "quartet", "ensemble"]


def year_equal(a: Column, b: Column) -> Column:
    """1 for two equal years of digits (the second cut to four characters), else 0."""
    x, y = F.trim(a.cast("string")), F.substring(F.trim(b.cast("string")), 1, 4)
    return F.when(x.rlike(r"^\d+$") & y.rlike(r"^\d+$") & (x == y), 1.0).otherwise(0.0)


def year_conflict(a: Column, b: Column) -> Column:
    """True where both years are known and differ."""
    return F.coalesce(a != b, F.lit(False))


def summed(scores: dict[str, Column], weights: dict[str, float]) -> Column:
    """Weighted sum; a missing score counts 0 and its weight is not given to the others."""
    return reduce(Column.__add__, [F.coalesce(scores[k], F.lit(0.0)) * w for k, w in weights.items()])


def cache_score(title: Column, artist: Column, same_title: Column) -> Column:
    plain = summed({"title": title, "artist": artist}, CACHE_WEIGHTS)
    return F.when(same_title & (artist >= CACHE_ARTIST), F.greatest(plain, F.lit(CACHE_FLOOR))).otherwise(plain)


def cache_decision(score: Column, margin: Column) -> Column:
    return F.when((score >= 0.90) & (margin >= 0.05), "HIGH_CONFIDENCE").when(score >= 0.75, "REVIEW").otherwise("NO_CONFIDENT_MATCH")


def safe_cached(status: Column, track_id: Column, year_difference: Column, title_years: Column, versions: Column, duration: Column) -> Column:
    """Whether a cached match may be used as it is; a given duration always asks for new scores."""
    return F.coalesce(
        (status == "matched") & (track_id != "") & (year_difference == 0) & ~title_years & ~versions & (F.coalesce(duration, F.lit("")) == ""), F.lit(False)
    )


def kb_rank(target: Column, label: Column, aliases: Column, kinds: Column, occupations: Column, description: Column, music_words: list[str]) -> Column:
    """struct(score, exact, valid) of a knowledge-base candidate; texts and aliases are folded, ids are arrays.

    Words that speak against music are compared with single words, so those of two words never hit.
    """
    words = F.split(description, " ")
    has = lambda terms: reduce(Column.__or__, [F.contains(description, F.lit(t)) for t in terms], F.lit(False))
    name, alias = target == label, F.array_contains(aliases, target)
    human, group = F.array_contains(kinds, KB_HUMAN), F.array_contains(kinds, KB_GROUP)
    plays, told = F.arrays_overlap(occupations, F.array(*map(F.lit, KB_OCCUPATIONS))), has(music_words)
    bad = F.arrays_overlap(words, F.array(*map(F.lit, KB_BAD_WORDS)))
    valid = (human & (plays | told)) | group | plays | has(KB_GROUP_WORDS)
    points = lambda c, k: F.when(c, KB_POINTS[k]).otherwise(0)
    score = F.when(name, KB_POINTS["name"]).when(alias, KB_POINTS["alias"]).otherwise(0) + points(human, "human") + points(group, "group") + points(plays, "occupation") + points(told, "description") + points(bad, "bad") + points(~valid, "invalid")
    return F.struct(score.alias("score"), (name | alias).alias("exact"), valid.alias("valid"))


def kb_status(exact: Column, valid: Column, found: Column) -> Column:
    return F.when(~found, "not_found").when(exact & valid, "resolved").otherwise("review")


def page_status(expected_title: Column, expected_artists: Column, actual_title: Column, actual_artists: Column, url: Column, relationship: Column, cached: bool = False, two_parts: Column | None = None) -> Column:
    """matched, review or rejected for a page: equal folded titles, and any artist equal to or contained in another.

    A live page without address is for review, and one of a relationship is rejected; for a ``cached`` page anything
    but an address of two segments is rejected.
    """
    artist = F.exists(expected_artists, lambda e: F.exists(actual_artists, lambda a: F.contains(a, e) | F.contains(e, a)))
    verdict = F.when((expected_title == actual_title) & artist, "matched").otherwise("review")
    if cached:
        return F.when((url == "") | ~two_parts, "rejected").otherwise(verdict)
    return F.when(url == "", "review").when(relationship, "rejected").otherwise(verdict)


def loose_page(title: Column, page_title: Column, artists: Column, page_text: Column, track_page: Column) -> Column:
    """Whether a folded title stands in the page's title, and an artist of three letters or more in title or text."""
    named = F.exists(artists, lambda a: (F.length(a) >= 3) & F.contains(F.concat_ws(" ", page_title, page_text), a))
    return track_page & (title != "") & F.contains(page_title, title) & named


def saved_page(title: Column, canonical: Column, relationship: Column) -> Column:
    return (title != "") & (canonical != "") & ~relationship
