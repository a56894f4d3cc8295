"""Matching two sources without keys: loopy belief propagation over candidate pairs.

The halves are brought to comparable attributes (core title, version, artists, milliseconds, album,
year, edition), candidates come from joins on composed keys, and each candidate pair gets the
log-odds of its attributes. One-to-one factors tie the pairs: a half of the right source belongs to
at most one recording; a recording pays for each further half, for it may have several track ids.
Messages go through grouped sums and joins until none changes by more than ``TOLERANCE``, under more
damping the longer it takes; ``FEWEST_HOPES`` rounds without that are an error, never a result. The belief
of a pair is its marginal match probability.

Every pair of one artist whose titles are near has a key in common: a title is cut into three segments
with a letter between them, so two slips, swaps included, leave one segment whole, at most two letters
from its place. Titles that differ in version, part or number are no candidates; all other pairs that
share a key are edges, however unlikely. Missing attributes weigh nothing.
Exact repeated halves count once; halves without title are left out, empty inputs give no pairs.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crateloom.functions.text import clean, fold_words
from crateloom.llm.name_variants import one_edit
from crateloom.runtime import materialize, materialize_observed, release, spread, table

#: Words that mark another edition of one recording.
EDITION = r"remaster(?:ed|izado|isé|isee)?|digital remaster|mono|stereo|single|album version|single version|radio edit|original version|deluxe|bonus track|reissue|anniversary edition|re-?issue|version single|edition|edición|edição|remasterizada|remastered version|original mix|version originale|versão original|versión original|explicit|clean"
_EDITION = re.compile(rf"(?:\d{{4}}\s+)?(?:{EDITION})(?:\s+(?:version|edition|{EDITION}))*(?:\s+\d{{4}})?", re.I)
#: Words that mark another recording, with the version they name.
VERSIONS = {"live": "live", "ao vivo": "live", "en vivo": "live", "en directo": "live", "remix": "remix", "mix": "mix", "dub": "dub", "demo": "demo", "acoustic": "acoustic", "acústico": "acoustic", "instrumental": "instrumental", "extended": "extended", "karaoke": "karaoke", "cover": "cover", "a cappella": "acapella", "acapella": "acapella", "edit": "edit", "rehearsal": "rehearsal", "session": "session", "alternate take": "take", "alt. take": "take", "take": "take", "unplugged": "acoustic", "reprise": "reprise", "interlude": "interlude", "version": "version", "orchestral": "orchestral"}
_TAIL = re.compile(r"^(.*\S)\s*(?:[(\[]([^()\[\]]*)[)\]]|\s[-–—]\s+([^()\[\]]+))\s*$")
_FEAT = re.compile(r"\s*[(\[]?\b(?:feat|ft|featuring)\b\.?\s.*$", re.I)
_PART = re.compile(r"[,\s(]*\b(?:pt|part|parte|teil)\.?\s*(\d+|[ivx]+)\b\)?", re.I)
_SPLIT = re.compile(r"\s*[,;|/\[\]]\s*|\s+(?:&|\+|·|×|x|vs\.?|feat\.?|ft\.?|featuring|with|con|and|e|y|et|und)\s+|\(feat\.?\s*|[()]", re.I)

#: Log-odds of the attributes, in nats.
TITLE_EQUAL, TITLE_CLOSE = 5.0, 3.5
ARTIST_EQUAL, ARTIST_SHARED, ARTIST_APART = 5.0, 2.5, -6.0
ALBUM_EQUAL, ALBUM_APART = 3.0, -0.7
PRIOR, CLIP = -6.0, 30.0
#: Nats that each further track id of one recording costs.
EXTRA_TRACK = 1.0
TOLERANCE, FEWEST_HOPES, DAMPING, ACCEPT = 0.01, 200, 0.3, 0.5
#: Slips that near titles may have, the segments that prove them, and the halves of one key that a task meets.
SLIPS, SEGMENTS, BLOCK_HALVES = 2, 3, 2000
#: Length from which one slip in each of two titles leaves them one title.
TWO_SLIPS = 6
#: Whole tails that are recognised with a slip of the pen.
PHRASES = ["live", "demo", "dub", "acoustic", "instrumental", "extended mix", "remaster", "remastered", "digital remaster", "mono", "stereo", "single version", "album version", "radio edit"]


def _straight(tail: str) -> str:
    """A tail one edit away from a known phrase becomes that phrase."""
    plain = re.sub(r"\s+", " ", re.sub(r"\d+", " ", fold_words(tail))).strip()
    if len(plain) < 4 or plain in PHRASES:
        return tail
    return next((p for p in PHRASES if len(p) > 3 and one_edit(plain, p)), tail)


def title_parts(title: str) -> tuple[str, str, str]:
    """(core, version, edition) of a title; a version is its kind and, after a colon, its name."""
    text = re.sub(r"\s+", " ", title or "").strip().rstrip("*.! ").strip()
    version, edition = [], []
    changed = True
    while changed:
        changed = False
        m = _TAIL.match(text)
        if not m:
            m2 = _FEAT.search(text)
            if m2 and m2.start() > 0:
                text, changed = text[: m2.start()].strip(), True
            continue
        tail = _straight((m[2] if m[2] is not None else m[3]).strip())
        low = tail.casefold()
        if _EDITION.fullmatch(tail):
            edition.append("remaster" if "remaster" in low else fold_words(re.sub(r"\d+", "", tail)))
        elif _FEAT.match(tail) or re.match(r"(feat|ft|featuring|with|con)\b", low):
            pass
        else:
            hit = next((v for k, v in VERSIONS.items() if re.search(rf"(?<!\w){re.escape(k)}(?!\w)", low)), None)
            if hit is None:
                break
            # a named mix is a version of its own, a place of a live take is not
            named = fold_words(tail) if hit in ("remix", "mix", "version", "edit", "take") else hit
            version.append(f"{hit}:{named}")
        text, changed = m[1].strip(), True
    m = _FEAT.search(text)
    if m and m.start() > 0:
        text = text[: m.start()]
    p = _PART.search(text)
    if p:
        version.append(f"pt{p[1].lower()}:")
        text = text[: p.start()] + " " + text[p.end() :]
    return fold_words(text), "|".join(sorted(set(version))), "|".join(sorted(set(edition)))


def artist_parts(names: str) -> list[str]:
    parts = (re.sub(r"^the ", "", fold_words(p.replace('"', " "))) for p in _SPLIT.split(names or ""))
    return sorted({p for p in parts if p})


def milliseconds(*values: str | None) -> float | None:
    """The first usable duration of texts like 287601, 287601.0, 281, 4:47 and PT4M47S."""
    for value in values:
        v = (value or "").strip()
        m = re.fullmatch(r"P?T?(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?", v)
        if m and any(m.groups()):
            h, mi, s = (float(g or 0) for g in m.groups())
            return (h * 3600 + mi * 60 + s) * 1000
        if re.fullmatch(r"(?:\d+:)?\d+:\d\d", v):
            total = 0
            for part in v.split(":"):
                total = total * 60 + int(part)
            return total * 1000.0
        try:
            n = float(v)
        except ValueError:
            continue
        if 0 < n < 10_000:
            n *= 1000
        if 1_000 <= n < 86_400_000:
            return n
    return None


SIDE = "id string, core string, version string, edition string, artists array<string>, ms double, album string, year int, keys array<long>"


def _segments(length: int) -> list[tuple[int, int]]:
    """(start, end) of the segments of a title, one letter apart; none where it is too short for them."""
    room = length - (SEGMENTS - 1)
    if room < SEGMENTS:
        return []
    out, at = [], 0
    for k in range(SEGMENTS):
        size = room // SEGMENTS + (k >= SEGMENTS - room % SEGMENTS)
        out.append((at, at + size))
        at += size + 1
    return out


def _pieces(core: str, left: bool) -> set[str]:
    """What near titles share: segments on the left, the same places and their neighbours on the right."""
    n, out = len(core), set()
    if left:
        out = {f"{n}.{k}.{core[a:b]}" for k, (a, b) in enumerate(_segments(n))}
        return out or {"short"}
    for length in range(n - SLIPS, n + SLIPS + 1):
        cuts = _segments(length)
        if not cuts and length >= 0:
            out.add("short")
        apart = n - length
        for k, (a, b) in enumerate(cuts):
            # at most k slips lie before the first whole segment, and the rest behind it
            for at in range(max(a - k, a + apart - (SLIPS - k), 0), min(a + k, a + apart + SLIPS - k) + 1):
                if at + b - a <= n:
                    out.add(f"{length}.{k}.{core[at : at + b - a]}")
    return out


def _less_one(tokens: list[str]) -> set[int]:
    """A number for each way to leave out one token, from rolling sums, so any length takes linear time."""
    prime, base = (1 << 61) - 1, 1_000_003
    values = [_hash(t) % prime for t in tokens]
    power, tail = [1], [0]
    for v in reversed(values):
        tail.append((v * power[-1] + tail[-1]) % prime)
        power.append(power[-1] * base % prime)
    out, head, n = set(), 0, len(tokens)
    for i, v in enumerate(values):
        out.add((head * power[n - 1 - i] + tail[n - 1 - i]) % prime)
        head = (head * base + v) % prime
    return out


def _keys(core: str, version: str, artists: list[str], ms: float | None, album: str, left: bool) -> list[int]:
    """Blocking keys. Near titles meet under each artist; whatever their artists, titles with a slip in one token
    meet under an album and equal ones under a duration, of which the right side visits three."""
    tokens = core.split()
    version = "|".join(v.partition(":")[0] for v in version.split("|"))
    out = {f"s|{a}|{version}|{x}" for a in artists for x in _pieces(core, left)}
    if album:
        half = (len(core) + 1) // 2
        less = _less_one(tokens) if len(tokens) > 1 else {core[:half] + "*", "*" + core[half:]}
        out |= {f"b|{album}|{x}|{version}" for x in less}
    if ms is not None:
        out |= {f"e|{core}|{version}|{int(ms // 2000) + n}" for n in ([0] if left else [-1, 0, 1])}
    return sorted(_hash(k) for k in out)


def _hash(key: str) -> int:
    """A long for a key; keys that collide only add candidates."""
    return int.from_bytes(hashlib.blake2b(key.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _side(rows: DataFrame, left: bool) -> DataFrame:
    """Attributes and keys of (id, title, artists, d1, d2, d3, album, year) rows."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for r in b.itertuples(index=False):
                core, version, edition = title_parts(r.title)
                if not core:
                    continue
                artists = artist_parts(r.artists)
                ms = milliseconds(r.d1, r.d2, r.d3)
                album = fold_words(r.album or "")
                year = re.search(r"(?:18|19|20)\d\d", r.year or "")
                keys = _keys(core, version, artists, ms, album, left)
                out.append((r.id, core, version, edition, artists, ms, album, int(year[0]) if year else None, keys))
            frame = pd.DataFrame(out, columns=[c.split()[0] for c in SIDE.split(", ")])
            frame["year"] = frame["year"].astype("Int32")
            yield frame

    return materialize(spread(rows.distinct()).mapInPandas(build, SIDE))


def candidates(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct (l, r) node pairs that share a key; nodes are numbered per distinct half."""
    a = left.select(F.col("node").alias("l"), F.explode("keys").alias("key"))
    b = right.select(F.col("node").alias("r"), F.explode("keys").alias("key"))
    # A hot key is cut into blocks on the right, which its halves on the left visit in tasks of their own.
    live = b.groupBy("key").agg(F.ceil(F.count("*") / F.lit(BLOCK_HALVES)).cast("int").alias("blocks"))
    a = a.join(live, "key").select("l", "key", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"))
    b = b.join(live, "key").select("r", "key", F.pmod(F.xxhash64("r"), F.col("blocks")).cast("int").alias("block"))
    return a.join(b, ["key", "block"]).select("l", "r").distinct()


def within(a: str, b: str, most: int) -> bool:
    """Whether at most ``most`` insertions, deletions, substitutions or swaps of neighbours part a and b."""
    if abs(len(a) - len(b)) > most:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    a, b = a[i:], b[i:]
    if not a or not b or most == 0:
        return len(a) + len(b) <= most
    if most == 1:
        return one_edit(a, b)
    return (
        within(a[1:], b[1:], most - 1) or within(a[1:], b, most - 1) or within(a, b[1:], most - 1)
        or (a[:2] == b[:2][::-1] and within(a[2:], b[2:], most - 1))
    )


@F.pandas_udf(T.BooleanType())
def _near(a: pd.Series, b: pd.Series) -> pd.Series:
    """Titles with one slip, or one in each where both are long enough."""
    return pd.Series([within(x, y, 2 if min(len(x), len(y)) >= TWO_SLIPS else 1) for x, y in zip(a, b)], dtype="bool")


def _unary() -> Column:
    """Log-odds of a pair by its attributes; null where titles or versions make it no candidate."""
    lc, rc = F.col("l_core"), F.col("r_core")
    near = _near(lc, rc)
    digits = F.regexp_replace(lc, r"\D+", " ") == F.regexp_replace(rc, r"\D+", " ")
    title = F.when(lc == rc, TITLE_EQUAL).when(near & digits, TITLE_CLOSE)
    shared = F.size(F.array_intersect("l_artists", "r_artists"))
    whole = F.array_sort("l_artists") == F.array_sort("r_artists")
    artist = (
        F.when((F.size("l_artists") == 0) | (F.size("r_artists") == 0), 0.0)
        .when(whole, ARTIST_EQUAL).when(shared > 0, ARTIST_SHARED)
        .when(F.levenshtein(F.array_join("l_artists", " "), F.array_join("r_artists", " "), 2) >= 0, ARTIST_SHARED)
        .otherwise(ARTIST_APART)
    )
    apart = F.abs(F.col("l_ms") - F.col("r_ms"))
    duration = (
        F.when(apart.isNull(), 0.0).when(apart <= 2000, 3.0).when(apart <= 4000, 2.0).when(apart <= 6100, 1.0)
        .when(apart <= 10000, -5.0).otherwise(-12.0)
    )
    album = F.when((F.col("l_album") == "") | (F.col("r_album") == ""), 0.0).when(
        (F.col("l_album") == F.col("r_album")) | (F.levenshtein("l_album", "r_album", 1) >= 0), ALBUM_EQUAL
    ).otherwise(ALBUM_APART)
    years = F.abs(F.col("l_year") - F.col("r_year"))
    year = F.when(years.isNull(), 0.0).when(years <= 1, 1.5).when(years <= 3, 0.3).otherwise(-0.7)
    named = F.levenshtein("l_version", "r_version", 2)
    version = F.when(named == 0, 0.0).when(named > 0, -1.0)
    odds = F.lit(PRIOR) + version + title + artist + duration + album + year
    return F.when(odds.isNotNull(), F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), odds)))


def _factor(edges: DataFrame, key: str, inward: str, out: str, extra: float | None, damping: float = DAMPING) -> DataFrame:
    """The message of a factor to each of its pairs, from what the other pairs claim.

    ``extra`` None: at most one pair is true. Otherwise each true pair beyond the first costs ``extra``
    nats; for odds a_i the message is log G - log(1 + e^extra (G - 1)) with G the product of
    (1 + a_i e^-extra), which tends to the former. Sums are combined before the shuffle, and a pair's own
    share is taken off its sum.
    """
    claim = F.least(F.lit(CLIP), F.col("theta") + F.col(inward))
    term = F.exp(claim) if extra is None else F.log1p(F.exp(claim - extra))
    total = edges.groupBy(key).agg(F.sum(term).alias("claims"))
    rest = F.greatest(F.lit(0.0), F.col("claims") - term)
    if extra is None:
        fresh = -F.log1p(rest)
    else:
        fresh = F.when(rest > CLIP, F.lit(-extra)).otherwise(rest - F.log1p(F.exp(F.lit(extra)) * F.expm1(rest)))
    return edges.join(total, key).withColumn(out, F.lit(1 - damping) * fresh + F.lit(damping) * F.col(out)).drop("claims")


def propagate(edges: DataFrame) -> DataFrame:
    """Marginals of (left_id, right_id, theta) edges under both factors, as column ``p``."""
    state = materialize(edges.withColumn("from_r", F.lit(0.0)).withColumn("from_l", F.lit(0.0)))
    for k in range(FEWEST_HOPES):
        damping = 1 - (1 - DAMPING) * 0.95 ** max(0, k - 10)
        before = state.withColumn("was", F.col("from_r") + F.col("from_l"))
        sent = _factor(_factor(before, "right_id", "from_l", "from_r", None, damping), "left_id", "from_r", "from_l", EXTRA_TRACK, damping)
        nxt, seen = materialize_observed(sent, moved=F.max(F.abs(F.col("from_r") + F.col("from_l") - F.col("was"))))
        moved = seen["moved"] or 0.0
        release(state)
        state = nxt
        # a damped step is so much shorter than the way that is left
        if moved < TOLERANCE * (1 - damping) / (1 - DAMPING):
            break
        state = nxt.drop("was")
        state._scratch_path = nxt._scratch_path
    else:
        raise RuntimeError(f"beliefs still move by {moved} after {FEWEST_HOPES} rounds")
    belief = F.col("theta") + F.col("from_r") + F.col("from_l")
    return state.withColumn("p", 1 / (1 + F.exp(-belief))).select("left_id", "right_id", "p")


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "artist_catalog_recordings_parsed")

    def pick(*columns: str) -> DataFrame:
        names = ["id", "title", "artists", "d1", "d2", "d3", "album", "year"]
        return rows.where(clean(F.col(columns[0])) != "").select(
            *[(F.lit(None).cast("string") if c is None else F.col(c).cast("string")).alias(n) for c, n in zip(columns, names)]
        )

    left = pick("recording_id", "whosampled_title", "whosampled_artist_names", "whosampled_duration_ms",
                "whosampled_duration_iso", "whosampled_duration", "whosampled_album", "whosampled_release_year")
    right = pick("spotify_track_id", "spotify_title", "spotify_artist_names", "spotify_duration_ms", None, None,
                 "spotify_album_name", "spotify_album_release_date")
    return left, right


def match(left: DataFrame, right: DataFrame) -> DataFrame:
    """(left_id, right_id, p) with the marginal probability of every candidate pair in question."""
    def numbered(side: DataFrame) -> DataFrame:
        return side.withColumn("node", F.xxhash64("id", "core", "version", "edition", "artists", "ms", "album", "year"))

    left, right = numbered(_side(left, True)), numbered(_side(right, False))
    pairs = candidates(left, right)
    of = lambda side, n: side.drop("keys").select(
        F.col("node").alias(n), *[F.col(c).alias(f"{n}_{c}") for c in ("id", "core", "version", "artists", "ms", "album", "year")]
    ).dropDuplicates([n])
    # Two swaps are four plain edits; what is farther apart needs no closer look.
    close = (F.col("l_core") == F.col("r_core")) | (F.levenshtein("l_core", "r_core", 4) >= 0)
    scored = pairs.join(of(left, "l"), "l").join(of(right, "r"), "r").where(close).withColumn("theta", _unary()).where("theta is not null")
    edges = scored.groupBy(F.col("l_id").alias("left_id"), F.col("r_id").alias("right_id")).agg(F.max("theta").alias("theta"))
    return propagate(edges)


def p3_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate pairs with their marginal match probability."""
    return match(*_halves(spark, sf_dir)).select(
        F.col("left_id").alias("recording_id"), F.col("right_id").alias("spotify_track_id"), F.round("p", 4).alias("confidence")
    )


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match(*_halves(spark, sf_dir)).where(F.col("p") >= ACCEPT).select(
        F.col("left_id").alias("recording_id"), F.col("right_id").alias("spotify_track_id")
    )


QUERIES = {"p3_found": p3_found, "p3_matches": p3_matches}
SQL: dict[str, str] = {}
