"""The best pairs of two sides that share a block, found without scoring every pair of a block.

A block that is large on both sides is cut into jobs of at most ``CHUNK`` rows a side; every pair of a block meets in one
job. A job bounds the score of all its pairs from above: durations and years count exactly, and the letters that two texts
share, then their longest common subsequence, bound their sequence ratio. The pairs of highest bound are scored, the
``top``-th score of a row is its least, and of the rest only pairs whose bound reaches it are scored. So the best of every job are exact, and with them the best of all.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateloom.functions import similarity as S
from crateloom.runtime import materialize, parallelism

#: Rows of one side in a job, rows that a task takes at once, and how far a bound in single precision may be off.
CHUNK, BUCKET_ROWS, SLACK = 1_000, 10_000, 1e-5
#: Letters of one kind in a text that are compared one by one; more are bounded by their number.
REPEATS = 8
#: Pairs of a job that are scored without bounds, pairs of several jobs scored together, pairs whose ratios are taken at
#: once, and letters from which difflib differs.
FEW_PAIRS, BATCH_PAIRS, PAIRS_AT_ONCE, LONG = 500, 400_000, 2_048, 200
ATTRIBUTES = {"fold": "string", "base": "string", "names": "string", "album_fold": "string", "year": "int", "ms": "long"}
SCORES = [f"{k}_score" for k in S.CATALOG_WEIGHTS]


def _counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    letters = np.frombuffer("".join(texts).encode("ascii"), np.uint8)
    owner = np.repeat(np.arange(len(texts)), lengths)
    return np.bincount(owner * 128 + letters, minlength=len(texts) * 128).reshape(-1, 128), lengths


def shared_letters(a: list[str], b: list[str]) -> np.ndarray:
    """For every pair of two lists of folded texts a bound that their sequence ratio does not exceed."""
    (x, n), (y, m) = _counts(a), _counts(b)
    most = np.minimum(np.minimum(x.max(axis=0), y.max(axis=0)), REPEATS)
    letter = np.repeat(np.arange(128), most)
    level = np.concatenate([np.arange(1, k + 1) for k in most])
    common = (x[:, letter] >= level).astype(np.float32) @ (y[:, letter] >= level).astype(np.float32).T
    more_x, more_y = np.maximum(x - REPEATS, 0).sum(axis=1), np.maximum(y - REPEATS, 0).sum(axis=1)
    if more_x.any() and more_y.any():
        common += np.minimum(more_x[:, None], more_y[None, :])
    return 2 * common / np.maximum(n[:, None] + m[None, :], 1).astype(np.float32)


def shared_names(a: list[str], b: list[str]) -> np.ndarray:
    """The same for ``both_ways`` of every pair of two lists of names, each joined by a bar."""
    x, y = [t.split("|") for t in a], [t.split("|") for t in b]
    n, m = np.array([len(t) for t in x]), np.array([len(t) for t in y])
    one = shared_letters([p for t in x for p in t], [p for t in y for p in t])
    at_x, at_y = np.cumsum(n) - n, np.cumsum(m) - m
    there = np.add.reduceat(np.maximum.reduceat(one, at_y, axis=1), at_x, axis=0) / n[:, None].astype(np.float32)
    back = np.add.reduceat(np.maximum.reduceat(one, at_x, axis=0), at_y, axis=1) / m[None, :].astype(np.float32)
    return 0.65 * there + 0.35 * back


def _longest(text: np.ndarray, x: np.ndarray, n: np.ndarray, y: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and places of the longest run that text[x : x + n] shares with text[y : y + m], the first in x and then in y."""
    rows, columns = np.arange(n.max())[:, None], np.arange(m.max())[:, None]
    a = np.where(rows < n, text[np.minimum(x + rows, len(text) - 1)], 0)
    b = np.where(columns < m, text[np.minimum(y + columns, len(text) - 1)], 1)
    late = (255 - columns).astype(np.uint16)
    a, b = a.astype(np.uint8), b.astype(np.uint8)
    runs, place, best = np.zeros((len(b) + 1, len(x)), np.uint8), np.empty(b.shape, np.uint16), np.zeros(len(x), np.uint32)
    for i in range(len(a)):
        same = (a[i] == b).view(np.uint8)
        np.multiply(runs[:-1] + np.uint8(1), same, out=runs[1:])
        np.left_shift(runs[1:], 8, out=place, dtype=np.uint16)
        np.bitwise_or(place, late, out=place)
        top = place.max(axis=0).astype(np.uint32)
        np.maximum(best, ((top >> 8) << 16) | ((255 - i) << 8) | (top & 255), out=best)
    size = (best >> 16).astype(np.int64)
    return size, 256 - (best >> 8 & 255).astype(np.int64) - size, 256 - (best & 255).astype(np.int64) - size


def ratios(a: list[str], b: list[str]) -> np.ndarray:
    """``similarity.ratio`` of each pair of folded texts, for all pairs at once."""
    n, m = (np.fromiter(map(len, t), np.int64, len(t)) for t in (a, b))
    text = np.frombuffer(("".join(a) + "".join(b) + "|").encode("ascii"), np.uint8)
    x, y = np.cumsum(n) - n, n.sum() + np.cumsum(m) - m
    matched = np.zeros(len(a), np.int64)
    # From ``LONG`` letters on difflib leaves out frequent letters.
    long = np.maximum(n, m) >= LONG
    open_ = np.flatnonzero((n > 0) & (m > 0) & ~long)
    parts = open_, x[open_], n[open_], y[open_], m[open_]
    while len(parts[0]):
        order = np.argsort(parts[2] + parts[4], kind="stable")
        parts = tuple(p[order] for p in parts)
        cuts = [slice(k, k + PAIRS_AT_ONCE) for k in range(0, len(order), PAIRS_AT_ONCE)]
        size, i, j = map(np.concatenate, zip(*[_longest(text, *(p[c] for p in parts[1:])) for c in cuts]))
        hit = size > 0
        size, i, j = size[hit], i[hit], j[hit]
        owner, x, nx, y, my = (p[hit] for p in parts)
        matched += np.bincount(owner, size, len(a)).astype(np.int64)
        behind = [(x, i, y, j), (x + i + size, nx - i - size, y + j + size, my - j - size)]
        parts = tuple(np.concatenate([owner, owner]) if k < 0 else np.concatenate([t[k] for t in behind]) for k in (-1, 0, 1, 2, 3))
        rest = (parts[2] > 0) & (parts[4] > 0)
        parts = tuple(p[rest] for p in parts)
    out = 2.0 * matched / np.maximum(n + m, 1)
    for k in np.flatnonzero(long):
        out[k] = S.ratio(a[k], b[k])
    return out


def common(a: list[str], b: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For the pairs a[i], b[j] a closer bound of the ratio: their longest common subsequence, by bits of one word."""
    n, m = (np.fromiter(map(len, t), np.int64, len(t)) for t in (a, b))
    letters = np.zeros((len(a), max(1, min(64, n.max(initial=0)))), np.uint8)
    places = np.zeros((len(b), 128), np.uint64)
    for k, t in enumerate(a):
        if n[k] <= 64:
            letters[k, : n[k]] = np.frombuffer(t.encode("ascii"), np.uint8)
    for k, t in enumerate(b):
        if m[k] <= 64:
            np.bitwise_or.at(places[k], np.frombuffer(t.encode("ascii"), np.uint8), np.uint64(1) << np.arange(m[k], dtype=np.uint64))
    row = np.full(len(i), ~np.uint64(0))
    for k in range(letters.shape[1]):
        hit = row & places[j, letters[i, k]]
        row = (row + hit) | (row - hit)
    # Only places of letters ever change, so the zeros are the common letters.
    out = 2.0 * np.bitwise_count(~row) / np.maximum(n[i] + m[j], 1)
    return np.where((n[i] <= 64) & (m[j] <= 64), out, 1.0)


def common_names(a: list[str], b: list[str], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The same for lists of names, each joined by a bar."""

    def way(a: list[list[str]], b: list[list[str]], i: np.ndarray, j: np.ndarray) -> np.ndarray:
        n, m = np.array([len(t) for t in a]), np.array([len(t) for t in b])
        size = n[i] * m[j]
        pair = np.repeat(np.arange(len(i)), size)
        within = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
        x, y = (np.cumsum(n) - n)[i][pair] + within // m[j][pair], (np.cumsum(m) - m)[j][pair] + within % m[j][pair]
        one = common([p for t in a for p in t], [p for t in b for p in t], x, y)
        best = np.maximum.reduceat(one, np.flatnonzero(within % m[j][pair] == 0))
        return np.add.reduceat(best, np.cumsum(n[i]) - n[i]) / n[i]

    if not len(i):
        return np.zeros(0)
    a, b = [t.split("|") for t in a], [t.split("|") for t in b]
    return 0.65 * way(a, b, i, j) + 0.35 * way(b, a, j, i)


def _steps(difference: np.ndarray, table: list[tuple[float, float]]) -> np.ndarray:
    return np.array([s for _, s in table] + [0.0])[np.searchsorted([k for k, _ in table], difference, side="left")]


def titles(a: list[tuple], b: list[tuple]) -> np.ndarray:
    return np.maximum(*(ratios([t[k] for t in a], [t[k] for t in b]) for k in (0, 1)))


def artists(a: list[str], b: list[str]) -> np.ndarray:
    """``similarity.both_ways`` of each pair of lists of names, joined by a bar."""
    out = 0.65 * (there := ratios([t if "|" not in t else "" for t in a], [t if "|" not in t else "" for t in b])) + 0.35 * ratios([t if "|" not in t else "" for t in b], [t if "|" not in t else "" for t in a])
    out[there == 1.0] = 1.0
    many = [k for k in range(len(a)) if "|" in a[k] + b[k] and a[k] and b[k]]
    lists = [(a[k].split("|"), b[k].split("|")) for k in many]
    ways = [(p, q) for x, y in lists for p in x for q in y] + [(q, p) for x, y in lists for q in y for p in x]
    found = ratios([p for p, _ in ways], [q for _, q in ways]).tolist()
    at, back = 0, len(ways) // 2
    for k, (x, y) in zip(many, lists):
        n, m = len(x), len(y)
        rows, columns = found[at : at + n * m], found[back : back + n * m]
        at, back = at + n * m, back + n * m
        forth = sum(max(rows[r * m : r * m + m]) for r in range(n)) / n
        out[k] = 1.0 if set(x) == set(y) else 0.65 * forth + 0.35 * (sum(max(columns[r * n : r * n + n]) for r in range(m)) / m)
    return out


class Sides:
    """The rows of two sides, of which the pairs of row numbers are scored."""

    def __init__(self, left: dict[str, np.ndarray], right: dict[str, np.ndarray], top: int):
        self.left, self.right, self.top = left, right, top
        self.least = left["least"].astype(float)
        texts = lambda side: (("title", list(zip(side["fold"], side["base"]))), ("artist", side["names"]), ("album", side["album_fold"]))
        self.codes = {k: (pd.factorize(pd.Series(a, dtype=object)), pd.factorize(pd.Series(b, dtype=object))) for (k, a), (_, b) in zip(texts(left), texts(right))}

    def fixed(self, i, j) -> tuple[np.ndarray, ...]:
        """Seconds apart, scores of duration and year (null where one side has none) and whether both have an album."""
        there = self.left["timed"][i] & self.right["timed"][j]
        apart = np.where(there, np.abs(self.left["ms"][i] - self.right["ms"][j]) / 1000, np.nan)
        years = np.abs(self.left["year"][i] - self.right["year"][j])
        album = (self.left["album_fold"][i] != "") & (self.right["album_fold"][j] != "")
        return apart, np.where(there, _steps(apart, S.DURATION_A), np.nan), np.where(np.isnan(years), np.nan, _steps(years, S.YEAR_A)), album

    def bounds(self, i: slice, j: slice) -> dict[str, np.ndarray]:
        """Bounds of the text scores of every pair of two ranges."""
        out = {}
        for k, ((lc, lu), (rc, ru)) in self.codes.items():
            (a, at), (b, bt) = np.unique(lc[i], return_inverse=True), np.unique(rc[j], return_inverse=True)
            a, b = [lu[x] for x in a], [ru[x] for x in b]
            if k == "title":
                m = shared_letters([t[0] for t in a], [t[0] for t in b])
                if any(f != g for f, g in (*a, *b)):
                    m = np.maximum(m, shared_letters([t[1] for t in a], [t[1] for t in b]))
            else:
                m = (shared_names if k == "artist" else shared_letters)(a, b)
            out[k] = m[at[:, None], bt[None, :]]
        return out

    def high(self, parts: dict[str, np.ndarray], duration, year, album) -> np.ndarray:
        """The score for these text scores, or a bound of it for bounds of them."""
        scores = parts | {"duration": duration, "year": year, "album": np.where(album, parts["album"], np.nan)}
        # Summed in the order of ``similarity.weighted``, so that the last digit is the same.
        total, used = 0.0, 0.0
        for k, weight in S.CATALOG_WEIGHTS.items():
            total, used = total + np.where(np.isnan(scores[k]), 0.0, scores[k] * weight), used + np.where(np.isnan(scores[k]), 0.0, weight)
        return total / used

    def scored(self, i: np.ndarray, j: np.ndarray, known: dict[str, np.ndarray] | None = None) -> pd.DataFrame:
        """The pairs with all scores, as far as they reach the least of their left row; ``known``: bounds of the text scores."""
        apart, duration, year, album = self.fixed(i, j)
        columns = {"i": i, "j": j, "apart": apart, "duration": duration, "year": year, "has": album}
        columns |= known or {k: np.ones(len(i)) for k in self.codes}
        exact, closer = {"title": titles, "artist": artists, "album": ratios}, {"title": lambda a, b, i, j: np.maximum(*(common([t[k] for t in a], [t[k] for t in b], i, j) for k in (0, 1))), "artist": common_names, "album": common}
        for k, sharp in [*((k, False) for k in closer if known), *((k, True) for k in exact)]:
            (lc, lu), (rc, ru) = self.codes[k]
            pairs, back = np.unique(lc[columns["i"]].astype(np.int64) * len(ru) + rc[columns["j"]], return_inverse=True)
            (p, at), (q, bt) = np.unique(pairs // len(ru), return_inverse=True), np.unique(pairs % len(ru), return_inverse=True)
            a, b = [lu[x] for x in p], [ru[x] for x in q]
            columns[k] = (exact[k]([a[x] for x in at], [b[x] for x in bt]) if sharp else closer[k](a, b, at, bt))[back]
            columns["high"] = self.high({x: columns[x] for x in self.codes}, columns["duration"], columns["year"], columns["has"])
            near = columns["high"] >= self.least[columns["i"]] - (0.0 if sharp and k == "album" else SLACK)
            columns = {x: v[near] for x, v in columns.items()}
        columns["album"] = np.where(columns["has"], columns["album"], np.nan)
        return pd.DataFrame({"i": columns["i"], "j": columns["j"], **{f"{k}_score": columns[k] for k in S.CATALOG_WEIGHTS}, "duration_difference_seconds": columns["apart"], "match_score": columns["high"]})

    def bounded(self, i: slice, j: slice) -> pd.DataFrame:
        """Of every pair of two ranges those whose bound reaches the least, with the bounds; ``ahead``: the highest of a row."""
        rows, columns = np.arange(i.start, i.stop), np.arange(j.start, j.stop)
        known, first = self.bounds(i, j), min(2 * self.top, len(columns))
        _, duration, year, album = self.fixed(rows[:, None], columns[None, :])
        high = self.high(known, duration, year, album)
        ahead = np.zeros(high.shape, bool)
        np.put_along_axis(ahead, np.argpartition(high, high.shape[1] - first, axis=1)[:, high.shape[1] - first :], True, axis=1)
        r, c = np.nonzero(high >= self.least[rows][:, None] - SLACK)
        return pd.DataFrame({"i": rows[r], "j": columns[c], "high": high[r, c], "ahead": ahead[r, c], **{k: m[r, c].astype(float) for k, m in known.items()}})

    def _within(self, pairs: pd.DataFrame) -> pd.DataFrame:
        pairs = pairs[pairs["high"] >= self.least[pairs["i"]] - SLACK]
        return self.scored(pairs["i"].to_numpy(), pairs["j"].to_numpy(), {k: pairs[k].to_numpy() for k in self.codes})

    def _bounded_best(self, pairs: pd.DataFrame) -> pd.DataFrame:
        """The best of whole jobs: the pairs ahead give every row its least, which few of the others reach."""
        found = self._within(pairs[pairs["ahead"]])
        ordered = found.sort_values(["i", "match_score"], ascending=[True, False])
        kth = ordered[ordered.groupby("i").cumcount() == self.top - 1]
        self.least[kth["i"]] = np.maximum(self.least[kth["i"]], kth["match_score"])
        return self._cut(pd.concat([found, self._within(pairs[~pairs["ahead"]])]))

    def best(self, jobs: list[tuple[slice, slice]]) -> pd.DataFrame:
        """The best pairs of every left row in its job; many jobs are scored together."""
        size = lambda i, j: (i.stop - i.start) * (j.stop - j.start)
        found, few, many, n_few, n_many = [], [], [], 0, 0
        for k, (i, j) in enumerate(jobs):
            if size(i, j) > FEW_PAIRS:
                many.append(self.bounded(i, j))
                n_many += len(many[-1])
            else:
                n_few += size(i, j)
                few.append((np.repeat(np.arange(i.start, i.stop), j.stop - j.start), np.tile(np.arange(j.start, j.stop), i.stop - i.start)))
            last = k == len(jobs) - 1
            if few and (last or n_few > BATCH_PAIRS):
                found.append(self._cut(self.scored(*map(np.concatenate, zip(*few)))))
                few, n_few = [], 0
            if many and (last or n_many > BATCH_PAIRS):
                found.append(self._bounded_best(pd.concat(many)))
                many, n_many = [], 0
        out = pd.concat(found)
        return out.assign(left=self.left["id"][out["i"]]).drop(columns=["i", "j"])

    def _cut(self, found: pd.DataFrame) -> pd.DataFrame:
        found = found.assign(right=self.right["id"][found["j"]]).sort_values(["i", "match_score", "right"], ascending=[True, False, True])
        return found[found.groupby("i").cumcount() < self.top]


def best_in_blocks(left: DataFrame, right: DataFrame, top: int) -> DataFrame:
    """(left, right, scores): of every row of ``left`` the best ``top`` pairs in each job, with the ties by ``right`` that are first.

    Both sides have ``id``, ``block`` and ``ATTRIBUTES``, with one row an id and block; ``left`` has the score ``least``
    below which a pair is of no use. A pair may come out of several blocks, each time with the same scores.
    """
    spark = left.sparkSession
    number = lambda side, n: side.groupBy("block").agg(F.count("*").alias(n))
    parts = lambda n: F.ceil(F.col(n) / CHUNK).cast("int")
    sizes = materialize(number(left, "n").join(number(right, "m"), "block").select("block", "n", "m", parts("n").alias("of_left"), parts("m").alias("of_right")))
    rows = sizes.agg(F.sum(F.expr("n * of_right + m * of_left"))).first()[0] or 0
    tasks = 4 * parallelism(spark)
    buckets = max(tasks, rows // BUCKET_ROWS)

    def placed(side: DataFrame, own: str, other: str, is_left: bool) -> DataFrame:
        mine, theirs = F.pmod(F.xxhash64("id"), F.col(own)).cast("int"), F.explode(F.expr(f"sequence(0, {other} - 1)"))
        spots = side.join(sizes, "block").select("id", "block", *ATTRIBUTES, F.col("least") if is_left else F.lit(0.0).alias("least"), mine.alias("mine"), theirs.alias("theirs"))
        order = ("mine", "theirs") if is_left else ("theirs", "mine")
        job = F.concat_ws("|", "block", *order)
        return spots.select(F.pmod(F.xxhash64(job), F.lit(buckets)).alias("bucket"), job.alias("job"), F.lit(is_left).alias("is_left"), "id", *ATTRIBUTES, "least")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sides, jobs = _jobs(pdf, top)
        return sides.best(jobs)[columns] if jobs else pd.DataFrame(columns=columns)

    columns = ["left", "right", *SCORES, "duration_difference_seconds", "match_score"]
    types = ", ".join(f"{c} {'string' if c in ('left', 'right') else 'double'}" for c in columns)
    # One shuffle: the number given keeps AQE from merging jobs by their few bytes.
    both = placed(left, "of_left", "of_right", True).union(placed(right, "of_right", "of_left", False))
    both = both.withColumn("timed", F.col("ms").isNotNull()).withColumn("ms", F.coalesce("ms", F.lit(0)))
    return both.repartition(tasks, "bucket").groupBy("bucket").applyInPandas(run, types)


def _jobs(pdf: pd.DataFrame, top: int) -> tuple[Sides, list[tuple[slice, slice]]]:
    """Both sides of the rows, and the ranges of row numbers that meet."""
    pdf = pdf.sort_values("job", kind="stable")
    ranges, sides = [], []
    codes = pd.factorize(pdf["job"])[0]
    for is_left in (True, False):
        own = pdf["is_left"].to_numpy() == is_left
        sides.append({c: pdf[c].to_numpy()[own] for c in ("id", *ATTRIBUTES, "timed", "least")})
        sides[-1]["year"] = sides[-1]["year"].astype(float)
        ranges.append(np.searchsorted(codes[own], np.arange(codes[-1] + 2)).tolist())
    meets = [(slice(a, b), slice(c, d)) for a, b, c, d in zip(ranges[0], ranges[0][1:], ranges[1], ranges[1][1:]) if a < b and c < d]
    return Sides(*sides, top), meets
