"""Mixing sources to target weights with hash-threshold histograms.

Each document has a fixed 60-bit hash. A draw of a source is: all documents as often as they fit whole,
plus those whose hash lies under a threshold. Tokens are summed by source and hash bucket; the bucket in
which the budget ends is refined by the next bits, and only that one, until it holds one document.
Thresholds of all mixes come from the same sums and are nested: a smaller budget draws a subset of a
larger one. The draw is a filter, nothing is sorted.

The size of a mix is the largest at which no source must repeat a document more than ``max_repeats`` times,
or ``total_tokens`` where that is smaller. Sources of a mix without tokens cannot be drawn; the shares of
the others are scaled up and the report shows 0 for them. Documents of sources outside a mix, and with null
or blank source, are not drawn. Documents of one hash are drawn together. Texts without tokens follow their hash.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crateloom.functions.text import clean
from crateloom.llm.tokens import TOKENIZER, count_tokens
from crateloom.runtime import materialize, table

HASH_BITS, LEVEL_BITS = 60, 12
SEED = "crateloom-mix-1"


def hashed(counts: DataFrame) -> DataFrame:
    """(doc_id, source, n_tokens, h) with a hash of ``HASH_BITS`` bits."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col("doc_id")), 64 - HASH_BITS)
    return counts.select("doc_id", clean(F.col("source")).alias("source"), "n_tokens", h.alias("h"))


def budgets(totals: dict[str, int], targets: list, total_tokens: int | None = None) -> dict[tuple[str, str], float]:
    """Tokens that each (mix, source) should give."""
    out: dict[tuple[str, str], float] = {}
    for mix in sorted({t.mix_name for t in targets}):
        own = [t for t in targets if t.mix_name == mix and t.target_share > 0 and totals.get(t.source, 0) > 0 and t.max_repeats > 0]
        scale = sum(t.target_share for t in own)
        if not own:
            continue
        size = min(t.max_repeats * totals[t.source] * scale / t.target_share for t in own)
        size = size if total_tokens is None else min(size, total_tokens)
        for t in own:
            out[mix, t.source] = size * t.target_share / scale
    return out


def thresholds(docs: DataFrame, targets: list, total_tokens: int | None = None) -> list[tuple]:
    """(mix_name, source, whole draws, threshold) of every budget."""
    spark = docs.sparkSession
    sources = sorted({t.source for t in targets})
    docs = docs.where(F.col("source").isin(sources))
    shift = HASH_BITS - LEVEL_BITS
    bucket = F.shiftright("h", shift)
    # Rows to the driver: sources of the mixes times buckets, whatever the number of documents.
    first = docs.groupBy("source", bucket.alias("b")).agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n")).collect()
    totals: dict[str, int] = {}
    for r in first:
        totals[r.source] = totals.get(r.source, 0) + r.t
    open_, done = [], []
    for (mix, source), tokens in budgets(totals, targets, total_tokens).items():
        whole = int(tokens // totals[source] + 1e-9)
        open_.append((mix, source, whole, tokens - whole * totals[source], None))
    level = {(source, None): sorted((r.b, r.t, r.n) for r in first if r.source == source) for source in totals}
    while open_:
        deeper = []
        for mix, source, whole, left, prefix in open_:
            threshold = None
            for b, t, n in level[source, prefix]:
                if left >= t:
                    left -= t
                elif n == 1 or shift == 0:
                    threshold = (b + 1 if 2 * left >= t else b) << shift
                    break
                else:
                    deeper.append((mix, source, whole, left, b))
                    break
            else:
                threshold = (level[source, prefix][-1][0] + 1) << shift if level[source, prefix] else 0
            if threshold is not None:
                done.append((mix, source, whole, threshold))
        open_ = deeper
        if open_:
            ends = spark.createDataFrame(sorted({(s, p) for _, s, _, _, p in open_}), "source string, p long")
            inner = docs.withColumn("p", F.shiftright("h", shift)).join(F.broadcast(ends), ["source", "p"])
            shift -= LEVEL_BITS
            rows = inner.groupBy("source", "p", F.shiftright("h", shift).alias("b")).agg(
                F.sum("n_tokens").alias("t"), F.count("*").alias("n")
            ).collect()
            level = {}
            for r in rows:
                level.setdefault((r.source, r.p), []).append((r.b, r.t, r.n))
            for v in level.values():
                v.sort()
    return done


def draw(docs: DataFrame, cuts: list[tuple]) -> DataFrame:
    """(mix_name, doc_id, source, n_tokens, repeats) of the drawn documents."""
    small = docs.sparkSession.createDataFrame(cuts, "mix_name string, source string, whole int, threshold long")
    repeats = (F.col("whole") + (F.col("h") < F.col("threshold")).cast("int")).alias("repeats")
    return docs.join(F.broadcast(small), "source").select("mix_name", "doc_id", "source", "n_tokens", repeats).where("repeats > 0")


def _drawn(spark: SparkSession, sf_dir: str, path: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    docs = materialize(hashed(count_tokens(table(spark, sf_dir, "documents"), ["doc_id", "source"], path)))
    targets = table(spark, sf_dir, "mix_targets")
    return docs, draw(docs, thresholds(docs, targets.collect()))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The drawn documents of every mix and how often each is repeated."""
    return _drawn(spark, sf_dir)[1]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of every source in every mix."""
    _, drawn = _drawn(spark, sf_dir)
    got = drawn.groupBy("mix_name", "source").agg(
        F.sum(F.col("n_tokens") * F.col("repeats")).alias("drawn_tokens"), F.sum("repeats").alias("n_drawn"),
        F.max("repeats").alias("most_repeats"),
    )
    whole = got.groupBy("mix_name").agg(F.sum("drawn_tokens").alias("mix_tokens"))
    return (
        table(spark, sf_dir, "mix_targets").join(got, ["mix_name", "source"], "left").join(whole, "mix_name", "left")
        .select(
            "mix_name", "source", "target_share",
            F.round(F.coalesce(F.col("drawn_tokens") / F.col("mix_tokens"), F.lit(0.0)), 6).alias("actual_share"),
            F.coalesce("drawn_tokens", F.lit(0)).alias("drawn_tokens"), F.coalesce("n_drawn", F.lit(0)).alias("n_drawn"),
            "max_repeats", F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
        )
    )


QUERIES = {"p8_mix": p8_mix, "p8_shares": p8_shares}
SQL: dict[str, str] = {}
