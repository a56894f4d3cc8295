"""Composite flows: canonical credits and evidence, memberships, resolution scores, library merge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crateloom.functions import keys as K
from crateloom.functions import similarity as S
from crateloom.functions import titles as TT
from crateloom.functions.text import clean, fold_ascii_udf
from crateloom.operators import frames as O
from crateloom.plans.reference_queries import QUERIES as _ALL
from crateloom.plans.reference_queries import SQL as _SQL
from crateloom.plans.reference_queries import c, query

_BEFORE = set(_ALL)

_ROLE = f"CASE {' '.join(f'''WHEN r = '{a}' THEN '{b}' ''' for a, b in K.ROLES.items())} ELSE regexp_replace(r, '[\\s-]+', '_', 'g') END"


def _canonical_credits(cr):
    part = cr.where((clean(F.col("recording_id")) != "") & (clean(F.col("artist_id")) != ""))
    named = part.select(
        clean(F.col("recording_id")).alias("recording_id"), clean(F.col("artist_id")).alias("artist_id"), K.canonical_role(F.col("role")).alias("role"),
        clean(F.col("artist_name")).alias("artist_name"), "artist_order", clean(F.col("source_role")).alias("source_role"), clean(F.col("source")).alias("source"), clean(F.col("source_url")).alias("source_url"))
    return named.withColumn("credit_key", K.parts_id("CRD", F.col("recording_id"), F.col("artist_id"), F.col("role")))


_CREDITS = f"""WITH x AS (SELECT {c('recording_id')} AS rec, {c('artist_id')} AS art, lower({c('role')}) AS r, {c('artist_name')} AS artist_name, artist_order, {c('source_role')} AS source_role, {c('source')} AS source, {c('source_url')} AS source_url FROM credits),
n AS (SELECT rec, art, {_ROLE} AS role, artist_name, artist_order, source_role, source, source_url FROM x WHERE rec <> '' AND art <> ''),
k AS (SELECT *, 'CRD_' || substr(sha1(concat_ws('|', rec, art, role)), 1, 16) AS credit_key FROM n)"""


@query("credits", sql=_CREDITS + """ SELECT credit_key, rec AS recording_id, art AS artist_id, role, min(artist_name) AS artist_name, CAST(min(artist_order) AS int) AS artist_order,
count(DISTINCT artist_order) > 1 AS order_conflict, count(*) AS n_assertions FROM k GROUP BY 1, 2, 3, 4""")
def credits_canonical(cr):
    """One credit per recording, artist and role; differing orders are reported, not guessed."""
    return _canonical_credits(cr).groupBy("credit_key", "recording_id", "artist_id", "role").agg(
        F.min("artist_name").alias("artist_name"), F.min("artist_order").alias("artist_order"),
        (F.countDistinct("artist_order") > 1).alias("order_conflict"), F.count("*").alias("n_assertions"))


@query("credits", sql=_CREDITS + """ SELECT DISTINCT 'CRDE_' || substr(sha1(concat_ws('|', credit_key, source_role, source, source_url)), 1, 16) AS evidence_key, credit_key, source_role, source, source_url FROM k""")
def credits_evidence(cr):
    k = _canonical_credits(cr)
    evidence = K.parts_id("CRDE", *[F.col(x) for x in ("credit_key", "source_role", "source", "source_url")])
    return k.select(evidence.alias("evidence_key"), "credit_key", "source_role", "source", "source_url").distinct()


@query("credits", sql=_CREDITS + " SELECT DISTINCT 'LIB_' || substr(sha1(concat_ws('|', art, rec)), 1, 16) AS membership_id, art AS artist_id, rec AS recording_id FROM k")
def library_memberships(cr):
    k = _canonical_credits(cr).select("artist_id", "recording_id").distinct()
    return k.select(K.parts_id("LIB", F.col("artist_id"), F.col("recording_id")).alias("membership_id"), "artist_id", "recording_id")


@query("relationships", sql=f"""WITH e AS (SELECT DISTINCT {c('source_recording_id')} AS s, {c('target_recording_id')} AS t FROM relationships WHERE {c('source_recording_id')} <> '' AND {c('target_recording_id')} <> '')
SELECT a.s AS recording_id, count(*) AS n_paths FROM e a JOIN e b ON a.t = b.s GROUP BY 1""")
def graph_two_steps(rel):
    """Paths of two relationships from every recording; degrees are joined, so no path is written out."""
    e = rel.select(clean(F.col("source_recording_id")).alias("s"), clean(F.col("target_recording_id")).alias("t")).where("s <> '' and t <> ''").distinct()
    degree = e.groupBy(F.col("s").alias("t")).agg(F.count("*").alias("d"))
    return e.join(degree, "t").groupBy(F.col("s").alias("recording_id")).agg(F.sum("d").alias("n_paths"))


@query("credits", sql=f"""WITH n AS (SELECT {c('artist_name')} AS name, count(*) AS n FROM credits WHERE {c('artist_name')} <> '' AND {c('artist_id')} = '' GROUP BY 1)
SELECT name, n AS n_credits, row_number() OVER (ORDER BY n DESC, name) AS place, count(*) OVER () AS n_queue FROM n""")
def review_queue(cr):
    """Names without id in the order in which they should be reviewed, with place and total."""
    n = cr.where((clean(F.col("artist_name")) != "") & (clean(F.col("artist_id")) == "")).groupBy(clean(F.col("artist_name")).alias("name")).agg(F.count("*").alias("n_credits"))
    # A global place without a global window: sort by ranges, number within partitions, add the sizes before.
    ordered = n.repartitionByRange(F.desc("n_credits"), "name").sortWithinPartitions(F.desc("n_credits"), "name")
    spark = n.sparkSession
    from crateloom.runtime import materialize

    placed = materialize(ordered.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    sizes, before, total = sorted((r.part, r.n) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect()), [], 0
    for part, size in sizes:
        before.append((part, total))
        total += size
    offsets = spark.createDataFrame(before, "part int, offset long")
    return placed.join(F.broadcast(offsets), "part").select("name", "n_credits", (F.col("at") + F.col("offset") + 1).alias("place"), F.lit(total).cast("long").alias("n_queue"))


@query("spotify_tracks", sql=f"""WITH t AS (SELECT {c('playlist_id')} AS p, {c('spotify_track_id')} AS t, entry_id FROM spotify_tracks), f AS (SELECT p, t, min(entry_id) AS first_entry, count(*) AS n FROM t WHERE t <> '' GROUP BY 1, 2)
SELECT p AS playlist_id, count(*) AS n_tracks, CAST(sum(n) AS bigint) AS n_entries, CAST(sum(n) - count(*) AS bigint) AS n_repeated, min(first_entry) AS first_entry FROM f GROUP BY 1""")
def playlist_membership(t):
    f = t.select(clean(F.col("playlist_id")).alias("playlist_id"), clean(F.col("spotify_track_id")).alias("t"), "entry_id").where("t <> ''").groupBy("playlist_id", "t").agg(F.min("entry_id").alias("e"), F.count("*").alias("n"))
    return f.groupBy("playlist_id").agg(F.count("*").alias("n_tracks"), F.sum("n").alias("n_entries"), (F.sum("n") - F.count("*")).alias("n_repeated"), F.min("e").alias("first_entry"))


def title_identity(a: Column, b: Column, terms_a: Column, terms_b: Column, base_a: Column, base_b: Column, full: Column, base: Column) -> Column:
    """Equal folded titles 1; equal bases 1, else the better of base and full ratio, 0.92 at least where one holds
    the other; differing version terms cost 0.18, 0.20 or 0.25, stacked; within 0 and 1."""
    contained = (base_a != "") & (base_b != "") & (F.contains(base_a, base_b) | F.contains(base_b, base_a))
    plain = F.when(base_a == base_b, 1.0).otherwise(F.greatest(base, full))
    plain = F.when(contained, F.greatest(plain, F.lit(0.92))).otherwise(plain)
    na, nb = F.size(terms_a), F.size(terms_b)
    apart = F.size(F.array_intersect(terms_a, terms_b)) == 0
    penalty = F.when((na > 0) & (nb == 0), 0.20).when((na == 0) & (nb > 0), 0.18).when((na > 0) & (nb > 0) & apart, 0.45).otherwise(0.0)
    return F.when((a == "") | (b == ""), 0.0).when(a == b, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), plain - penalty)))


@query("artist_catalog_recordings_parsed")
def resolution_scores(p):
    """Weighted resolution score of the halves that stand in one row, with the decision.

    An unknown year scores 0; a year that differs costs 0.15, a version that only the track has 0.12, versions that
    differ 0.15. The first branch that holds decides.
    """
    title_year = lambda x: F.nullif(F.regexp_extract(x, r"\b((?:19|20)\d{2})\b", 1), F.lit(""))
    rows = p.where(O.key("spotify_title").isNotNull() & O.key("whosampled_title").isNotNull()).select(
        "recording_id", "spotify_track_id", fold_ascii_udf("whosampled_title").alias("a"), fold_ascii_udf("spotify_title").alias("b"),
        O.split_list(F.lower(F.col("whosampled_artist_names"))).alias("na"), O.split_list(F.lower(F.col("spotify_artist_names"))).alias("nb"),
        TT.year_of(F.col("whosampled_release_year")).alias("ya"), TT.year_of(F.col("spotify_album_release_date")).alias("yb"),
        title_year("whosampled_title").alias("tya"), title_year("spotify_title").alias("tyb")).distinct()
    rows = rows.withColumns({"base_a": TT.title_base(F.col("a")), "base_b": TT.title_base(F.col("b")), "ta": TT.version_terms(F.col("a")), "tb": TT.version_terms(F.col("b"))})
    rows = rows.withColumns({"full": S.ratio_udf("a", "b"), "base": S.ratio_udf("base_a", "base_b"), "artist": S.best_name_udf("na", "nb"), "mutual": S.both_ways_udf("na", "nb")})
    title = title_identity(*[F.col(x) for x in ("a", "b", "ta", "tb", "base_a", "base_b", "full", "base")])
    year = S.year_score(F.col("ya"), F.col("yb"), S.YEAR_B)
    rows = rows.withColumns({"title": title, "year": year})
    known = {k: F.coalesce(F.col(k), F.lit(0.0)) for k in S.RESOLUTION_WEIGHTS}
    na, nb = F.size("ta"), F.size("tb")
    versions = (na > 0) & (nb > 0) & (F.size(F.array_intersect("ta", "tb")) == 0)
    penalty = F.when(F.col("ya") != F.col("yb"), 0.15).otherwise(0.0) + F.when((na == 0) & (nb > 0), 0.12).when(versions, 0.15).otherwise(0.0)
    score = F.greatest(F.lit(0.0), S.weighted(known, S.RESOLUTION_WEIGHTS) - penalty)
    strong = (F.col("title") >= 0.98) & (F.col("artist") >= 0.95)
    title_years = F.coalesce(F.col("tya") != F.col("tyb"), F.lit(False))
    decision = (
        F.when(strong & (F.col("ya") == F.col("yb")) & ~title_years & ~versions, "matched")
        .when(F.col("ya") != F.col("yb"), "review").when(title_years, "review").when(versions, "unmatched")
        .when((F.col("ya").isNull() | F.col("yb").isNull()) & strong, "review").when(F.col("score") >= 0.70, "review").otherwise("unmatched"))
    return rows.withColumn("score", F.round(score, 6)).select("recording_id", "spotify_track_id", F.round("title", 6).alias("title_score"), F.round("artist", 6).alias("artist_score"),
                                                            F.round("mutual", 6).alias("mutual_score"), "score", decision.alias("decision"))


QUERIES = {k: v for k, v in _ALL.items() if k not in _BEFORE}
SQL = {k: v for k, v in _SQL.items() if k in QUERIES}
