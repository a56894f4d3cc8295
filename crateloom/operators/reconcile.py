"""Reconciliation of catalogue rows with canonical tables, and the materialisation of credits and the library.

Every flow returns its tables as frames, with an ``issues`` frame (check_name, detail) of what must stop a write;
``gates`` fails on them. Ambiguity is a status, never a pick. Where the order of rows matters, ``position`` names
it; a promotion is seen by rows behind it only, as if they were read one after the other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crateloom.functions import arrays as A
from crateloom.functions import keys as K
from crateloom.functions import pages as P
from crateloom.functions import similarity as S
from crateloom.functions import titles as TT
from crateloom.functions.text import clean, fold_ascii_udf
from crateloom.operators import frames as O
from crateloom.operators import scoring as B
from crateloom.operators.frames import key
from crateloom.operators.reviews import low, reconciled
from crateloom.runtime import materialize

#: Source role of a catalogue credit to canonical role and function; other roles stop the run.
CATALOG_ROLES = {"track artist": ("performer", ""), "Producer": ("producer", ""), "Composer": ("composer", ""), "Composers": ("composer", ""), "Lyricist": ("lyricist", ""), "Writer": ("writer", ""), "Guest Vocals": ("performer", "guest_vocals")}
#: Older canonical roles and the role they became.
OLDER_ROLES = {"produced_by": "producer"}
#: Columns that an accepted catalogue row gives to its canonical recording.
CATALOG_FIELDS = [f"whosampled_{x}" for x in "url title artist_names album label release_year duration duration_iso duration_ms genre keywords thumbnail_url".split()] + ["youtube_video_id", "youtube_url", "youtube_thumbnail_url"]


def issue(df: DataFrame, name: str, detail: Column) -> DataFrame:
    return df.select(F.lit(name).alias("check_name"), detail.cast("string").alias("detail"))


def repeated(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    return issue(df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1"), name, F.concat_ws("|", *keys))


def gates(issues: DataFrame, message: str = "not written") -> None:
    """Stop before a write where a check has anything to say."""
    bad = issues.limit(10).collect()
    if bad:
        raise ValueError(f"{message}: " + "; ".join(f"{r.check_name}={r.detail}" for r in bad))


# ---- candidates of catalogue recordings

def score_candidates(catalog: DataFrame, pool: DataFrame, top: int = 5, least: float = 0.45) -> DataFrame:
    """Ranked candidates (candidate_rank, five scores, match_score, candidate_status) of every catalogue recording.

    ``catalog``: recording_id and title, artists, album, year, duration of the page, with its states; ``pool``: open
    tracks. Reconciled recordings are left out. Pairs are drawn by blocks: one folded title without version, or a
    common artist, or a common title word with a duration within ten seconds; each pair is scored once. A recording
    without a candidate of ``least`` has one row with status no_plausible_candidate. Scores of missing attributes are
    null and their weights go to the others. Ties go to the lesser track id.
    """
    year = lambda c: TT.year_of(F.col(c))
    catalog = O.ensure_columns(catalog, ["catalog_reconciliation_status", "canonical_merge_status", "canonical_recording_id"])
    left = catalog.where(~reconciled(F.col("catalog_reconciliation_status"), F.col("canonical_merge_status"), F.col("canonical_recording_id"))).select(
        clean(F.col("recording_id")).alias("recording_id"), clean(F.col("whosampled_title")).alias("title"), A.comma_names(F.col("whosampled_artist_names")).alias("artists"),
        clean(F.col("whosampled_album")).alias("album"), year("whosampled_release_year").alias("year"), TT.rounded_int(F.col("whosampled_duration_ms")).alias("ms")).dropDuplicates(["recording_id"])
    right = pool.where(key("spotify_track_id").isNotNull()).select(
        clean(F.col("spotify_track_id")).alias("spotify_track_id"), clean(F.col("title")).alias("title"), A.names(F.col("artists_json"), F.col("artist_names")).alias("artists"),
        clean(F.col("album_name")).alias("album"), year("album_release_date").alias("year"), TT.rounded_int(F.col("duration_ms")).alias("ms")).dropDuplicates(["spotify_track_id"])
    left, right = materialize(_folded(left), even=True), materialize(_folded(right), even=True)
    near = lambda d: F.floor(F.col("ms") / 10_000) + d

    def blocks(side: DataFrame, ident: str, shifts: list[int], timed: bool) -> DataFrame:
        words = F.filter(F.array_distinct(F.split("base", " ")), lambda w: F.length(w) > 2)
        plain = F.concat(F.array(F.concat(F.lit("t|"), F.col("base"))), F.transform(F.array_distinct("names"), lambda a: F.concat(F.lit("a|"), a)))
        by_word = F.coalesce(F.flatten(F.transform(words, lambda w: F.array(*[F.concat(F.lit("w|"), w, F.lit("|"), near(d).cast("string")) for d in shifts]))), F.array().cast("array<string>"))
        found = F.filter(by_word if timed else plain, lambda k: k.isNotNull() & ~k.isin("t|", "a|"))
        return side.withColumn("block", F.explode(found)).withColumnRenamed(ident, "id").withColumn("names", F.array_join("names", "|"))

    def best(left: DataFrame, timed: bool) -> DataFrame:
        pairs = B.best_in_blocks(blocks(left, "recording_id", [0], timed), blocks(right, "spotify_track_id", [-1, 0, 1], timed), top)
        return materialize(pairs.withColumnsRenamed({"left": "recording_id", "right": "spotify_track_id"}))

    # What titles and artists give is the least that a pair of a common word must reach.
    order = ("recording_id", "match_score", "spotify_track_id")
    first = best(left.withColumn("least", F.lit(least)), False).dropDuplicates(["recording_id", "spotify_track_id"])
    full = S.ranked(first, *order, top=top, least=least).where(F.col("rank") == top).select("recording_id", F.col("match_score").alias("reached"))
    rest = left.join(full, "recording_id", "left").withColumn("least", F.coalesce("reached", F.lit(least)))
    both = first.union(best(rest, True)).dropDuplicates(["recording_id", "spotify_track_id"])
    scores = list(S.CATALOG_WEIGHTS)
    kept = S.ranked(both, *order, top=top, least=least).withColumnRenamed("rank", "candidate_rank")
    columns = ["spotify_track_id", "candidate_rank", *[f"{k}_score" for k in scores], "duration_difference_seconds", "match_score"]
    out = left.select("recording_id").join(kept.select("recording_id", *columns), "recording_id", "left")
    return out.withColumn("candidate_status", F.when(F.col("spotify_track_id").isNull(), "no_plausible_candidate").otherwise("review"))


def _folded(side: DataFrame) -> DataFrame:
    out = side.withColumn("fold", fold_ascii_udf("title")).withColumn("base", fold_ascii_udf(TT.without_version(F.col("title"))))
    out = out.withColumn("album_fold", fold_ascii_udf("album"))
    return out.withColumn("names", F.filter(_fold_each("artists"), lambda a: a != "")).drop("artists")


@F.pandas_udf(T.ArrayType(T.StringType()))
def _fold_each(names):
    from crateloom.functions.text import fold_ascii

    return names.map(lambda x: [] if x is None else [fold_ascii(n or "") for n in x])


# ---- recordings

def reconcile_recordings(recordings: DataFrame, catalog: DataFrame, reviews: DataFrame, tracks: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """Accepted reviews enrich the canonical recording of their track; matched rows point to it, or become one.

    ``recordings`` has unique ids; ``position`` orders ``catalog`` and ``recordings``. Returns recordings, catalog,
    mappings (provisional_id, canonical_id, status) and issues.
    """
    owner = O.last_wins(recordings.where(key("spotify_track_id").isNotNull() & key("recording_id").isNotNull()).select(
        clean(F.col("spotify_track_id")).alias("track"), "position", clean(F.col("recording_id")).alias("canonical_id")), ["track"], "position").select("track", "canonical_id")
    rows = catalog.where(key("recording_id").isNotNull())
    last = O.last_wins(rows.select(clean(F.col("recording_id")).alias("provisional_id"), "position", *[c for c in CATALOG_FIELDS if c in catalog.columns],
                                   low("spotify_match_status").alias("match_status"), clean(F.col("spotify_track_id")).alias("track"),
                                   clean(F.col("canonical_recording_id")).alias("known"), clean(F.col("spotify_match_score")).alias("score")), ["provisional_id"], "position")
    accepted = reviews.where(low("decision") == "accepted").select(
        clean(F.col("recording_id")).alias("provisional_id"), clean(F.col("spotify_track_id")).alias("track"), clean(F.col("match_score")).alias("review_score"), F.col("position").alias("review_position"))
    accepted = accepted.join(owner, "track").join(last.drop("track"), "provisional_id")
    by_review = accepted.groupBy("provisional_id").agg(F.max_by("canonical_id", "review_position").alias("canonical_id")).withColumn("status", F.lit("accepted_reconciled"))

    waiting = last.where((F.col("known") == "") & (F.col("match_status") == "matched") & (F.col("track") != "")).join(by_review, "provisional_id", "left_anti")
    owned = waiting.join(owner, "track").select("provisional_id", "canonical_id", F.lit("matched_reconciled_existing").alias("status"))
    free = waiting.join(owner, "track", "left_anti")
    # The first row of a track becomes its recording, rows behind it point there.
    first = O.first_wins(free, ["track"], "position")
    promoted = first.select("provisional_id", F.col("provisional_id").alias("canonical_id"), F.lit("matched_promoted").alias("status"))
    behind = free.join(first.select("track", F.col("provisional_id").alias("canonical_id")), "track").where("provisional_id <> canonical_id").select(
        "provisional_id", "canonical_id", F.lit("matched_reconciled_existing").alias("status"))
    mappings = materialize(by_review.unionByName(owned).unionByName(promoted).unionByName(behind))

    # Enrichment of canonical rows: a non-blank value of the latest review that has one wins.
    values = [F.max_by(clean(F.col(c)), F.when(clean(F.col(c)) != "", F.col("review_position"))).alias(f"_{c}") for c in CATALOG_FIELDS if c in catalog.columns]
    gain = accepted.groupBy("canonical_id").agg(*values, F.max_by("review_score", "review_position").alias("_score"), F.max_by("provisional_id", "review_position").alias("_from"))
    wide = O.ensure_columns(recordings, [*CATALOG_FIELDS, "whosampled_match_status", "catalog_reconciliation_status", "catalog_review_score", "catalog_provisional_recording_id", "catalog_reconciled_at"])
    hit = F.col("canonical_id").isNotNull()
    done = wide.join(gain, key("recording_id") == F.col("canonical_id"), "left").withColumns({
        **{c: F.when(hit, O.overlay(F.col(c), F.col(f"_{c}"))).otherwise(F.col(c)) for c in CATALOG_FIELDS if f"_{c}" in gain.columns},
        "whosampled_match_status": F.when(hit, "matched").otherwise(F.col("whosampled_match_status")), "catalog_reconciliation_status": F.when(hit, "accepted_reconciled").otherwise(F.col("catalog_reconciliation_status")),
        "catalog_review_score": F.when(hit, F.col("_score")).otherwise(F.col("catalog_review_score")), "catalog_provisional_recording_id": F.when(hit, F.col("_from")).otherwise(F.col("catalog_provisional_recording_id")),
        "catalog_reconciled_at": F.when(hit, as_of).otherwise(F.col("catalog_reconciled_at")),
    }).select(*wide.columns)

    t = O.first_wins(tracks.where(key("spotify_track_id").isNotNull()).select(clean(F.col("spotify_track_id")).alias("track"), F.col("entry_id").alias("position"), *[
        c for c in ("title", "artist_names", "album_name", "album_label", "album_release_date", "album_id", "album_release_precision", "album_image_url", "spotify_uri", "spotify_url", "isrc", "duration_ms")]), ["track"], "position").drop("position")
    new = first.join(t, "track")
    col = lambda c: clean(F.col(c).cast("string"))
    made = {
        "recording_id": col("provisional_id"), "title": O.fill_from(col("title"), col("whosampled_title")), "artist_names": O.fill_from(col("artist_names"), col("whosampled_artist_names")),
        "album": col("album_name"), "label": col("album_label"), "release_year": F.substring(O.fill_from(col("album_release_date"), col("whosampled_release_year")), 1, 4), "duration": col("duration_ms"),
        "spotify_track_id": col("track"), "spotify_uri": col("spotify_uri"), "spotify_url": O.fill_from(col("spotify_url"), F.concat(F.lit("https://play.example/track/"), col("track"))), "spotify_isrc": col("isrc"),
        "spotify_album_name": col("album_name"), "spotify_album_id": col("album_id"), "spotify_album_release_date": col("album_release_date"), "spotify_album_release_precision": col("album_release_precision"),
        "spotify_album_image_url": col("album_image_url"), "spotify_album_label": col("album_label"), "spotify_duration_ms": F.col("duration_ms").cast("bigint"), "whosampled_match_status": F.lit("matched"),
        "catalog_reconciliation_status": F.lit("matched_promoted"), "catalog_review_score": F.col("score"), "catalog_provisional_recording_id": col("provisional_id"), "catalog_reconciled_at": as_of, "position": F.col("position"),
        **{c: col(c) for c in CATALOG_FIELDS if c in first.columns},
    }
    added = new.select(*[made[c].alias(c) for c in made if c in wide.columns])
    issues = issue(first.join(recordings.select(key("recording_id").alias("_r")).distinct(), F.col("provisional_id") == F.col("_r"), "left_semi"), "promoted_id_exists", F.col("provisional_id"))
    issues = issues.unionByName(issue(first.join(t, "track", "left_anti"), "no_cached_track", F.col("track")))
    linked = O.ensure_columns(catalog, ["canonical_recording_id", "catalog_reconciliation_status", "catalog_reconciled_at"]).join(
        mappings.toDF("_p", "_c", "_s"), key("recording_id") == F.col("_p"), "left").withColumns({
            "canonical_recording_id": F.coalesce("_c", "canonical_recording_id"), "catalog_reconciliation_status": F.coalesce("_s", "catalog_reconciliation_status"),
            "catalog_reconciled_at": F.when(F.col("_c").isNotNull(), as_of).otherwise(F.col("catalog_reconciled_at"))}).drop("_p", "_c", "_s")
    return {"recordings": done.unionByName(added, allowMissingColumns=True), "catalog": linked, "mappings": mappings, "issues": issues}


def propagate_ids(rows: DataFrame, mappings: DataFrame, source: str, target: str, status: str, as_of: Column) -> DataFrame:
    """Rows whose ``source`` id was mapped get the canonical id in ``target``; others stay."""
    m = mappings.select(F.col("provisional_id").alias("_p"), F.col("canonical_id").alias("_c"))
    wide = O.ensure_columns(rows, [target, "catalog_reconciliation_status", "catalog_reconciled_at"])
    hit = F.col("_c").isNotNull()
    return wide.join(m, key(source) == F.col("_p"), "left").withColumns({
        target: F.coalesce("_c", target), "catalog_reconciliation_status": F.when(hit, status).otherwise(F.col("catalog_reconciliation_status")),
        "catalog_reconciled_at": F.when(hit, as_of).otherwise(F.col("catalog_reconciled_at"))}).drop("_p", "_c")


# ---- artists of credits

def _sets(df: DataFrame, k: Column, ident: Column, name: Column) -> DataFrame:
    """Per key the least and greatest id, its name, and the ids as sorted JSON (bounded by the ids of one key)."""
    rows = df.select(F.nullif(k, F.lit("")).alias("_k"), F.nullif(ident, F.lit("")).alias("_id"), name.alias("_name")).where("_k is not null and _id is not null").distinct()
    return rows.groupBy("_k").agg(F.min("_id").alias("lo"), F.max("_id").alias("hi"), F.min_by("_name", "_id").alias("name"))


METHODS = ["accepted_artist_review_whosampled_url", "accepted_artist_review_alias", "exact_canonical_whosampled_url", "exact_canonical_name", "catalog_only"]
CONFLICTS = ["accepted_review_url_conflict", "accepted_review_alias_conflict", "exact_url_conflict", "exact_name_conflict", ""]


def reconcile_credits(credits: DataFrame, artists: DataFrame, reviews: DataFrame, searches: DataFrame) -> dict[str, DataFrame]:
    """Artists of catalogue credits by the ladder: review address, review alias, address, unique name, promotion.

    ``credits``: position, canonical_recording_id, artist_id, artist_name, artist_whosampled_url; only rows with a
    canonical recording take part. A conflict on a rung ends the row as ambiguous. An artist is promoted where the
    search for the provisional id found nothing and agrees in name and address; rows behind the promotion resolve by
    its address or name. Returns credits, promoted artists and issues (repeated identities).
    """
    fold = lambda c: fold_ascii_udf(c)
    a = materialize(artists.where(key("artist_id").isNotNull()).select(
        clean(F.col("artist_id")).alias("id"), clean(F.col("canonical_name")).alias("name"), fold("canonical_name").alias("fold"), clean(F.col("spotify_artist_id")).alias("sid"),
        K.url_key_plain(F.col("whosampled_url")).alias("url")).distinct())
    issues = reduce(DataFrame.unionByName, [
        issue(a.groupBy("id").agg(F.count("*").alias("n")).where("n > 1"), "repeated_artist_id", F.col("id")),
        issue(a.where("sid <> ''").groupBy("sid").agg(F.countDistinct("id").alias("n")).where("n > 1"), "repeated_spotify_id", F.col("sid")),
        issue(a.where("url <> ''").groupBy("url").agg(F.countDistinct("id").alias("n")).where("n > 1"), "repeated_address", F.col("url"))])
    by_sid, by_name = _sets(a, F.col("sid"), F.col("id"), F.col("name")), _sets(a, F.col("fold"), F.col("id"), F.col("name"))
    by_url = _sets(a, F.col("url"), F.col("id"), F.col("name"))

    r = reviews.where(low("decision") == "accepted").select(
        clean(F.col("spotify_artist_id")).alias("rsid"), fold("spotify_artist_name").alias("rfold"), K.url_key_plain(F.col("whosampled_artist_url")).alias("rurl"),
        fold_ascii_udf(P.name_of_slug(F.col("whosampled_artist_url"))).alias("rslug"))
    bridged = r.join(by_sid.toDF("rsid", "s_lo", "s_hi", "s_name"), "rsid", "left").join(by_name.toDF("rfold", "n_lo", "n_hi", "n_name"), "rfold", "left").select(
        "rurl", "rfold", "rslug", F.coalesce("s_lo", F.when(F.col("n_lo") == F.col("n_hi"), F.col("n_lo"))).alias("id"),
        F.when(F.col("s_lo").isNotNull(), F.col("s_name")).otherwise(F.col("n_name")).alias("name")).where("id is not null")
    bridged = materialize(bridged)
    alias = bridged.select("rfold", "id", "name").union(bridged.select("rslug", "id", "name"))
    review_url = _sets(bridged, F.col("rurl"), F.col("id"), F.col("name"))
    review_alias = _sets(alias, F.col("rfold"), F.col("id"), F.col("name"))

    rows = materialize(credits.where(key("canonical_recording_id").isNotNull()).withColumns({"_url": K.url_key_plain(F.col("artist_whosampled_url")), "_fold": fold("artist_name")}))
    out = rows
    for k, (probe, table) in enumerate([("_url", review_url), ("_fold", review_alias), ("_url", by_url), ("_fold", by_name)]):
        out = out.join(table.toDF(f"_k{k}", f"_lo{k}", f"_hi{k}", f"_name{k}"), F.nullif(F.col(probe), F.lit("")) == F.col(f"_k{k}"), "left").drop(f"_k{k}")
    status, found, name, method = F.lit("unresolved"), F.lit(""), F.lit(""), F.lit("")
    for k in reversed(range(4)):
        hit, clash = F.col(f"_lo{k}").isNotNull(), F.col(f"_lo{k}") != F.col(f"_hi{k}")
        status = F.when(hit & clash, "ambiguous").when(hit, "resolved").otherwise(status)
        found = F.when(hit & clash, "").when(hit, F.col(f"_lo{k}")).otherwise(found)
        name = F.when(hit & clash, "").when(hit, F.col(f"_name{k}")).otherwise(name)
        method = F.when(hit & clash, CONFLICTS[k]).when(hit, METHODS[k]).otherwise(method)
    out = materialize(out.withColumns({"artist_reconciliation_status": status, "canonical_artist_id": found, "canonical_artist_name": name, "artist_reconciliation_method": method}).drop(
        *[f"_{x}{k}" for x in ("lo", "hi", "name") for k in range(4)]))

    s = searches.where(low("status") == "no_results").select(clean(F.col("provisional_artist_id")).alias("_pid"), fold("artist_name").alias("_sfold"), K.url_key_plain(F.col("whosampled_url")).alias("_surl")).dropDuplicates(["_pid"])
    open_rows = out.where("artist_reconciliation_status = 'unresolved'")
    safe = open_rows.where(clean(F.col("artist_id")).startswith("ART_") & (clean(F.col("artist_name")) != "") & (F.col("_url") != "")).join(s, clean(F.col("artist_id")) == F.col("_pid")).where(
        "(_sfold = '' or _sfold = _fold) and (_surl = '' or _surl = _url)")
    known = a.select(F.col("id").alias("_aid"), F.col("name").alias("_aname")).dropDuplicates(["_aid"])
    safe = safe.join(known, clean(F.col("artist_id")) == F.col("_aid"), "left")
    reuse = safe.where("_aid is not null").select("position", F.col("_aid").alias("p_id"), F.col("_aname").alias("p_name"), F.lit("catalog_only_existing_canonical").alias("p_method"))
    fresh = safe.where("_aid is null")
    # One promotion per address, the row that comes first; another id with that address reuses it.
    first = O.first_wins(fresh.select("_url", "position", clean(F.col("artist_id")).alias("p_id"), clean(F.col("artist_name")).alias("p_name"), "_fold", clean(F.col("artist_whosampled_url")).alias("p_url")), ["_url"], "position")
    first = materialize(O.first_wins(first, ["p_id"], "position"))
    own = first.select("position", "p_id", "p_name", F.lit("catalog_only_canonical").alias("p_method"))
    by_addr = open_rows.join(first.select("_url", "p_id", "p_name", F.col("position").alias("_at")), "_url").where("position > _at").select("position", "p_id", "p_name", F.lit(METHODS[2]).alias("p_method"))
    names = first.groupBy("_fold").agg(F.min("p_id").alias("p_id"), F.max("p_id").alias("_hi"), F.min("p_name").alias("p_name"), F.max("position").alias("_at")).where("p_id = _hi and _fold <> ''")
    by_fold = open_rows.join(names, "_fold").where("position > _at").select("position", "p_id", "p_name", F.lit(METHODS[3]).alias("p_method"))
    order = F.when(F.col("p_method") == METHODS[2], 0).when(F.col("p_method") == METHODS[3], 1).otherwise(2)
    late = reduce(DataFrame.unionByName, [reuse, own, by_addr, by_fold]).groupBy("position").agg(F.min_by(F.struct("p_id", "p_name", "p_method"), order).alias("p"))
    done = out.join(late, "position", "left").withColumns({
        "artist_reconciliation_status": F.when(F.col("p").isNotNull(), "resolved").otherwise(F.col("artist_reconciliation_status")), "canonical_artist_id": F.coalesce("p.p_id", "canonical_artist_id"),
        "canonical_artist_name": F.coalesce("p.p_name", "canonical_artist_name"), "artist_reconciliation_method": F.coalesce("p.p_method", "artist_reconciliation_method")}).drop("p", "_url", "_fold")
    promoted = first.select(F.col("p_id").alias("artist_id"), F.col("p_name").alias("canonical_name"), F.col("p_url").alias("whosampled_url"))
    return {"credits": done, "artists": promoted, "issues": issues}


# ---- credits and evidence

def role_table(spark) -> DataFrame:
    return spark.createDataFrame([(k, r, f) for k, (r, f) in CATALOG_ROLES.items()], "source_role string, role string, function string")


def migrate_credits(credits: DataFrame, catalog: DataFrame, artists: DataFrame) -> dict[str, DataFrame]:
    """Assertions of both tables as canonical credits (one per recording, artist and role) and their evidence.

    The name of a credit is that of its artist, else the first that was asserted; orders are compared as numbers, and two
    orders of one credit are an issue, as are roles outside the closed table and repeated evidence.
    """
    spark = credits.sparkSession
    old = credits.select(F.lit(0).alias("_of"), "position", clean(F.col("recording_id")).alias("recording_id"), clean(F.col("artist_id")).alias("artist_id"), _older(clean(F.col("role"))).alias("role"),
                         F.lit("").alias("function"), clean(F.col("artist_name")).alias("artist_name"), *_assertion())
    ready = catalog.where(key("canonical_recording_id").isNotNull() & key("canonical_artist_id").isNotNull()).select(
        F.lit(1).alias("_of"), "position", clean(F.col("canonical_recording_id")).alias("recording_id"), clean(F.col("canonical_artist_id")).alias("artist_id"),
        O.fill_from(F.col("canonical_artist_name"), F.col("artist_name")).alias("artist_name"), *_assertion()).join(F.broadcast(role_table(spark)), "source_role", "left")
    issues = issue(old.where("recording_id = '' or artist_id = '' or role = ''"), "credit_without_key", F.col("position"))
    issues = issues.unionByName(issue(ready.where("role is null"), "unmapped_role", F.col("source_role")))
    rows = old.unionByName(ready.where("role is not null")).where("recording_id <> '' and artist_id <> '' and role <> ''")
    named = artists.where(key("artist_id").isNotNull()).groupBy(clean(F.col("artist_id")).alias("artist_id")).agg(F.max(clean(F.col("canonical_name"))).alias("_name"))
    place = F.struct("_of", "position")
    grouped = rows.groupBy("recording_id", "artist_id", "role").agg(
        A.serialize_functions(F.collect_set("function")).alias("function"), F.min("order").alias("artist_order"), F.countDistinct("order").alias("n_orders"),
        F.min_by("artist_name", F.when(F.col("artist_name") != "", place)).alias("_first"))
    keyed = grouped.withColumn("credit_id", K.parts_id("CRD", F.col("recording_id"), F.col("artist_id"), F.col("role")))
    issues = issues.unionByName(issue(keyed.where("n_orders > 1"), "order_conflict", F.col("credit_id")))
    out = keyed.join(named, "artist_id", "left").select("credit_id", "recording_id", "artist_id", O.fill_from(F.col("_name"), F.col("_first")).alias("artist_name"), "role", "function", "artist_order")
    evidence = rows.withColumn("credit_id", K.parts_id("CRD", F.col("recording_id"), F.col("artist_id"), F.col("role"))).select(
        K.parts_id("CRDE", *[F.col(c) for c in ("credit_id", "source_role", "source", "source_url")]).alias("credit_evidence_id"), "credit_id", "source_role", "source", "source_url")
    issues = issues.unionByName(repeated(evidence, ["credit_evidence_id"], "repeated_evidence"))
    return {"credits": out, "credit_evidence": evidence, "issues": issues}


def _older(c: Column) -> Column:
    out = c
    for k, v in OLDER_ROLES.items():
        out = F.when(c == k, v).otherwise(out)
    return out


def _assertion() -> list[Column]:
    return [clean(F.col("artist_order").cast("string")).try_cast("double").cast("int").alias("order"), *[clean(F.col(c)).alias(c) for c in ("source_role", "source", "source_url")]]


def materialize_credits(credits: DataFrame, evidence: DataFrame, catalog: DataFrame) -> dict[str, DataFrame]:
    """Catalogue assertions added to canonical credits and evidence; running it again adds nothing.

    Gates: repeated keys or ids before and after, evidence without credit, roles outside the closed table, and an order
    that differs from the credit's (both given). An existing credit only gains functions.
    """
    spark = credits.sparkSession
    ready = materialize(catalog.where(key("canonical_recording_id").isNotNull() & key("canonical_artist_id").isNotNull()).select(
        "position", clean(F.col("canonical_recording_id")).alias("recording_id"), clean(F.col("canonical_artist_id")).alias("artist_id"),
        O.fill_from(F.col("canonical_artist_name"), F.col("artist_name")).alias("artist_name"), *_assertion()).join(F.broadcast(role_table(spark)), "source_role", "left"))
    keys = ["recording_id", "artist_id", "role"]
    have = credits.select(*[clean(F.col(c)).alias(c) for c in keys], clean(F.col("credit_id")).alias("_id"), clean(F.col("artist_order").cast("string")).try_cast("double").cast("int").alias("_order"), F.col("function").alias("_function"))
    good = ready.where("role is not null").join(have, keys, "left")
    cid = F.coalesce("_id", K.parts_id("CRD", *[F.col(c) for c in keys]))
    good = materialize(good.withColumn("cid", cid))
    issues = [issue(ready.where("role is null"), "unmapped_role", F.col("source_role")), issue(good.where("_order is not null and `order` is not null and _order <> `order`"), "order_conflict", F.col("cid"))]
    gained = good.where("function <> ''").groupBy("cid").agg(F.array_sort(F.collect_set("function")).alias("_new"))
    kept = credits.join(gained, clean(F.col("credit_id")) == F.col("cid"), "left").withColumn(
        "function", F.when(F.col("_new").isNotNull(), A.serialize_functions(F.concat(A.parse_functions(F.col("function")), F.col("_new")))).otherwise(F.col("function"))).drop("cid", "_new")
    new = good.where("_id is null").groupBy(F.col("cid").alias("credit_id"), *keys).agg(
        F.min_by("artist_name", "position").alias("artist_name"), A.serialize_functions(F.collect_set("function")).alias("function"), F.min_by("order", "position").cast("string").alias("artist_order"))
    fresh = good.select(F.col("cid").alias("credit_id"), "source_role", "source", "source_url").distinct().join(
        evidence.select(*[clean(F.col(c)).alias(c) for c in ("credit_id", "source_role", "source", "source_url")]).distinct(), ["credit_id", "source_role", "source", "source_url"], "left_anti")
    fresh = fresh.withColumn("credit_evidence_id", K.parts_id("CRDE", *[F.col(c) for c in ("credit_id", "source_role", "source", "source_url")]))
    columns = ["credit_id", "recording_id", "artist_id", "artist_name", "role", "function", "artist_order"]
    all_credits = kept.select(*columns[:-1], F.col("artist_order").cast("string").alias("artist_order")).unionByName(new.select(*columns))
    all_evidence = evidence.select("credit_evidence_id", "credit_id", "source_role", "source", "source_url").unionByName(fresh.select("credit_evidence_id", "credit_id", "source_role", "source", "source_url"))
    issues += [repeated(all_credits, keys, "repeated_credit_key"), repeated(all_credits, ["credit_id"], "repeated_credit_id"), repeated(all_evidence, ["credit_evidence_id"], "repeated_evidence_id"),
               issue(all_evidence.join(all_credits.select("credit_id"), "credit_id", "left_anti"), "evidence_without_credit", F.col("credit_evidence_id"))]
    return {"credits": all_credits, "credit_evidence": all_evidence, "issues": reduce(DataFrame.unionByName, issues)}


# ---- library

LIBRARY = {"recordings": "recording_id", "artists": "artist_id", "credits": "credit_id", "credit_evidence": "credit_evidence_id", "relationships": "relationship_id"}


def library_errors(tables: dict[str, DataFrame]) -> DataFrame:
    """The five key rules as (check_name, n_rows). Blank artists, sources and targets are exempt, blank recordings and credits are not."""

    def missing(name: str, child: str, field: str, parent: str, exempt: bool) -> DataFrame:
        ids = tables[parent].select(F.col(LIBRARY[parent]).alias("_k")).distinct()
        refs = tables[child].withColumn("_k", F.coalesce(field, F.lit("")))
        refs = refs.where("_k <> ''") if exempt else refs
        return refs.join(ids, "_k", "left_anti").agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("check_name"), "n_rows")

    return O.union_all([
        missing("credit_recording", "credits", "recording_id", "recordings", False), missing("credit_artist", "credits", "artist_id", "artists", True),
        missing("evidence_credit", "credit_evidence", "credit_id", "credits", False), missing("relationship_source", "relationships", "source_recording_id", "recordings", True),
        missing("relationship_target", "relationships", "target_recording_id", "recordings", True)])


def merge_library(proposed: dict[str, DataFrame], library: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The merged tables, ``stats`` (table, outcome, n_cells) and ``issues``: other columns, blank or repeated ids, broken keys."""
    out, stats, issues = {}, [], []
    for name, ident in LIBRARY.items():
        p, old = proposed[name], library[name]
        if p.columns != old.columns:
            raise ValueError(f"{name}: other columns than the library")
        for side, df in (("proposed", p), ("library", old)):
            issues += [issue(df.where(F.coalesce(F.col(ident), F.lit("")) == ""), f"{side}_{name}_blank_id", F.lit("")), repeated(df, [ident], f"{side}_{name}_repeated_id")]
        out[name], cells = O.merge_cells(old, p, ident)
        stats.append(cells.groupBy("outcome").agg(F.count("*").alias("n_cells")).select(F.lit(name).alias("table_name"), "outcome", "n_cells"))
    errors = library_errors(out)
    issues.append(issue(errors.where("n_rows > 0"), "broken_key", F.col("check_name")))
    return {**out, "stats": O.union_all(stats), "issues": reduce(DataFrame.unionByName, issues)}


def memberships(tracks: DataFrame, recordings: DataFrame, existing: DataFrame, contributor_id: str) -> dict[str, DataFrame]:
    """Memberships of one contributor in the recordings of an import, and issues.

    Issues: entries without track id, tracks without recording, one track with several recordings, several entries of one
    recording, several playlists, and existing memberships with an id other than the computed one.
    """
    canon = recordings.where(key("spotify_track_id").isNotNull()).select(clean(F.col("spotify_track_id")).alias("_t"), clean(F.col("recording_id")).alias("recording_id")).distinct()
    seed = tracks.select(clean(F.col("spotify_track_id")).alias("_t"), clean(F.col("playlist_id")).alias("playlist_id"))
    mapped = seed.join(canon, "_t", "left")
    ident = K.parts_id("LIB", F.lit(contributor_id), F.col("recording_id"))
    issues = [issue(seed.where("_t = ''"), "entry_without_track", F.lit("")), repeated(canon, ["_t"], "repeated_identity"), issue(mapped.where("recording_id is null and _t <> ''").select("_t").distinct(), "no_recording", F.col("_t")),
              repeated(mapped.where("recording_id is not null"), ["recording_id"], "repeated_recording"),
              issue(seed.where("playlist_id <> ''").agg(F.countDistinct("playlist_id").alias("n")).where("n > 1"), "several_playlists", F.col("n")),
              issue(existing.where(F.col("contributor_id") == contributor_id).where(F.col("library_membership_id") != ident), "membership_id", F.col("library_membership_id"))]
    source = mapped.agg(F.max("playlist_id").alias("import_source_id"))
    wanted = mapped.where("recording_id is not null").select("recording_id").distinct().join(F.broadcast(source))
    proposed = wanted.select(ident.alias("library_membership_id"), F.lit(contributor_id).alias("contributor_id"), "recording_id", F.lit("bulk_import").alias("added_via"),
                             F.lit("spotify_playlist").alias("import_source_type"), "import_source_id", F.lit("").alias("added_at"))
    new = proposed.join(existing.select("contributor_id", "recording_id").distinct(), ["contributor_id", "recording_id"], "left_anti")
    return {"memberships": existing.unionByName(new), "new": new, "issues": reduce(DataFrame.unionByName, issues)}


# ---- identities

def identity_candidates(related: DataFrame, catalog: DataFrame) -> DataFrame:
    """Evidence on artists that still need an identity: that of related pages, and unresolved catalogue credits.

    One row per provisional artist, address key, type and recording, the first of the related ones before the others.
    """
    columns = ["provisional_artist_id", "artist_name", "whosampled_url", "evidence_type", "evidence_recording_id", "evidence_recording_url"]
    a = related.select(*[clean(F.col(c)).alias(c) for c in columns], F.struct(F.lit(0).alias("of"), F.col("position")).alias("_at"))
    b = catalog.where(key("canonical_recording_id").isNotNull() & (low("artist_reconciliation_status") == "unresolved") & (clean(F.col("artist_whosampled_url")) != "")).select(
        clean(F.col("artist_id")).alias(columns[0]), clean(F.col("artist_name")).alias(columns[1]), clean(F.col("artist_whosampled_url")).alias(columns[2]), clean(F.col("role")).alias(columns[3]),
        clean(F.col("canonical_recording_id")).alias(columns[4]), clean(F.col("source_url")).alias(columns[5]), F.struct(F.lit(1).alias("of"), F.col("position")).alias("_at"))
    rows = a.unionByName(b).where("provisional_artist_id <> '' and artist_name <> ''")
    same = [F.col(columns[0]), K.url_key_plain(F.col(columns[2])).alias("_u"), F.lower(columns[3]).alias("_e"), F.col(columns[4])]
    return rows.groupBy(*same).agg(F.min_by(F.struct(*[c for c in columns if c not in (columns[0], columns[4])]), "_at").alias("x")).select(
        columns[0], "x.artist_name", "x.whosampled_url", "x.evidence_type", columns[4], "x.evidence_recording_url")


def pending_searches(candidates: DataFrame, cache: DataFrame) -> DataFrame:
    """Artists, each by its first candidate, whose search is not in the cache with an answer."""
    first = O.first_wins(candidates.where(key("provisional_artist_id").isNotNull() & (clean(F.col("artist_name")) != "")).select(
        clean(F.col("provisional_artist_id")).alias("provisional_artist_id"), "position", clean(F.col("artist_name")).alias("artist_name"), clean(F.col("whosampled_url")).alias("whosampled_url")), ["provisional_artist_id"], "position")
    done = cache.where(F.col("status").isin("searched", "no_results")).select("provisional_artist_id").distinct()
    return first.join(done, "provisional_artist_id", "left_anti").drop("position")


def accepted_equivalences(reviews: DataFrame) -> DataFrame:
    """(page_key, spotify_key): identity folds of the page's name and of the names accepted for it."""
    from crateloom.functions.text import fold_identity_udf

    rows = reviews.where(low("decision") == "accepted").select(fold_identity_udf(P.name_of_last(F.col("whosampled_artist_url"))).alias("page_key"), fold_identity_udf(clean(F.col("spotify_artist_name"))).alias("spotify_key"))
    return rows.where("page_key <> '' and spotify_key <> ''").distinct()


def upgrade_reviews(rows: DataFrame, equivalences: DataFrame) -> DataFrame:
    """Resolutions in review become matched where a single artist on both sides was accepted as one, the title is exact,
    the years are equal and no conflict is noted. Columns: whosampled_artist_names, artist_names, match_status, title_score,
    year_difference, year_conflict, title_year_conflict, version_conflict, target_versions, candidate_versions."""
    from crateloom.functions.text import fold_identity_udf

    keyed = rows.withColumns({"page_key": fold_identity_udf(clean(F.col("whosampled_artist_names"))), "spotify_key": fold_identity_udf(clean(F.col("artist_names")))})
    joined = keyed.join(equivalences.withColumn("_same", F.lit(True)), ["page_key", "spotify_key"], "left")
    single = ~F.contains(F.coalesce("whosampled_artist_names", F.lit("")), F.lit(",")) & ~F.contains(F.coalesce("artist_names", F.lit("")), F.lit(","))
    clear = ~TT.boolish(F.col("year_conflict")) & ~TT.boolish(F.col("title_year_conflict")) & ~TT.boolish(F.col("version_conflict"))
    equal = F.array_sort(F.array_distinct("target_versions")) == F.array_sort(F.array_distinct("candidate_versions"))
    up = F.coalesce(F.col("_same") & single & (low("match_status") == "review") & (F.col("title_score") >= 0.98) & (F.col("year_difference") == 0) & clear & equal, F.lit(False))
    return joined.withColumn("match_status", F.when(up, "matched").otherwise(F.col("match_status"))).withColumn("artist_identity_upgrade", up).drop("page_key", "spotify_key", "_same")


# ---- pages and evidence

def orient(rows: DataFrame) -> DataFrame:
    """``orientation`` track_1_primary or track_2_primary of a relationship by its source's address; ``error`` where none or both fit."""
    s, a, b = (K.url_slash(F.col(c)) for c in ("source_url", "track_1_url", "track_2_url"))
    error = F.when(s == "", "source without address").when((a == "") | (b == ""), "track without address").when((s == a) & (s == b), "both tracks fit").when((s != a) & (s != b), "no track fits")
    return rows.withColumn("error", error).withColumn("orientation", F.when(error.isNull(), F.when(s == a, "track_1_primary").otherwise("track_2_primary")))


def evidence_lookup(wanted: DataFrame, index: DataFrame, url: str, kind: str | None = None) -> DataFrame:
    """``wanted`` with the number of evidence records of its address: 0 absent, 1 single, more ambiguous."""
    known = index if kind is None else index.where(F.col("evidence_type") == kind)
    n = known.groupBy(P.strict_url(F.col("source_url")).alias("_u")).agg(F.count("*").alias("n_evidence"), F.min("relative_path").alias("relative_path")).where("_u is not null")
    out = wanted.join(n, P.strict_url(F.col(url)) == F.col("_u"), "left").drop("_u").withColumn("n_evidence", F.coalesce("n_evidence", F.lit(0).cast("long")))
    return out.withColumn("evidence", F.when(F.col("n_evidence") == 0, "absent").when(F.col("n_evidence") == 1, "single").otherwise("ambiguous"))


def fetch_plan(wanted: DataFrame, cached: DataFrame, index: DataFrame, url: str) -> DataFrame:
    """Where each page comes from: cache, evidence store, or to_fetch."""
    have = cached.select(K.url_key_decoded(F.col("requested_url")).alias("_c")).where("_c <> ''").distinct()
    seen = evidence_lookup(wanted, index, url).join(have, K.url_key_decoded(F.col(url)) == F.col("_c"), "left")
    return seen.withColumn("fetch_plan", F.when(F.col("_c").isNotNull(), "cache").when(F.col("n_evidence") > 0, "evidence").otherwise("to_fetch")).drop("_c", "n_evidence", "relative_path", "evidence")


def documents_of(manifest: DataFrame, pages: DataFrame, key_url: str = "requested_url") -> DataFrame:
    """Archived pages of a manifest: status archived, the file is there, the first entry of an address counts."""
    ready = manifest.where(low("status") == "archived").withColumn("_u", K.url_key_no_query(F.col(key_url)))
    first = O.first_wins(ready.select("_u", "position", key_url, "archive_path"), ["_u"], "position")
    return first.join(pages.select(F.col("path").alias("archive_path"), "html"), "archive_path").drop("_u")


def find_by_canonical(wanted: DataFrame, parsed: DataFrame, url: str) -> DataFrame:
    """The archived page whose own canonical address is the wanted one; the least path where several are."""
    own = parsed.where(clean(F.col("canonical_url")) != "").groupBy(K.url_key_decoded(F.col("canonical_url")).alias("_u")).agg(F.min("path").alias("archive_path"))
    return wanted.join(own, K.url_key_decoded(F.col(url)) == F.col("_u"), "left").drop("_u")


def find_in_order(wanted: DataFrame, files: DataFrame, name: Column, directories: list[str]) -> DataFrame:
    """The file of a name in the first of the directories that has it."""
    rank = F.lit(None).cast("int")
    for k, d in reversed(list(enumerate(directories))):
        rank = F.when(F.col("path").startswith(d.rstrip("/") + "/"), k).otherwise(rank)
    listed = files.select("path", F.element_at(F.split("path", "/"), -1).alias("_n"), rank.alias("_rank")).where("_rank is not null")
    best = listed.groupBy("_n").agg(F.min_by("path", F.struct("_rank", "path")).alias("archive_path"))
    return wanted.join(best, name == F.col("_n"), "left").drop("_n")


def one_target(pages: DataFrame, page: str, target: str) -> DataFrame:
    """Issues: pages that lead to more than one canonical target."""
    return issue(pages.where(key(target).isNotNull()).groupBy(page).agg(F.countDistinct(target).alias("n")).where("n > 1"), "several_targets", F.col(page))


def unchanged(before: DataFrame, after: DataFrame, on: str, column: str) -> DataFrame:
    """Issues: rows whose guarded column is no longer what it was."""
    b, a = before.select(on, F.col(column).alias("_b")), after.select(on, F.col(column).alias("_a"))
    return issue(b.join(a, on).where("not (_a <=> _b)"), "changed", F.col(on))


# ---- targets

def targets(relationships: DataFrame) -> DataFrame:
    """Distinct targets of relationships: target_key, the first title and artist, and the number of relationships."""
    from crateloom.functions.text import fold_unicode_udf

    rows = relationships.where((clean(F.col("related_track")) != "") & (clean(F.col("related_artist")) != "")).select(
        "position", clean(F.col("related_track")).alias("title"), clean(F.col("related_artist")).alias("artist"))
    keyed = rows.withColumn("target_key", K.target_key(fold_unicode_udf("title"), fold_unicode_udf("artist")))
    return keyed.groupBy("target_key").agg(F.min_by("title", "position").alias("title"), F.min_by("artist", "position").alias("artist"), F.count("*").alias("relationship_count"))


def resolve_targets(wanted: DataFrame, pages: DataFrame) -> DataFrame:
    """Targets with the page that verifies: status, recording id from the page's address, blank where unresolved.

    ``pages``: title, artist_names (array) and canonical_url of archived pages. Pages are found by folded title.
    """
    from crateloom.functions.text import fold_unicode_udf

    p = pages.select(fold_unicode_udf("title").alias("_t"), F.transform("artist_names", lambda x: F.lower(clean(x))).alias("_a"), clean(F.col("canonical_url")).alias("url"), F.col("title").alias("source_title"), F.array_join("artist_names", ", ").alias("source_artists"))
    w = wanted.withColumn("_t", fold_unicode_udf("title")).withColumn("_e", F.array(F.lower(clean(F.col("artist")))))
    joined = w.join(p, "_t", "left")
    status = F.when(F.col("url").isNull(), "unresolved").otherwise(S.page_status(F.col("_t"), F.col("_e"), F.col("_t"), F.col("_a"), F.col("url"), K.relation_type(F.col("url")) != ""))
    order = F.struct(F.when(status == "matched", 0).when(status == "review", 1).otherwise(2), F.col("url"))
    best = joined.withColumn("status", status).groupBy(*wanted.columns).agg(F.min_by(F.struct("status", "url", "source_title", "source_artists"), order).alias("x"))
    matched = F.col("x.status") == "matched"
    return best.select(*wanted.columns, "x.status", F.when(matched, K.url_hash_id(F.col("x.url"))).otherwise("").alias("recording_id"), F.coalesce("x.url", F.lit("")).alias("whosampled_url"),
                       F.coalesce("x.source_title", F.lit("")).alias("source_title"), F.coalesce("x.source_artists", F.lit("")).alias("source_artists"))


def back_propagate(relationships: DataFrame, resolved: DataFrame) -> DataFrame:
    """Relationships with a blank target get the recording of their resolved target."""
    from crateloom.functions.text import fold_unicode_udf

    keyed = relationships.withColumn("_k", K.target_key(fold_unicode_udf(clean(F.col("related_track"))), fold_unicode_udf(clean(F.col("related_artist")))))
    r = resolved.where("status = 'matched' and recording_id <> ''").select(F.col("target_key").alias("_k"), F.col("recording_id").alias("_r")).dropDuplicates(["_k"])
    return keyed.join(r, "_k", "left").withColumn("target_recording_id", O.fill_from(F.col("target_recording_id"), F.col("_r"))).drop("_k", "_r")
