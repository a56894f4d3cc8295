"""Human review as tables: queues out, decisions in, and what a decision changes.

Decision tables have one row per key; the caller applies last-wins first where a store may repeat keys.
Texts are cleaned, blank and null are the same. ``as_of`` is the moment of the run, never the clock.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crateloom.functions import keys as K
from crateloom.functions.text import clean
from crateloom.operators.frames import ensure_columns, key

DECISIONS = ["accepted", "rejected", "unresolved"]
#: States that are still open, and states that count as reconciled.
OPEN_STATES = ["unresolved", "not_found", "artist_profile_only", "unmatched", "review"]
RECONCILED_STATES = ["accepted_reconciled", "reconciled", "merged", "accepted"]
#: Columns that a new parse takes over from the rows before it.
STATE_COLUMNS = [
    "spotify_match_status", "spotify_review_decision", "spotify_review_status", "spotify_match_method", "spotify_track_id", "spotify_candidate_track_id",
    "canonical_merge_status", "catalog_reconciliation_status", "canonical_recording_id", "catalog_reconciled_at", "canonical_identity_status", "canonical_identity_proposal_id",
]
PAGE_STATUS = {"accepted": "matched", "rejected": "rejected", "unresolved": "unresolved"}
CANDIDATE_STATUS = {"accepted": "matched", "rejected": "unmatched", "unresolved": "review"}


def low(c: str | Column) -> Column:
    return F.lower(clean(F.col(c) if isinstance(c, str) else c))


def _case(c: Column, table: dict[str, str], other: Column) -> Column:
    out = other
    for k, v in table.items():
        out = F.when(c == k, v).otherwise(out)
    return out


# ---- filters

def open_pool(tracks: DataFrame, matches: DataFrame, status: str, on: str = "spotify_track_id") -> DataFrame:
    """Tracks whose match is still open."""
    ids = matches.where(low(status).isin(OPEN_STATES)).select(key(on).alias("__k")).where("__k is not null").distinct()
    return tracks.join(ids, key(on) == F.col("__k"), "left_semi")


def reconciled(status: Column, merge_status: Column, canonical: Column) -> Column:
    """True for a row whose first non-blank state is a reconciled one, or that has a canonical id."""
    state = F.coalesce(F.nullif(clean(status), F.lit("")), clean(merge_status))
    return F.lower(state).isin(RECONCILED_STATES) | (clean(canonical) != "")


def accepted_with_url(reviews: DataFrame, url: str) -> DataFrame:
    return reviews.where((low("decision") == "accepted") & (clean(F.col(url)) != ""))


def exactly_one(df: DataFrame, wanted: Column, what: str) -> DataFrame:
    """The single row that fits; none or several fail when the frame is computed."""
    found = df.where(wanted)
    n = found.limit(2).agg(F.count("*").alias("__n"))
    stop = F.when(F.col("__n") != 1, F.raise_error(F.lit(f"not exactly one {what}"))).otherwise(F.lit(True))
    return found.limit(1).join(F.broadcast(n.select(stop.alias("__ok"))), F.col("__ok"), "right").drop("__ok")


def eligible_queue(queue: DataFrame, recordings: DataFrame, relationships: DataFrame) -> DataFrame:
    """Queued relationships of a canonical source whose address is not yet an edge."""
    ids = recordings.select(key("recording_id").alias("__r")).where("__r is not null").distinct()
    known = relationships.select(K.url_slash(F.col("whosampled_relationship_url")).alias("__u")).where("__u <> ''").distinct()
    url = K.url_slash(F.col("whosampled_relationship_url"))
    return (
        queue.where(url != "").join(ids, clean(F.col("canonical_source_recording_id")) == F.col("__r"), "left_semi")
        .join(known, url == F.col("__u"), "left_anti")
    )


def to_review(rows: DataFrame, reviews: DataFrame, on: str, learned: str) -> DataFrame:
    """Rows without an accepted decision: undecided ones, and others only where an address was learned since."""
    done = reviews.select(key(on).alias("__k"), low("decision").alias("__d"), clean(F.col("whosampled_artist_url")).alias("__u"))
    joined = rows.join(done, key(on) == F.col("__k"), "left")
    fresh = (clean(F.col(learned)) != "") & (clean(F.col(learned)) != F.coalesce("__u", F.lit("")))
    return joined.where(F.col("__d").isNull() | (~F.col("__d").isin("accepted") & fresh)).drop("__k", "__d", "__u")


# ---- queues

def queue(rows: DataFrame, order: Sequence[Column], partitions: int | None = None) -> DataFrame:
    """Rows with ``queue_position`` from 1 and ``queue_total``; the order must be total."""
    spark = rows.sparkSession
    from crateloom.runtime import materialize

    ordered = rows.repartitionByRange(*order) if partitions is None else rows.repartitionByRange(partitions, *order)
    placed = materialize(ordered.sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn(
        "__at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    sizes, before, total = sorted((r["_part"], r["n"]) for r in placed.groupBy("_part").agg(F.count("*").alias("n")).collect()), [], 0
    for part, size in sizes:
        before.append((part, total))
        total += size
    offsets = spark.createDataFrame(before, "_part int, _before long")
    return placed.join(F.broadcast(offsets), "_part").withColumn("queue_position", F.col("__at") + F.col("_before") + 1).withColumn(
        "queue_total", F.lit(total).cast("long")).drop("_part", "__at", "_before")


def undecided(rows: DataFrame, decisions: DataFrame, on: str, decision: str = "decision") -> DataFrame:
    """Rows whose key has no valid decision."""
    done = decisions.where(low(decision).isin(DECISIONS)).select(key(on).alias("__k")).where("__k is not null").distinct()
    return rows.join(done, key(on) == F.col("__k"), "left_anti")


def decision_counts(rows: DataFrame, decisions: DataFrame, on: str) -> DataFrame:
    """How many rows have each decision; 'open' for none."""
    one = decisions.where(low("decision").isin(DECISIONS)).select(key(on).alias("__k"), low("decision").alias("__d")).distinct()
    return rows.join(one, key(on) == F.col("__k"), "left").groupBy(F.coalesce("__d", F.lit("open")).alias("decision")).agg(F.count("*").alias("n"))


# ---- decisions

def restore_state(parsed: DataFrame, prior: DataFrame, on: str, columns: Sequence[str] = STATE_COLUMNS) -> DataFrame:
    """Newly parsed rows with the state columns of the rows before; a blank earlier state changes nothing."""
    kept = [c for c in columns if c in prior.columns]
    old = prior.select(key(on).alias("__k"), *[clean(F.col(c)).alias(f"__{c}") for c in kept])
    joined = ensure_columns(parsed, kept).join(old, key(on) == F.col("__k"), "left")
    fresh = {c: F.coalesce(F.nullif(F.col(f"__{c}"), F.lit("")), F.col(c).cast("string"), F.lit("")) for c in kept}
    return joined.withColumns(fresh).drop("__k", *[f"__{c}" for c in kept])


PROPOSAL = ["canonical_recording_id", "source_system", "source_identity", "candidate_system", "candidate_identity", "confidence_score", "evidence", "status", "source_title", "source_artist_names", "candidate_title", "candidate_artist_names", "candidate_url"]


def upsert_proposals(existing: DataFrame, new: DataFrame, as_of: Column) -> DataFrame:
    """Proposals by id: new ones replace all but the moment of discovery and the review; their status counts."""
    pid = K.proposal_id(clean(F.col("canonical_recording_id")), clean(F.col("candidate_system")), clean(F.col("candidate_identity")))
    fresh = new.select(pid.alias("proposal_id"), *[clean(F.col(c)).alias(c) for c in PROPOSAL]).dropDuplicates(["proposal_id"])
    fresh = fresh.withColumn("status", F.when(F.col("status").isin("pending", "accepted", "rejected"), F.col("status")).when(F.col("status") == "", "pending").otherwise(
        F.raise_error(F.concat(F.lit("invalid proposal status: "), F.col("status"))).cast("string")))
    columns = [F.coalesce("n.proposal_id", "e.proposal_id").alias("proposal_id")]
    isnew = F.col("n.proposal_id").isNotNull()
    columns += [F.when(isnew, F.col(f"n.{c}")).otherwise(F.col(f"e.{c}")).alias(c) for c in PROPOSAL]
    columns += [F.coalesce(F.nullif(F.col("e.discovered_at"), F.lit("")), as_of).alias("discovered_at"), F.when(isnew, as_of).otherwise(F.col("e.updated_at")).alias("updated_at")]
    columns += [F.coalesce(F.col(f"e.{c}"), F.lit("")).alias(c) for c in ("reviewed_at", "review_source")]
    return existing.alias("e").join(fresh.alias("n"), F.col("e.proposal_id") == F.col("n.proposal_id"), "full").select(*columns)


def proposals_for(proposals: DataFrame, system: str, identity: Column | str, statuses: Sequence[str] = ("pending", "accepted", "rejected")) -> DataFrame:
    wanted = F.lit(identity) if isinstance(identity, str) else identity
    return proposals.where((clean(F.col("candidate_system")) == system) & (clean(F.col("candidate_identity")) == wanted) & clean(F.col("status")).isin(*statuses))


def decide_proposals(proposals: DataFrame, decisions: DataFrame, as_of: Column) -> DataFrame:
    """Proposals with the decisions (proposal_id, decision, review_source) applied; other decisions fail."""
    d = decisions.select(key("proposal_id").alias("__k"), low("decision").alias("__d"), clean(F.col("review_source")).alias("__s"))
    d = d.withColumn("__d", F.when(F.col("__d").isin("accepted", "rejected"), F.col("__d")).otherwise(F.raise_error(F.lit("a decision must be accepted or rejected")).cast("string")))
    hit = F.col("__d").isNotNull()
    return proposals.join(d, key("proposal_id") == F.col("__k"), "left").withColumns({
        "status": F.coalesce("__d", "status"), "reviewed_at": F.when(hit, as_of).otherwise(F.col("reviewed_at")),
        "review_source": F.when(hit, F.col("__s")).otherwise(F.col("review_source")), "updated_at": F.when(hit, as_of).otherwise(F.col("updated_at")),
    }).drop("__k", "__d", "__s")


def proposal_status(decision: Column, reviewed_id: Column, row_id: Column, flagged: Column) -> Column:
    """An accepted review accepts the chosen candidate and rejects its siblings; a rejection rejects only the chosen one."""
    chosen = ((clean(reviewed_id) != "") & (clean(row_id) == clean(reviewed_id))) | low(flagged).isin("true", "1", "yes")
    d = low(decision)
    return F.when((d == "accepted") & chosen, "accepted").when(d == "accepted", "rejected").when((d == "rejected") & chosen, "rejected").otherwise("pending")


def apply_page_decisions(matches: DataFrame, decisions: DataFrame) -> DataFrame:
    """Match rows with the decision on their page; an accepted manual address replaces the page's."""
    manual = ["manual_whosampled_track_url", "manual_whosampled_artist_url"]
    d = decisions.select(key("spotify_track_id").alias("__k"), low("decision").alias("__d"), clean(F.col("reviewed_at")).alias("__at"),
                         F.coalesce(F.nullif(clean(F.col("decision_source")), F.lit("")), F.lit("contributor_review")).alias("__by"), *[clean(F.col(c)).alias(f"__{c}") for c in manual])
    hit = F.col("__k").isNotNull()
    wide = ensure_columns(matches, ["whosampled_review_decision", "whosampled_reviewed_at", "whosampled_review_decision_source", *manual])
    replaced = (F.col("__d") == "accepted") & (F.col(f"__{manual[0]}") != "")
    return wide.join(d, key("spotify_track_id") == F.col("__k"), "left").withColumns({
        "whosampled_review_decision": F.when(hit, F.col("__d")).otherwise(F.col("whosampled_review_decision")),
        "whosampled_reviewed_at": F.when(hit, F.col("__at")).otherwise(F.col("whosampled_reviewed_at")),
        "whosampled_review_decision_source": F.when(hit, F.col("__by")).otherwise(F.col("whosampled_review_decision_source")),
        **{c: F.when(hit, F.col(f"__{c}")).otherwise(F.col(c)) for c in manual},
        "whosampled_url": F.when(replaced, F.col(f"__{manual[0]}")).otherwise(F.col("whosampled_url")),
        "match_status": _case(F.col("__d"), PAGE_STATUS, F.col("match_status")),
    }).drop("__k", "__d", "__at", "__by", *[f"__{c}" for c in manual])


def apply_candidate_decisions(rows: DataFrame, decisions: DataFrame, on: str) -> DataFrame:
    """Relationship candidates with decision, note and status; only an accepted one keeps its code."""
    d = decisions.select(key(on).alias("__k"), low("decision").alias("__d"), clean(F.col("note")).alias("__n"), clean(F.col("reviewed_at")).alias("__at"))
    hit = F.col("__k").isNotNull()
    wide = ensure_columns(rows, ["spotify_review_decision", "spotify_review_note", "spotify_reviewed_at", "spotify_match_status", "spotify_isrc"])
    return wide.join(d, key(on) == F.col("__k"), "left").withColumns({
        "spotify_review_decision": F.when(hit, F.col("__d")).otherwise(F.col("spotify_review_decision")), "spotify_review_note": F.when(hit, F.col("__n")).otherwise(F.col("spotify_review_note")),
        "spotify_reviewed_at": F.when(hit, F.col("__at")).otherwise(F.col("spotify_reviewed_at")),
        "spotify_match_status": F.when(hit, _case(F.col("__d"), CANDIDATE_STATUS, F.lit("review"))).otherwise(F.col("spotify_match_status")),
        "spotify_isrc": F.when(hit & (F.col("__d") != "accepted"), F.lit(None)).otherwise(F.col("spotify_isrc")),
    }).drop("__k", "__d", "__n", "__at")


def flag_selected(candidates: DataFrame, reviews: DataFrame) -> DataFrame:
    """Candidates with the decision of their recording and 'true' at the chosen track; other decisions are ignored."""
    r = reviews.where(low("decision").isin(DECISIONS)).select(
        K.review_key(F.col("recording_id"), F.col("whosampled_url")).alias("__k"), low("decision").alias("__d"), clean(F.col("reviewed_at")).alias("__at"), clean(F.col("spotify_track_id")).alias("__t"))
    own = K.review_key(F.col("recording_id"), F.col("whosampled_url"))
    wide = ensure_columns(candidates, ["spotify_review_decision", "spotify_reviewed_at", "spotify_selected_candidate"])
    hit = F.col("__k").isNotNull()
    return wide.join(r, own == F.col("__k"), "left").withColumns({
        "spotify_review_decision": F.when(hit, F.col("__d")).otherwise(F.col("spotify_review_decision")),
        "spotify_reviewed_at": F.when(hit, F.col("__at")).otherwise(F.col("spotify_reviewed_at")),
        "spotify_selected_candidate": F.when(hit, F.when((F.col("__t") != "") & (clean(F.col("spotify_track_id")) == F.col("__t")), "true").otherwise("")).otherwise(F.col("spotify_selected_candidate")),
    }).drop("__k", "__d", "__at", "__t")


def learn_alias(aliases: DataFrame, learned: DataFrame, strict: bool = True) -> DataFrame:
    """(name, slugs) with newly learned (name, slug) in front.

    ``strict``: only names for which exactly one slug was learned, and other spellings of it (case, dashes) leave the
    list; else every slug is added that the list does not hold.
    """
    fresh = learned.select(key("name").alias("name"), key("slug").alias("slug")).where("name is not null and slug is not null").distinct()
    fresh = fresh.groupBy("name").agg(F.array_sort(F.collect_set("slug")).alias("__new"))
    fresh = fresh.where(F.size("__new") == 1) if strict else fresh
    joined = aliases.select("name", "slugs").join(fresh, "name", "full")
    old, new = F.coalesce("slugs", F.array().cast("array<string>")), F.coalesce("__new", F.array().cast("array<string>"))
    plain = lambda s: F.regexp_replace(F.lower(s), "[-_ ]", "")
    rest = F.filter(old, lambda o: ~F.exists(new, lambda n: plain(n) == plain(o))) if strict else old
    return joined.select("name", F.array_distinct(F.concat(F.array_except(new, F.lit([]).cast("array<string>") if strict else old), rest)).alias("slugs"))


def auto_accept(candidates: DataFrame, on: str, verified: Column) -> DataFrame:
    """The candidate of each key that has exactly one verified one."""
    good = candidates.where(verified)
    w = Window.partitionBy(on)
    return good.withColumn("__n", F.count("*").over(w)).where("__n = 1").drop("__n")


def drop_failed(candidates: DataFrame, profiles: DataFrame, url: str = "whosampled_url") -> DataFrame:
    """Candidates without those whose archived profile was not answered with 200; unknown profiles stay."""
    failed = profiles.where(F.coalesce(F.col("http_status").cast("int"), F.lit(0)) != 200).select(K.url_key_decoded(F.col("requested_url")).alias("__u")).distinct()
    return candidates.join(failed, K.url_key_decoded(F.col(url)) == F.col("__u"), "left_anti")
