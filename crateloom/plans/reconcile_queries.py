"""Reconciliation, credits, library and review flows over whole tables, each beside the SQL that must agree.

The tables hold no reviews, so decisions are drawn from them by a stated rule: of the scored candidates of a catalogue
recording the best is accepted when it is matched, rejected when it is unmatched, else open.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from crateloom.functions import keys as K
from crateloom.functions import pages as P
from crateloom.functions import similarity as S
from crateloom.functions.text import clean, fold_ascii_udf
from crateloom.operators import frames as O
from crateloom.operators import reconcile as R
from crateloom.operators import reviews as V
from crateloom.plans.reference_queries import _CAND, _candidates, c, query
from crateloom.plans.reference_queries import QUERIES as _ALL
from crateloom.plans.reference_queries import SQL as _SQL

_BEFORE = set(_ALL)
AS_OF = "2026-01-01T00:00:00+00:00"

# ---- decisions drawn from the candidates

_BEST = _CAND + """, b AS (SELECT source_id, other, score, CASE WHEN score >= 0.85 AND margin >= 0.05 THEN 'accepted' WHEN score >= 0.75 THEN 'open' ELSE 'rejected' END AS decision FROM
 (SELECT *, row_number() OVER w AS rank, score - coalesce(lead(score) OVER w, 0) AS margin FROM e WINDOW w AS (PARTITION BY source_id ORDER BY score DESC, other)) WHERE rank = 1)"""


def _best(p, t):
    best = S.with_margin(_candidates(p, t), "source_id", "score", "other")
    decision = F.when((F.col("score") >= 0.85) & (F.col("margin") >= 0.05), "accepted").when(F.col("score") >= 0.75, "open").otherwise("rejected")
    return best.select("source_id", "other", "score", decision.alias("decision"))


def _recordings(r):
    part = r.where(O.key("recording_id").isNotNull()).select("recording_id", F.col("row_id").alias("position"), "spotify_track_id", "title", "artist_names", "album", "label", "release_year", "duration", "spotify_uri", "spotify_url", "whosampled_url", "whosampled_title", "whosampled_match_status", "spotify_duration_ms")
    return O.first_wins(part, ["recording_id"], "position")


_OWNER = f", f AS (SELECT recording_id, row_id, {c('spotify_track_id')} AS track FROM recordings WHERE {c('recording_id')} <> '' QUALIFY row_number() OVER (PARTITION BY recording_id ORDER BY row_id) = 1), o AS (SELECT track, arg_max({c('recording_id')}, row_id) AS canonical_id FROM f WHERE track <> '' GROUP BY 1)"


def _flow(p, t, r):
    best = _best(p, t)
    catalog = best.select(F.col("source_id").alias("recording_id"), F.col("source_id").alias("position"), F.when(F.col("decision") == "open", "matched").otherwise("pending").alias("spotify_match_status"),
                          F.col("other").alias("spotify_track_id"), F.lit("").alias("canonical_recording_id"), F.col("score").cast("string").alias("spotify_match_score"), F.lit("").alias("whosampled_title"), F.lit("").alias("whosampled_artist_names"), F.lit("").alias("whosampled_release_year"))
    titles = p.where(O.key("recording_id").isNotNull()).groupBy(O.key("recording_id").alias("recording_id")).agg(F.min(clean(F.col("whosampled_title"))).alias("_t"), F.min(clean(F.col("whosampled_url"))).alias("whosampled_url"))
    catalog = catalog.join(titles, "recording_id").withColumn("whosampled_title", F.col("_t")).drop("_t")
    reviews = best.select(F.col("decision"), F.col("source_id").alias("recording_id"), F.col("other").alias("spotify_track_id"), F.col("score").cast("string").alias("match_score"), F.col("source_id").alias("position"))
    return R.reconcile_recordings(_recordings(r), catalog, reviews, t, F.lit(AS_OF))


@query("artist_catalog_recordings_parsed", "spotify_tracks", "recordings", sql=_BEST + _OWNER + """, a AS (SELECT source_id AS provisional_id, canonical_id, 'accepted_reconciled' AS status FROM b JOIN o ON o.track = b.other WHERE decision = 'accepted'),
w AS (SELECT * FROM b WHERE decision = 'open'), n AS (SELECT source_id AS provisional_id, canonical_id, 'matched_reconciled_existing' AS status FROM w JOIN o ON o.track = w.other),
x AS (SELECT w.*, min(source_id) OVER (PARTITION BY other) AS first FROM w WHERE other NOT IN (SELECT track FROM o))
SELECT * FROM a UNION ALL SELECT * FROM n UNION ALL SELECT source_id, first, CASE WHEN source_id = first THEN 'matched_promoted' ELSE 'matched_reconciled_existing' END FROM x""")
def reconcile_recordings(p, t, r):
    """Where every catalogue recording with a decision goes: an existing recording, or one that it becomes."""
    return _flow(p, t, r)["mappings"]


@query("artist_catalog_recordings_parsed", "spotify_tracks", "recordings", sql=_BEST + _OWNER + f""", u AS (SELECT {c('recording_id')} AS source_id, min({c('whosampled_title')}) AS wt, min({c('whosampled_url')}) AS wu FROM artist_catalog_recordings_parsed WHERE {c('recording_id')} <> '' GROUP BY 1),
g AS (SELECT canonical_id, arg_max(wt, CASE WHEN wt <> '' THEN b.source_id END) AS wt, arg_max(wu, CASE WHEN wu <> '' THEN b.source_id END) AS wu, max(b.source_id) AS src FROM b JOIN o ON o.track = b.other JOIN u USING (source_id) WHERE decision = 'accepted' GROUP BY 1),
w AS (SELECT * FROM b WHERE decision = 'open' AND other NOT IN (SELECT track FROM o)), x AS (SELECT DISTINCT min(source_id) OVER (PARTITION BY other) AS source_id, other FROM w),
rr AS (SELECT recording_id, coalesce(whosampled_title, '') AS wt, coalesce(whosampled_url, '') AS wu FROM recordings WHERE {c('recording_id')} <> '' QUALIFY row_number() OVER (PARTITION BY recording_id ORDER BY row_id) = 1)
SELECT rr.recording_id, CASE WHEN g.canonical_id IS NULL THEN '' ELSE 'accepted_reconciled' END AS status, CASE WHEN g.canonical_id IS NULL THEN rr.wt ELSE coalesce(nullif(g.wt, ''), {c('rr.wt')}) END AS whosampled_title,
 CASE WHEN g.canonical_id IS NULL THEN rr.wu ELSE coalesce(nullif(g.wu, ''), {c('rr.wu')}) END AS whosampled_url, coalesce(g.src, '') AS provisional_id FROM rr LEFT JOIN g ON g.canonical_id = {c('rr.recording_id')}
UNION ALL SELECT source_id, 'matched_promoted', u.wt, u.wu, source_id FROM x JOIN u USING (source_id)""")
def reconciled_recordings(p, t, r):
    """All recordings after the reconciliation, with what they gained and the promoted ones."""
    out = _flow(p, t, r)["recordings"]
    gained = F.col("catalog_reconciliation_status") == "accepted_reconciled"
    text = lambda x: F.coalesce(F.when(gained, clean(F.col(x))).otherwise(F.col(x)), F.lit(""))
    blank = lambda x, n: F.coalesce(F.col(x), F.lit("")).alias(n)
    return out.select("recording_id", blank("catalog_reconciliation_status", "status"), text("whosampled_title").alias("whosampled_title"), text("whosampled_url").alias("whosampled_url"), blank("catalog_provisional_recording_id", "provisional_id"))


@query("artist_catalog_recordings_parsed", "spotify_tracks", sql=_BEST + """, k AS (SELECT source_id, other, score, row_number() OVER (PARTITION BY source_id ORDER BY score DESC, other) AS rank FROM e WHERE score >= 0.45), m AS (SELECT k.source_id, k.other, k.score, b.decision, b.other AS chosen FROM k LEFT JOIN b USING (source_id) WHERE rank <= 5)
SELECT 'PROP_' || substr(sha256(concat_ws('|', source_id, 'spotify', other)), 1, 16) AS proposal_id, source_id AS canonical_recording_id, other AS candidate_identity,
CASE WHEN decision = 'accepted' AND other = chosen THEN 'accepted' WHEN decision = 'accepted' THEN 'rejected' WHEN decision = 'rejected' AND other = chosen THEN 'rejected' ELSE 'pending' END AS status, '2026-01-01T00:00:00+00:00' AS discovered_at FROM m""")
def identity_proposals(p, t):
    """Durable proposals from the ranked candidates and the decisions on them."""
    kept = S.ranked(_candidates(p, t), "source_id", "score", "other").join(_best(p, t).select("source_id", "decision", F.col("other").alias("chosen")), "source_id", "left")
    new = kept.select(F.col("source_id").alias("canonical_recording_id"), F.lit("whosampled").alias("source_system"), F.col("source_id").alias("source_identity"), F.lit("spotify").alias("candidate_system"), F.col("other").alias("candidate_identity"),
                      F.col("score").cast("string").alias("confidence_score"), F.to_json(F.struct("rank", "score")).alias("evidence"), V.proposal_status(F.col("decision"), F.col("chosen"), F.col("other"), F.lit("")).alias("status"),
                      *[F.lit("").alias(x) for x in ("source_title", "source_artist_names", "candidate_title", "candidate_artist_names", "candidate_url")])
    columns = ["proposal_id", *V.PROPOSAL, "discovered_at", "updated_at", "reviewed_at", "review_source"]
    none = new.sparkSession.createDataFrame([], ", ".join(f"{x} string" for x in columns))
    return V.upsert_proposals(none, new, F.lit(AS_OF)).select("proposal_id", "canonical_recording_id", "candidate_identity", "status", "discovered_at")


@query("artist_catalog_recordings_parsed", "spotify_tracks", sql=_BEST + """ SELECT e.source_id, e.other, coalesce(CASE WHEN b.decision IN ('accepted', 'rejected') THEN b.decision END, '') AS decision,
CASE WHEN b.decision IN ('accepted', 'rejected') AND b.other = e.other THEN 'true' ELSE '' END AS selected FROM e LEFT JOIN b USING (source_id)""")
def selected_candidates(p, t):
    """Candidates with the decision of their recording and a mark at the chosen one; open decisions leave no trace."""
    rows = _candidates(p, t).select(F.col("source_id").alias("recording_id"), F.lit("").alias("whosampled_url"), F.col("other").alias("spotify_track_id"))
    reviews = _best(p, t).select(F.col("source_id").alias("recording_id"), F.lit("").alias("whosampled_url"), "decision", F.lit(AS_OF).alias("reviewed_at"), F.col("other").alias("spotify_track_id"))
    out = V.flag_selected(rows, reviews)
    return out.select(F.col("recording_id").alias("source_id"), F.col("spotify_track_id").alias("other"), F.col("spotify_review_decision").alias("decision"), F.col("spotify_selected_candidate").alias("selected"))


@query("artist_catalog_recordings_parsed", "spotify_tracks", "recordings", sql=_BEST + f""", s AS (SELECT DISTINCT {c('spotify_track_id')} AS track FROM recordings WHERE lower({c('whosampled_match_status')}) IN ('unresolved', 'not_found', 'artist_profile_only', 'unmatched', 'review') AND {c('spotify_track_id')} <> ''),
d AS (SELECT coalesce(CASE WHEN b.decision <> 'open' THEN b.decision END, 'open') AS decision, count(*) AS n FROM c LEFT JOIN b USING (source_id) GROUP BY 1)
SELECT 'decision_' || decision AS what, n FROM d UNION ALL SELECT 'open_pool', count(*) FROM spotify_tracks WHERE {c('spotify_track_id')} IN (SELECT track FROM s)
UNION ALL SELECT 'undecided', count(*) FROM c WHERE source_id NOT IN (SELECT source_id FROM b WHERE decision <> 'open')""")
def review_progress(p, t, r):
    """Rows by decision, entries whose match is open, and recordings without a decision."""
    best = _best(p, t).select(F.col("source_id").alias("recording_id"), "decision")
    rows = p.where(O.key("recording_id").isNotNull()).select(O.key("recording_id").alias("recording_id")).distinct()
    count = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("what"), "n")
    return O.union_all([V.decision_counts(rows, best, "recording_id").select(F.concat(F.lit("decision_"), "decision").alias("what"), "n"),
                        count(V.open_pool(t, r, "whosampled_match_status"), "open_pool"), count(V.undecided(rows, best, "recording_id"), "undecided")])


@query("artist_catalog_recordings_parsed", "spotify_tracks")
def catalog_candidates(p, t):
    """Catalogue recordings against all tracks, scored by sequence ratios; see ``score_candidates`` for the blocks."""
    return R.score_candidates(p, t).select("recording_id", "spotify_track_id", "candidate_rank", F.round("title_score", 6).alias("title_score"), F.round("artist_score", 6).alias("artist_score"), "duration_score", "year_score",
                                           F.round("album_score", 6).alias("album_score"), F.round("match_score", 6).alias("match_score"), "candidate_status")


# ---- artists of credits

_F = lambda x: f"trim(regexp_replace(regexp_replace(replace(lower(strip_accents({c(x)})), '&', ' and '), '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"
_PAGE = lambda x: f"CASE WHEN {c(x)} = '' THEN '' ELSE 'https://pages.example/' || replace({c(x)}, ' ', '-') || '/' END"
_KEY = lambda x: f"lower(regexp_replace({c(x)}, '/+$', ''))"

_LADDER = f"""WITH a AS (SELECT {c('artist_id')} AS id, min({c('canonical_name')}) AS name, min({c('spotify_artist_id')}) AS sid, min({c('whosampled_url')}) AS wurl, min({c('whosampled_name')}) AS wname FROM artists WHERE {c('artist_id')} <> '' GROUP BY 1),
k AS (SELECT *, {_F('name')} AS fold, {_KEY('wurl')} AS url FROM a),
bs AS (SELECT sid AS k, min(id) AS lo, max(id) AS hi, arg_min(name, id) AS name FROM k WHERE sid <> '' GROUP BY 1), bn AS (SELECT fold AS k, min(id) AS lo, max(id) AS hi, arg_min(name, id) AS name FROM k WHERE fold <> '' GROUP BY 1),
bu AS (SELECT url AS k, min(id) AS lo, max(id) AS hi, arg_min(name, id) AS name FROM k WHERE url <> '' GROUP BY 1),
rv AS (SELECT sid AS rsid, {_F('wname')} AS rfold, url AS rurl, trim(replace(coalesce(list_filter(string_split(regexp_replace(wurl, '^[a-z]+://[^/]+', ''), '/'), lambda x: x <> '')[1], ''), '-', ' ')) AS slug FROM k WHERE wname <> ''),
br AS (SELECT rurl, rfold, {_F('slug')} AS rslug, coalesce(bs.lo, CASE WHEN bn.lo = bn.hi THEN bn.lo END) AS id, CASE WHEN bs.lo IS NOT NULL THEN bs.name ELSE bn.name END AS name FROM rv LEFT JOIN bs ON bs.k = rsid LEFT JOIN bn ON bn.k = rfold),
bd AS (SELECT * FROM br WHERE id IS NOT NULL),
ru AS (SELECT rurl AS k, min(id) AS lo, max(id) AS hi, arg_min(name, id) AS name FROM bd WHERE rurl <> '' GROUP BY 1),
ra AS (SELECT k, min(id) AS lo, max(id) AS hi, arg_min(name, id) AS name FROM (SELECT rfold AS k, id, name FROM bd UNION ALL SELECT rslug, id, name FROM bd) WHERE k <> '' GROUP BY 1),
x AS (SELECT credit_id AS position, min({c('recording_id')}) AS rec, min({c('artist_id')}) AS aid, min({c('artist_name')}) AS nm, min({c('role')}) AS role, min({c('source_url')}) AS src FROM credits GROUP BY 1),
y AS (SELECT *, {_F('nm')} AS fold, {_KEY(f"({_PAGE('nm')})")} AS url, {_PAGE('nm')} AS page FROM x WHERE rec <> ''),
z AS (SELECT y.*, CASE WHEN ru.lo IS NOT NULL THEN 0 WHEN ra.lo IS NOT NULL THEN 1 WHEN bu.lo IS NOT NULL THEN 2 WHEN bn.lo IS NOT NULL THEN 3 ELSE 4 END AS rung, coalesce(ru.lo, ra.lo, bu.lo, bn.lo) AS lo, coalesce(ru.hi, ra.hi, bu.hi, bn.hi) AS hi
 FROM y LEFT JOIN ru ON ru.k = nullif(y.url, '') LEFT JOIN ra ON ra.k = nullif(y.fold, '') LEFT JOIN bu ON bu.k = nullif(y.url, '') LEFT JOIN bn ON bn.k = nullif(y.fold, '')),
sr AS (SELECT aid, min(fold) AS sfold, min(url) AS surl FROM y WHERE aid <> '' GROUP BY 1),
op AS (SELECT * FROM z WHERE rung = 4),
sf AS (SELECT op.*, k.id AS known FROM op JOIN sr USING (aid) LEFT JOIN k ON k.id = op.aid WHERE starts_with(aid, 'ART_') AND nm <> '' AND op.url <> '' AND (sfold = '' OR sfold = op.fold) AND (surl = '' OR surl = op.url)),
p1 AS (SELECT * FROM sf WHERE known IS NULL QUALIFY row_number() OVER (PARTITION BY url ORDER BY position) = 1), pr AS (SELECT * FROM p1 QUALIFY row_number() OVER (PARTITION BY aid ORDER BY position) = 1),
nf AS (SELECT fold, min(aid) AS pid, max(position) AS at FROM pr WHERE fold <> '' GROUP BY 1 HAVING min(aid) = max(aid)),
lt AS (SELECT position, known AS pid, 'catalog_only_existing_canonical' AS m, 2 AS o FROM sf WHERE known IS NOT NULL UNION ALL SELECT position, aid, 'catalog_only_canonical', 2 FROM pr
 UNION ALL SELECT op.position, pr.aid, 'exact_canonical_whosampled_url', 0 FROM op JOIN pr USING (url) WHERE op.position > pr.position UNION ALL SELECT op.position, nf.pid, 'exact_canonical_name', 1 FROM op JOIN nf USING (fold) WHERE op.position > nf.at),
lo AS (SELECT position, arg_min(pid, o) AS pid, arg_min(m, o) AS m FROM lt GROUP BY 1),
res AS (SELECT z.position, z.aid, z.nm, z.page, z.role, z.rec, z.src, CASE WHEN lo.pid IS NOT NULL THEN 'resolved' WHEN rung = 4 THEN 'unresolved' WHEN z.lo <> hi THEN 'ambiguous' ELSE 'resolved' END AS status, coalesce(lo.pid, CASE WHEN rung < 4 AND z.lo = hi THEN z.lo ELSE '' END) AS artist,
 coalesce(lo.m, CASE WHEN rung = 4 THEN '' WHEN z.lo <> hi THEN ['accepted_review_url_conflict', 'accepted_review_alias_conflict', 'exact_url_conflict', 'exact_name_conflict'][rung + 1] ELSE ['accepted_artist_review_whosampled_url', 'accepted_artist_review_alias', 'exact_canonical_whosampled_url', 'exact_canonical_name'][rung + 1] END) AS method FROM z LEFT JOIN lo USING (position)) """


def _artists(a):
    g = lambda x: F.min(clean(F.col(x))).alias(x)
    return a.where(O.key("artist_id").isNotNull()).groupBy(O.key("artist_id").alias("artist_id")).agg(*[g(x) for x in ("canonical_name", "spotify_artist_id", "whosampled_url", "whosampled_name")])


def _page(x):
    return F.when(clean(F.col(x)) == "", "").otherwise(F.concat(F.lit("https://pages.example/"), F.replace(clean(F.col(x)), F.lit(" "), F.lit("-")), F.lit("/")))


def _credit_flow(cr, a):
    one = _artists(a)
    rows = cr.groupBy(F.col("credit_id").alias("position")).agg(*[F.min(clean(F.col(x))).alias(n) for x, n in (("recording_id", "canonical_recording_id"), ("artist_id", "artist_id"), ("artist_name", "artist_name"), ("role", "role"), ("source_url", "source_url"))])
    rows = rows.withColumn("artist_whosampled_url", _page("artist_name"))
    reviews = one.where("whosampled_name <> ''").select(F.lit("accepted").alias("decision"), "spotify_artist_id", F.col("whosampled_name").alias("spotify_artist_name"), F.col("whosampled_url").alias("whosampled_artist_url"))
    keyed = rows.where("canonical_recording_id <> '' and artist_id <> ''").withColumns({"f": fold_ascii_udf("artist_name"), "u": K.url_key_plain(F.col("artist_whosampled_url"))})
    searches = keyed.groupBy(F.col("artist_id").alias("provisional_artist_id")).agg(F.lit("no_results").alias("status"), F.min("f").alias("artist_name"), F.min("u").alias("whosampled_url"))
    return R.reconcile_credits(rows, one, reviews, searches)


@query("credits", "artists", sql=_LADDER + "SELECT position AS credit_id, status, artist AS canonical_artist_id, method FROM res")
def reconcile_credits(cr, a):
    """Every credit of a recording with its artist, by the whole ladder with promotion."""
    out = _credit_flow(cr, a)["credits"]
    return out.select(F.col("position").alias("credit_id"), F.col("artist_reconciliation_status").alias("status"), "canonical_artist_id", F.col("artist_reconciliation_method").alias("method"))


@query("credits", "artists", sql=_LADDER + "SELECT aid AS artist_id, nm AS canonical_name, page AS whosampled_url FROM pr")
def promoted_artists(cr, a):
    return _credit_flow(cr, a)["artists"]


@query("credits", "artists", "relationships", sql=_LADDER + f""", rl AS (SELECT 'ART_' || substr(sha1('whosampled-name:' || {c('related_artist')}), 1, 16) AS pid, {c('related_artist')} AS nm, {_PAGE('related_artist')} AS page, {c('relationship_type')} AS typ, {c('source_recording_id')} AS rec, {c('whosampled_relationship_url')} AS src, relationship_id AS pos FROM relationships WHERE {c('related_artist')} <> ''),
al AS (SELECT pid, nm, page, typ, rec, src, 0 AS o, pos FROM rl UNION ALL SELECT aid, nm, page, role, rec, src, 1, position FROM res WHERE status = 'unresolved' AND page <> '' AND aid <> '' AND nm <> '')
SELECT pid AS provisional_artist_id, arg_min(nm, (o, pos)) AS artist_name, arg_min(typ, (o, pos)) AS evidence_type, rec AS evidence_recording_id FROM al GROUP BY pid, {_KEY('page')}, lower(typ), rec""")
def identity_candidates(cr, a, rel):
    related = rel.where(clean(F.col("related_artist")) != "").select(
        F.col("relationship_id").alias("position"), K.stable_id("ART_", "whosampled-name", clean(F.col("related_artist"))).alias("provisional_artist_id"), F.col("related_artist").alias("artist_name"), _page("related_artist").alias("whosampled_url"),
        F.col("relationship_type").alias("evidence_type"), F.col("source_recording_id").alias("evidence_recording_id"), F.col("whosampled_relationship_url").alias("evidence_recording_url"))
    return R.identity_candidates(related, _credit_flow(cr, a)["credits"]).select("provisional_artist_id", "artist_name", "evidence_type", "evidence_recording_id")


# ---- canonical credits

_NUM = "CAST(artist_order AS int)"
_ROLES = "(VALUES ('track artist', 'performer', ''), ('Producer', 'producer', ''), ('Composer', 'composer', ''), ('Composers', 'composer', ''), ('Lyricist', 'lyricist', ''), ('Writer', 'writer', ''), ('Guest Vocals', 'performer', 'guest_vocals')) AS m(source_role, role, function)"
_PARTS = f"""WITH d AS (SELECT DISTINCT credit_id, {c('recording_id')} AS rec, {c('artist_id')} AS art, {c('artist_name')} AS nm, {c('role')} AS orole, {c('source_role')} AS srole, {c('source')} AS source, {c('source_url')} AS surl, {_NUM} AS ord FROM credits),
old AS (SELECT 0 AS o, credit_id AS pos, rec, art, CASE orole WHEN 'produced_by' THEN 'producer' ELSE orole END AS role, '' AS fn, nm, ord, srole, source, surl FROM d WHERE source <> 'whosampled_catalog' AND rec <> '' AND art <> '' AND orole <> ''),
nw AS (SELECT 1 AS o, credit_id AS pos, rec, art, m.role, m.function AS fn, nm, ord, srole, source, surl FROM d LEFT JOIN {_ROLES} ON m.source_role = d.srole WHERE source = 'whosampled_catalog' AND rec <> '' AND art <> ''),
al AS (SELECT * FROM old UNION ALL SELECT * FROM nw WHERE role IS NOT NULL) """


def _halves(cr):
    d = cr.select(F.col("credit_id").alias("position"), *[c for c in ("recording_id", "artist_id", "artist_name", "role", "source_role", "source", "source_url", "artist_order")]).distinct()
    old = d.where(clean(F.col("source")) != "whosampled_catalog")
    new = d.where(clean(F.col("source")) == "whosampled_catalog").withColumns({"canonical_recording_id": F.col("recording_id"), "canonical_artist_id": F.col("artist_id"), "canonical_artist_name": F.lit("")})
    return old, new


@query("credits", "artists", sql=_PARTS + f""", nn AS (SELECT {c('artist_id')} AS art, max({c('canonical_name')}) AS name FROM artists WHERE {c('artist_id')} <> '' GROUP BY 1)
SELECT 'CRD_' || substr(sha1(concat_ws('|', rec, al.art, role)), 1, 16) AS credit_id, rec AS recording_id, al.art AS artist_id, role, CASE WHEN max(fn) <> '' THEN '["' || max(fn) || '"]' ELSE '' END AS function, min(ord) AS artist_order,
coalesce(nullif(any_value(nn.name), ''), arg_min(nm, CASE WHEN nm <> '' THEN (o, pos) END), '') AS artist_name FROM al LEFT JOIN nn ON nn.art = al.art GROUP BY rec, al.art, role""")
def credits_migrated(cr, a):
    """Canonical credits from the assertions of both sources."""
    return R.migrate_credits(*_halves(cr), a)["credits"]


@query("credits", "artists", sql=_PARTS + """, g AS (SELECT 'CRD_' || substr(sha1(concat_ws('|', rec, art, role)), 1, 16) AS cid, * FROM al), e AS (SELECT 'CRDE_' || substr(sha1(concat_ws('|', cid, srole, source, surl)), 1, 16) AS eid FROM g)
SELECT 'unmapped_role' AS check_name, count(*) AS n FROM nw WHERE role IS NULL HAVING count(*) > 0 UNION ALL SELECT 'order_conflict', count(*) FROM (SELECT cid FROM g GROUP BY cid HAVING count(DISTINCT ord) > 1) HAVING count(*) > 0
UNION ALL SELECT 'repeated_evidence', count(*) FROM (SELECT eid FROM e GROUP BY eid HAVING count(*) > 1) HAVING count(*) > 0
UNION ALL SELECT 'credit_without_key', count(*) FROM d WHERE source <> 'whosampled_catalog' AND (rec = '' OR art = '' OR orole = '') HAVING count(*) > 0""")
def credit_migration_issues(cr, a):
    """What keeps the migration from being written, by check."""
    return R.migrate_credits(*_halves(cr), a)["issues"].groupBy("check_name").agg(F.count("*").alias("n"))


def _materialized(cr):
    old, new = _halves(cr)
    keyed = old.where((clean(F.col("recording_id")) != "") & (clean(F.col("artist_id")) != "")).select(clean(F.col("recording_id")).alias("recording_id"), clean(F.col("artist_id")).alias("artist_id"), clean(F.col("role")).alias("role"), "position", "artist_name", "artist_order", "source_role", "source", "source_url")
    cid = K.parts_id("CRD", F.col("recording_id"), F.col("artist_id"), F.col("role"))
    credits = keyed.groupBy("recording_id", "artist_id", "role").agg(F.min_by(clean(F.col("artist_name")), "position").alias("artist_name"), F.min("artist_order").cast("string").alias("artist_order")).withColumn("credit_id", cid).withColumn("function", F.lit(""))
    parts = keyed.withColumn("credit_id", cid).select("credit_id", *[clean(F.col(x)).alias(x) for x in ("source_role", "source", "source_url")]).distinct()
    evidence = parts.withColumn("credit_evidence_id", K.parts_id("CRDE", *[F.col(x) for x in ("credit_id", "source_role", "source", "source_url")]))
    return R.materialize_credits(credits, evidence, new)


@query("credits", sql=_PARTS + """, h AS (SELECT 'CRD_' || substr(sha1(concat_ws('|', rec, art, orole)), 1, 16) AS cid, rec, art, orole AS role, min(ord) AS ord FROM d WHERE source <> 'whosampled_catalog' AND rec <> '' AND art <> '' GROUP BY rec, art, orole),
g AS (SELECT nw.*, coalesce(h.cid, 'CRD_' || substr(sha1(concat_ws('|', nw.rec, nw.art, nw.role)), 1, 16)) AS cid, h.cid AS have FROM nw LEFT JOIN h ON h.rec = nw.rec AND h.art = nw.art AND h.role = nw.role WHERE nw.role IS NOT NULL),
fn AS (SELECT cid, max(fn) AS f FROM g GROUP BY 1)
SELECT h.cid AS credit_id, h.rec AS recording_id, h.art AS artist_id, h.role, CASE WHEN fn.f <> '' THEN '["' || fn.f || '"]' ELSE '' END AS function, CAST(h.ord AS varchar) AS artist_order FROM h LEFT JOIN fn USING (cid)
UNION ALL SELECT cid, rec, art, role, CASE WHEN max(fn) <> '' THEN '["' || max(fn) || '"]' ELSE '' END, CAST(arg_min_null(ord, pos) AS varchar) FROM g WHERE have IS NULL GROUP BY cid, rec, art, role""")
def credits_materialized(cr):
    """Canonical credits after the catalogue's assertions were added to them."""
    return _materialized(cr)["credits"].select("credit_id", "recording_id", "artist_id", "role", "function", "artist_order")


# ---- library

_LIB = {
    "recordings": ("recordings", "recording_id", ["title", "album", "label", "release_year"], "row_id"), "artists": ("artists", "artist_id", ["canonical_name", "whosampled_url"], "loaded_at, canonical_name"),
    "credits": ("credits", "credit_id", ["recording_id", "artist_id", "role"], "loaded_at"), "relationships": ("relationships", "relationship_id", ["source_recording_id", "target_recording_id"], "loaded_at"),
}


def _sides(frames):
    """Of every id the earliest row as the library's and the latest as the proposed one."""
    out = ({}, {})
    for name, (_, ident, columns, order) in _LIB.items():
        rows = frames[name].where(F.coalesce(ident, F.lit("")) != "")
        at = F.struct(*[F.col(o.strip()) for o in order.split(",")])
        row = F.struct(*[F.coalesce(F.col(x).cast("string"), F.lit("")).alias(x) for x in columns])
        both = rows.groupBy(ident).agg(F.min_by(row, F.struct(at, row)).alias("a"), F.max_by(row, F.struct(at, row)).alias("b"))
        for side, x in zip(out, "ab"):
            side[name] = both.select(ident, f"{x}.*")
    for side in out:
        side["credit_evidence"] = side["credits"].select(F.concat(F.lit("E"), "credit_id").alias("credit_evidence_id"), "credit_id")
    return out


def _sql_sides(name: str) -> str:
    t, ident, columns, order = _LIB[name]
    row = "struct_pack(" + ", ".join(f"{x} := coalesce(CAST({x} AS varchar), '')" for x in columns) + ")"
    at = f"struct_pack({', '.join(f'k{i} := {o.strip()}' for i, o in enumerate(order.split(',')))}, r := {row})"
    return f"s_{name} AS (SELECT {ident} AS id, arg_min({row}, {at}) AS l, arg_max({row}, {at}) AS p FROM {t} WHERE coalesce({ident}, '') <> '' GROUP BY 1)"


_LIBRARY = "WITH " + ", ".join(map(_sql_sides, _LIB))
_MERGED = lambda x: f"coalesce(nullif({c('l.' + x)}, ''), {c('p.' + x)})"


@query("recordings", "artists", "credits", "relationships", sql=_LIBRARY + ", e AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, CASE WHEN {c('l.' + x)} = {c('p.' + x)} THEN 'identical' WHEN {c('l.' + x)} = '' THEN 'enriched' WHEN {c('p.' + x)} = '' THEN 'preserved' ELSE 'conflict' END AS outcome FROM s_{n}" for n, v in _LIB.items() for x in v[2])
    + " UNION ALL SELECT 'credit_evidence', 'identical' FROM s_credits) SELECT table_name, outcome, count(*) AS n_cells FROM e GROUP BY 1, 2")
def library_merge_stats(r, a, cr, rel):
    """Cells of the five library tables by what the merge did with them."""
    library, proposed = _sides({"recordings": r, "artists": a, "credits": cr, "relationships": rel})
    return R.merge_library(proposed, library)["stats"]


@query("recordings", "artists", "credits", "relationships", sql=_LIBRARY + f""", cc AS (SELECT {_MERGED('recording_id')} AS rec, {_MERGED('artist_id')} AS art FROM s_credits), rr AS (SELECT {_MERGED('source_recording_id')} AS s, {_MERGED('target_recording_id')} AS t FROM s_relationships)
SELECT 'credit_recording' AS check_name, count(*) AS n_rows FROM cc WHERE rec NOT IN (SELECT id FROM s_recordings) UNION ALL SELECT 'credit_artist', count(*) FROM cc WHERE art <> '' AND art NOT IN (SELECT id FROM s_artists)
UNION ALL SELECT 'evidence_credit', 0 UNION ALL SELECT 'relationship_source', count(*) FROM rr WHERE s <> '' AND s NOT IN (SELECT id FROM s_recordings) UNION ALL SELECT 'relationship_target', count(*) FROM rr WHERE t <> '' AND t NOT IN (SELECT id FROM s_recordings)""")
def library_key_errors(r, a, cr, rel):
    """The five key rules on the merged library."""
    library, proposed = _sides({"recordings": r, "artists": a, "credits": cr, "relationships": rel})
    merged = R.merge_library(proposed, library)
    return R.library_errors({k: merged[k] for k in R.LIBRARY})


@query("spotify_tracks", "recordings", sql=f"""WITH k AS (SELECT DISTINCT {c('spotify_track_id')} AS t, {c('recording_id')} AS rec FROM recordings WHERE {c('spotify_track_id')} <> ''), m AS (SELECT DISTINCT rec FROM spotify_tracks s JOIN k ON k.t = {c('s.spotify_track_id')}),
p AS (SELECT max({c('playlist_id')}) AS src FROM spotify_tracks)
SELECT 'LIB_' || substr(sha1('CONTRIB_1|' || rec), 1, 16) AS library_membership_id, rec AS recording_id, 'bulk_import' AS added_via, src AS import_source_id FROM m, p""")
def membership_import(t, r):
    """Memberships that an import of all playlists would add for one contributor."""
    none = t.sparkSession.createDataFrame([], "library_membership_id string, contributor_id string, recording_id string, added_via string, import_source_type string, import_source_id string, added_at string")
    return R.memberships(t, r, none, "CONTRIB_1")["new"].select("library_membership_id", "recording_id", "added_via", "import_source_id")


# ---- relationships and their pages

@query("relationships", "recordings", sql=f"""WITH k AS (SELECT {c('recording_id')} AS id, max({c('whosampled_url')}) AS u FROM recordings WHERE {c('recording_id')} <> '' GROUP BY 1),
x AS (SELECT DISTINCT relationship_id, coalesce(s.u, '') AS a, coalesce(t.u, '') AS b FROM relationships r LEFT JOIN k s ON s.id = {c('r.source_recording_id')} LEFT JOIN k t ON t.id = {c('r.target_recording_id')})
SELECT relationship_id, CASE WHEN a = '' THEN 'source without address' WHEN b = '' THEN 'track without address' WHEN regexp_replace(a, '/+$', '') = regexp_replace(b, '/+$', '') THEN 'both tracks fit' END AS error,
CASE WHEN a <> '' AND b <> '' AND regexp_replace(a, '/+$', '') <> regexp_replace(b, '/+$', '') THEN 'track_1_primary' END AS orientation FROM x""")
def relationship_orientation(rel, r):
    """Which side of a relationship is its source, by the addresses of both recordings."""
    k = r.where(O.key("recording_id").isNotNull()).groupBy(O.key("recording_id").alias("id")).agg(F.max(clean(F.col("whosampled_url"))).alias("u"))
    rows = rel.select("relationship_id", O.key("source_recording_id").alias("s"), O.key("target_recording_id").alias("t")).distinct()
    rows = rows.join(k.toDF("s", "track_1_url"), "s", "left").join(k.toDF("t", "track_2_url"), "t", "left").withColumn("source_url", F.col("track_1_url"))
    return R.orient(rows).select("relationship_id", "error", "orientation").distinct()


@query("relationships", sql=f"""WITH x AS (SELECT relationship_id AS pos, {c('related_track')} AS t, {c('related_artist')} AS a FROM relationships WHERE {c('related_track')} <> '' AND {c('related_artist')} <> '')
SELECT count(*) AS n_targets, CAST(sum(n) AS bigint) AS n_relationships FROM (SELECT lower(t) AS t, lower(a) AS a, count(*) AS n FROM x GROUP BY 1, 2)""")
def relationship_target_counts(rel):
    """Distinct targets of relationships by title and artist in lower case."""
    rows = rel.where((clean(F.col("related_track")) != "") & (clean(F.col("related_artist")) != "")).groupBy(F.lower(clean(F.col("related_track"))).alias("t"), F.lower(clean(F.col("related_artist"))).alias("a")).agg(F.count("*").alias("n"))
    return rows.agg(F.count("*").alias("n_targets"), F.sum("n").alias("n_relationships"))


@query("relationships")
def relationship_targets(rel):
    return R.targets(rel.withColumn("position", F.col("relationship_id")))


@query("relationships", "recordings")
def resolved_targets(rel, r):
    """Targets of relationships verified against the pages of recordings."""
    pages = r.where(clean(F.col("whosampled_url")) != "").select(F.col("whosampled_title").alias("title"), F.split(F.coalesce("whosampled_artist_names", F.lit("")), r"\s*,\s*").alias("artist_names"), F.col("whosampled_url").alias("canonical_url")).distinct()
    return R.resolve_targets(R.targets(rel.withColumn("position", F.col("relationship_id"))), pages)


@query("relationships", "recordings", sql=f"""WITH ids AS (SELECT DISTINCT {c('recording_id')} AS id FROM recordings WHERE {c('recording_id')} <> ''), q AS (SELECT relationship_id, {c('source_recording_id')} AS s, CASE WHEN {c('whosampled_relationship_url')} = '' THEN '' ELSE regexp_replace({c('whosampled_relationship_url')}, '/+$', '') || '/' END AS u, {c('target_recording_id')} AS t FROM relationships)
SELECT DISTINCT relationship_id FROM q WHERE t = '' AND u <> '' AND s IN (SELECT id FROM ids) AND u NOT IN (SELECT u FROM q WHERE t <> '')""")
def eligible_details(rel, r):
    """Relationships without target whose source is canonical and whose address is not an edge already."""
    queue = rel.where(clean(F.col("target_recording_id")) == "").withColumn("canonical_source_recording_id", F.col("source_recording_id"))
    return V.eligible_queue(queue, r, rel.where(clean(F.col("target_recording_id")) != "")).select("relationship_id").distinct()


@query("relationships", sql=f"""WITH u AS (SELECT DISTINCT regexp_replace({c('whosampled_relationship_url')}, '/+$', '') || '/' AS u FROM relationships WHERE {c('whosampled_relationship_url')} <> ''),
k AS (SELECT u, regexp_extract(u, '/(sample|cover|remix|interpolation)s?/(\\d+)', 1) AS kind, regexp_extract(u, '/(sample|cover|remix|interpolation)s?/(\\d+)', 2) AS num FROM u)
SELECT u AS url, CASE kind WHEN 'sample' THEN 'sampled' WHEN 'cover' THEN 'covers' WHEN 'remix' THEN 'remix' ELSE 'interpolates' END AS relationship_type, num AS relationship_id, 'relationship_detail_' || kind || '_' || num || '.html' AS archive_name FROM k WHERE num <> ''""")
def bridge_manifest(rel):
    """The manifest of relationship pages: one row per address with type, number and file name."""
    u = K.url_slash(F.col("whosampled_relationship_url"))
    rows = rel.select(u.alias("url")).where("url <> ''").distinct()
    identity = K.relation_identity(F.col("url"))
    return rows.where(identity["number"] != "").select("url", K.relation_type(F.col("url"), 1).alias("relationship_type"), identity["number"].alias("relationship_id"), P.detail_archive_name(F.col("url")).alias("archive_name"))


# ---- seeding, review candidates, caches

_PAIRS = f"""WITH t AS (SELECT *, {c('spotify_track_id')} AS track, 'REC_' || substr(sha1('spotify:' || {c('spotify_track_id')}), 1, 16) AS rec FROM spotify_tracks WHERE {c('spotify_track_id')} <> ''),
m AS (SELECT {c('spotify_track_id')} AS track, arg_max({c('whosampled_url')}, row_id) AS u, arg_max({c('whosampled_match_status')}, row_id) AS st FROM recordings WHERE {c('spotify_track_id')} <> '' GROUP BY 1),
l AS (SELECT rec, entry_id, {c('spotify_url')} AS src, CASE WHEN artists_json LIKE '[%' THEN artists_json ELSE '[]' END AS artists_json, list_filter(list_transform(regexp_split_to_array(trim(coalesce(artist_ids, '')), '\\s*[,;|]\\s*|\\s+/\\s+'), lambda v: trim(v)), lambda v: v <> '') AS ids,
 list_filter(list_transform(regexp_split_to_array(trim(coalesce(artist_names, '')), '\\s*[,;|]\\s*|\\s+/\\s+'), lambda v: trim(v)), lambda v: v <> '') AS names, {c('artist_names')} AS whole FROM t),
x AS (SELECT rec, entry_id, src, CASE WHEN json_array_length(artists_json) > 0 THEN CAST(json_extract_string(artists_json, '$[*].id') AS varchar[]) WHEN len(ids) = 1 THEN ids WHEN len(ids) = len(names) THEN ids ELSE [] END AS i,
 CASE WHEN json_array_length(artists_json) > 0 THEN CAST(json_extract_string(artists_json, '$[*].name') AS varchar[]) WHEN len(ids) = 1 THEN [whole] WHEN len(ids) = len(names) THEN names ELSE [] END AS n FROM l),
p AS (SELECT rec, entry_id, src, generate_subscripts(i, 1) AS ord, trim(unnest(i)) AS sid, trim(unnest(n)) AS nm FROM x), q AS (SELECT *, 'ART_' || substr(sha1('spotify:' || sid), 1, 16) AS art FROM p WHERE sid <> '' AND nm <> '') """


def _seeded(t, r):
    from crateloom.operators import flows as W

    return W.seed(t, r.select("spotify_track_id", "whosampled_url", F.col("whosampled_match_status").alias("match_status"), F.col("row_id").alias("position")))


@query("spotify_tracks", "recordings", sql=_PAIRS + f"""SELECT rec AS recording_id, t.track AS spotify_track_id, arg_min({c('title')}, entry_id) AS title, arg_min({c('album_name')}, entry_id) AS album, arg_min(substr({c('album_release_date')}, 1, 4), entry_id) AS release_year,
arg_min_null(CAST(duration_ms AS bigint), entry_id) AS spotify_duration_ms, coalesce(any_value(m.u), '') AS whosampled_url, coalesce(any_value(m.st), '') AS whosampled_match_status FROM t LEFT JOIN m ON m.track = t.track GROUP BY 1, 2""")
def seed_recordings(t, r):
    return _seeded(t, r)["recordings"].select("recording_id", "spotify_track_id", "title", "album", "release_year", "spotify_duration_ms", "whosampled_url", "whosampled_match_status")


@query("spotify_tracks", "recordings", sql=_PAIRS + "SELECT art AS artist_id, sid AS spotify_artist_id, arg_max(nm, (entry_id, ord)) AS canonical_name, 'spotify:artist:' || sid AS spotify_uri FROM q GROUP BY 1, 2")
def seed_artists(t, r):
    return _seeded(t, r)["artists"]


@query("spotify_tracks", "recordings", sql=_PAIRS + """SELECT 'CRD_' || substr(sha1('credit:' || concat_ws('|', rec, art, nm, 'performer', 'Spotify track artist', 'Spotify')), 1, 16) AS credit_id, rec AS recording_id, art AS artist_id, nm AS artist_name,
CAST(arg_min(ord, (entry_id, ord)) AS int) AS artist_order, arg_min(src, (entry_id, ord)) AS source_url FROM q GROUP BY rec, art, nm""")
def seed_credits(t, r):
    return _seeded(t, r)["credits"].select("credit_id", "recording_id", "artist_id", "artist_name", "artist_order", "source_url")


@query("credits", "artists", "recordings", sql=f"""WITH o AS (SELECT {c('artist_name')} AS artist, {_PAGE('artist_name')} AS url, 'generated_artist_slug' AS source, 3 AS r, '' AS ev FROM credits WHERE {c('artist_id')} = '' AND {c('artist_name')} <> ''
UNION ALL SELECT {c('canonical_name')}, {c('whosampled_url')}, 'observed_artist_profile', 2, {c('artist_id')} FROM artists WHERE {c('canonical_name')} <> ''
UNION ALL SELECT {c('artist_names')}, CASE WHEN len(list_filter(string_split(regexp_replace({c('whosampled_url')}, '^[a-z]+://[^/]+', ''), '/'), lambda x: x <> '')) > 0 THEN regexp_extract({c('whosampled_url')}, '^([a-z]+://[^/]+/+[^/]+)', 1) || '/' ELSE '' END, 'verified_track_match', 1, {c('recording_id')} FROM recordings WHERE lower({c('whosampled_match_status')}) = 'matched' AND {c('artist_names')} <> ''),
k AS (SELECT DISTINCT *, lower(regexp_replace(url_decode(url), '/+$', '')) AS k FROM o WHERE url <> '')
SELECT artist, arg_min(url, (r, url)) AS url, array_to_string(list_transform(list_sort(list_distinct(list((r, source)))), lambda s: s[2]), '|') AS sources, count(DISTINCT nullif(ev, '')) AS n_evidence, CAST(min(r) AS int) AS first_source FROM k GROUP BY artist, k""")
def artist_review_candidates(cr, a, r):
    """Candidate pages of artists from matched recordings, artist profiles and made addresses."""
    from crateloom.operators import flows as W

    made = cr.where((clean(F.col("artist_id")) == "") & (clean(F.col("artist_name")) != "")).select(clean(F.col("artist_name")).alias("artist"), _page("artist_name").alias("url"), F.lit("generated_artist_slug").alias("source"), F.lit("").alias("evidence"))
    seen = a.where(clean(F.col("canonical_name")) != "").select(clean(F.col("canonical_name")).alias("artist"), clean(F.col("whosampled_url")).alias("url"), F.lit("observed_artist_profile").alias("source"), clean(F.col("artist_id")).alias("evidence"))
    found = r.where((F.lower(clean(F.col("whosampled_match_status"))) == "matched") & (clean(F.col("artist_names")) != "")).select(
        clean(F.col("artist_names")).alias("artist"), P.profile_of_track(F.col("whosampled_url")).alias("url"), F.lit("verified_track_match").alias("source"), clean(F.col("recording_id")).alias("evidence"))
    return W.review_candidates(made.union(seen).union(found)).select("artist", "url", "sources", "n_evidence", "first_source")


@query("recordings", "spotify_tracks", sql=f"""WITH t AS (SELECT {c('spotify_track_id')} AS track, min({c('title')}) AS title FROM spotify_tracks WHERE {c('spotify_track_id')} <> '' GROUP BY 1)
SELECT row_id, title AS cached_title, CASE WHEN track IS NULL THEN 'to_fetch' ELSE 'cached' END AS status FROM (SELECT row_id, spotify_track_id AS sid FROM recordings) r LEFT JOIN t ON t.track = {c('r.sid')}""")
def cached_tracks(r, t):
    from crateloom.operators import flows as W

    return W.cached_tracks(r.select("row_id", "spotify_track_id"), t).select("row_id", "cached_title", "status")


QUERIES = {k: v for k, v in _ALL.items() if k not in _BEFORE}
SQL = {k: v for k, v in _SQL.items() if k in QUERIES}
