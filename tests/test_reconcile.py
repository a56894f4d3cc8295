"""Reviews, reconciliation, credits and the library on small tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from crateloom.functions import similarity as S
from crateloom.functions.similarity import ratio
from crateloom.functions.text import fold_ascii
from crateloom.operators import reconcile as R
from crateloom.operators import reviews as V
from crateloom.operators import scoring as B



def test_score_candidates_against_all_pairs(spark):
    rnd = random.Random(3)
    words, people = ["river", "stone", "night", "garden", "fire"], ["Ana Sol", "Bo Ray", "Cy Moe"]
    make = lambda k: (f"{k}", " ".join(rnd.sample(words, 2)), rnd.choice(people), rnd.choice(["", "Alb", "Alc"]), rnd.choice(["", "1999", "2003"]), rnd.choice(["", "200000", "203000", "260000"]))
    cat, pool = [make(f"R{k}") for k in range(12)], [make(f"T{k}") for k in range(20)]
    cat.append(("R99", "zzz", "Nobody", "", "", ""))
    catalog = spark.createDataFrame([(*r, "", "", "") for r in cat], "recording_id string, whosampled_title string, whosampled_artist_names string, whosampled_album string, whosampled_release_year string, whosampled_duration_ms string, catalog_reconciliation_status string, canonical_merge_status string, canonical_recording_id string")
    tracks = spark.createDataFrame([(*r, "") for r in pool], "spotify_track_id string, title string, artist_names string, album_name string, album_release_date string, duration_ms string, artists_json string")

    def score(a, b):
        d = abs(int(a[5]) - int(b[5])) / 1000 if a[5] and b[5] else None
        parts = [(ratio(fold_ascii(a[1]), fold_ascii(b[1])), 0.4), (1.0 if a[2] == b[2] else ratio(fold_ascii(a[2]), fold_ascii(b[2])), 0.35), (None if d is None else next((s for m, s in ((2, 1.0), (5, 0.95), (10, 0.85), (20, 0.65), (30, 0.45), (60, 0.2)) if d <= m), 0.0), 0.15),
                 (None if not (a[4] and b[4]) else {0: 1.0, 4: 0.45}[abs(int(a[4]) - int(b[4]))], 0.05), (ratio(fold_ascii(a[3]), fold_ascii(b[3])) if a[3] and b[3] else None, 0.05)]
        known = [(s, w) for s, w in parts if s is not None]
        return sum(s * w for s, w in known) / sum(w for _, w in known)

    got = R.score_candidates(catalog, tracks, top=50).collect()
    assert [r.candidate_status for r in got if r.recording_id == "R99"] == ["no_plausible_candidate"]
    scored = {(r.recording_id, r.spotify_track_id): r.match_score for r in got if r.spotify_track_id}
    met = {(a[0], b[0]): score(a, b) for a in cat for b in pool if a[2] == b[2] or a[1] == b[1]}
    assert all(scored[k] == pytest.approx(s) for k, s in met.items() if s >= 0.45)
    assert all(s == pytest.approx(score(next(a for a in cat if a[0] == i), next(b for b in pool if b[0] == j))) for (i, j), s in scored.items())
    done = catalog.withColumn("canonical_recording_id", F.lit("X"))
    assert R.score_candidates(done, tracks).count() == 0


def test_best_pairs_of_a_block_without_scoring_all(monkeypatch):
    rnd = random.Random(5)
    text = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 7))) for _ in range(rnd.randint(1, n)))
    names = lambda: "|".join(text(2) for _ in range(rnd.randint(0, 3)))
    titles = [text(3) for _ in range(40)] + ["x" * 210 + "ab", ""]

    def side(n, letter):
        rows = [(f"{letter}{k:03}", (t := rnd.choice(titles)), t[: rnd.choice([3, 300])], names(), rnd.choice(["", text(2)]), rnd.choice([float("nan"), 1999.0, 2001.0]), rnd.randint(0, 90_000), rnd.random() < 0.8, 0.45) for k in range(n)]
        return {c: np.array(v, dtype=object if c in ("id", "fold", "base", "names", "album_fold") else None) for c, v in zip(("id", "fold", "base", "names", "album_fold", "year", "ms", "timed", "least"), zip(*rows))}

    left, right = side(30, "L"), side(120, "R")
    right = {c: np.concatenate([v, v[:40]]) for c, v in right.items()}  # ties
    right["id"] = np.array([f"R{k:03}" for k in range(160)], dtype=object)

    def score(i, j):
        a, b = ({c: v[k] for c, v in s.items()} for s, k in ((left, i), (right, j)))
        d, y = abs(a["ms"] - b["ms"]) / 1000 if a["timed"] and b["timed"] else None, abs(a["year"] - b["year"])
        parts = [max(S.ratio(a["fold"], b["fold"]), S.ratio(a["base"], b["base"])), S.both_ways(a["names"].split("|"), b["names"].split("|")), None if d is None else next((s for m, s in S.DURATION_A if d <= m), 0.0), None if y != y else next((s for m, s in S.YEAR_A if y <= m), 0.0), S.ratio(a["album_fold"], b["album_fold"]) if a["album_fold"] and b["album_fold"] else None]
        known = [(s, w) for s, w in zip(parts, S.CATALOG_WEIGHTS.values()) if s is not None]
        total = used = 0.0
        for s, w in known:
            total, used = total + s * w, used + w
        return total / used

    every = [sorted((-score(i, j), right["id"][j]) for j in range(160)) for i in range(30)]
    want = {(left["id"][i], t, -s) for i, row in enumerate(every) for s, t in row[:5] if -s >= 0.45}
    seen = []
    ways = B.artists
    monkeypatch.setattr(B, "artists", lambda a, b: (seen.append(len(a)), ways(a, b))[1])
    for few in (0, 10_000):
        monkeypatch.setattr(B, "FEW_PAIRS", few)
        got = B.Sides(left, right, 5).best([(slice(0, 30), slice(0, 160))])
        assert set(got[["left", "right", "match_score"]].itertuples(index=False, name=None)) == want
    assert sum(seen[:-1]) < 30 * 160 / 2  # before, the artists of each pair were compared


def test_large_blocks_are_cut(spark, monkeypatch):
    monkeypatch.setattr(B, "CHUNK", 3)
    rows = [(f"{k:02}", f"river {k % 4}", "", "n", "", 1999, 200_000 + k, "w") for k in range(10)]
    schema = "id string, fold string, base string, names string, album_fold string, year int, ms long, block string"
    side = spark.createDataFrame(rows, schema)
    got = B.best_in_blocks(side.withColumn("least", F.lit(0.45)), side, 10)
    assert {(r.left, r.right) for r in got.collect()} == {(a[0], b[0]) for a in rows for b in rows}


def test_reviews_change_rows(spark):
    rows = spark.createDataFrame([("t1", "u1", "review"), ("t2", "u2", "review"), ("t3", "u3", "review")], "spotify_track_id string, whosampled_url string, match_status string")
    d = spark.createDataFrame([("t1", "accepted", "d", "", "m1", ""), ("t2", "rejected", "d", "me", "m2", "")], "spotify_track_id string, decision string, reviewed_at string, decision_source string, manual_whosampled_track_url string, manual_whosampled_artist_url string")
    got = {r.spotify_track_id: (r.match_status, r.whosampled_url, r.whosampled_review_decision_source) for r in V.apply_page_decisions(rows, d).collect()}
    assert got == {"t1": ("matched", "m1", "contributor_review"), "t2": ("rejected", "u2", "me"), "t3": ("review", "u3", "")}
    c = V.apply_candidate_decisions(rows.withColumn("spotify_isrc", F.lit("X")), spark.createDataFrame([("t1", "accepted", "n", "d"), ("t2", "other", "", "")], "spotify_track_id string, decision string, note string, reviewed_at string"), "spotify_track_id")
    assert {r.spotify_track_id: (r.spotify_match_status, r.spotify_isrc) for r in c.collect()} == {"t1": ("matched", "X"), "t2": ("review", None), "t3": ("", "X")}
    prior = spark.createDataFrame([("t1", "matched"), ("t2", "")], "spotify_track_id string, spotify_match_status string")
    got = V.restore_state(rows.select("spotify_track_id").withColumn("spotify_match_status", F.lit("new")), prior, "spotify_track_id")
    assert {tuple(r) for r in got.collect()} == {("t1", "matched"), ("t2", "new"), ("t3", "new")}


def test_proposals_keep_their_history(spark):
    new = spark.createDataFrame([("R", "a", "s", "spotify", "T", "0.9", "{}", "", "", "", "", "", ""), ("R", "a", "s", "spotify", "U", "0.8", "{}", "rejected", "", "", "", "", "")], ", ".join(f"{c} string" for c in V.PROPOSAL))
    none = spark.createDataFrame([], ", ".join(f"{c} string" for c in ["proposal_id", *V.PROPOSAL, "discovered_at", "updated_at", "reviewed_at", "review_source"]))
    one = V.upsert_proposals(none, new, F.lit("t1"))
    pid = one.where("candidate_identity = 'T'").first().proposal_id
    decided = V.decide_proposals(one, spark.createDataFrame([(pid, "accepted", "me")], "proposal_id string, decision string, review_source string"), F.lit("t2"))
    again = {r.candidate_identity: r for r in V.upsert_proposals(decided, new, F.lit("t3")).collect()}
    assert (again["T"].status, again["T"].discovered_at, again["T"].reviewed_at, again["T"].updated_at) == ("pending", "t1", "t2", "t3") and again["U"].status == "rejected"
    assert V.proposals_for(decided, "spotify", "T", ["accepted"]).count() == 1
    with pytest.raises(Exception, match="accepted or rejected"):
        V.decide_proposals(one, spark.createDataFrame([(pid, "maybe", "")], "proposal_id string, decision string, review_source string"), F.lit("now")).collect()


def test_aliases_and_candidates(spark):
    aliases = spark.createDataFrame([("A", ["a-x", "A_X"]), ("B", ["b"])], "name string, slugs array<string>")
    learned = spark.createDataFrame([("A", "ax"), ("B", "b1"), ("B", "b2"), ("C", "c"), ("", "z")], "name string, slug string")
    assert {r.name: r.slugs for r in V.learn_alias(aliases, learned).collect()} == {"A": ["ax"], "B": ["b"], "C": ["c"]}
    assert {r.name: sorted(r.slugs) for r in V.learn_alias(aliases, learned, strict=False).collect()} == {"A": ["A_X", "a-x", "ax"], "B": ["b", "b1", "b2"], "C": ["c"]}
    cand = spark.createDataFrame([("x", "u1", True), ("x", "u2", False), ("y", "u3", True), ("y", "u4", True)], "artist string, whosampled_url string, ok boolean")
    assert [r.whosampled_url for r in V.auto_accept(cand, "artist", F.col("ok")).collect()] == ["u1"]
    profiles = spark.createDataFrame([("u1/", 404), ("u3", 200)], "requested_url string, http_status int")
    assert {r.whosampled_url for r in V.drop_failed(cand, profiles).collect()} == {"u2", "u3", "u4"}
    assert V.exactly_one(cand, F.col("whosampled_url") == "u1", "artist").count() == 1
    for wanted in (F.col("artist") == "x", F.col("artist") == "none"):
        with pytest.raises(Exception, match="not exactly one"):
            V.exactly_one(cand, wanted, "artist").collect()
    reviews = spark.createDataFrame([("x", "rejected", "old"), ("y", "accepted", "u")], "artist string, decision string, whosampled_artist_url string")
    rows = spark.createDataFrame([("x", "new"), ("y", "new"), ("z", "")], "artist string, learned string")
    assert {r.artist for r in V.to_review(rows, reviews, "artist", "learned").collect()} == {"x", "z"}
    placed = V.queue(cand, [F.asc("artist"), F.asc("whosampled_url")]).orderBy("queue_position").collect()
    assert [(r.whosampled_url, r.queue_position, r.queue_total) for r in placed] == [("u1", 1, 4), ("u2", 2, 4), ("u3", 3, 4), ("u4", 4, 4)]


def _credits(spark, rows):
    return spark.createDataFrame([(k, "R", *r) for k, r in enumerate(rows)], "position int, canonical_recording_id string, artist_id string, artist_name string, artist_whosampled_url string")


def test_ladder_of_credits(spark):
    artists = spark.createDataFrame([("A1", "Ann Lee", "s1", "u/ann/"), ("A2", "Bo Ray", "", ""), ("A3", "Bo Ray", "", ""), ("A4", "Cy Moe", "s4", "")], "artist_id string, canonical_name string, spotify_artist_id string, whosampled_url string")
    reviews = spark.createDataFrame([("accepted", "s4", "Cyrus", "https://pages.example/Cy-M/"), ("rejected", "s1", "Nope", "https://pages.example/Nope/")], "decision string, spotify_artist_id string, spotify_artist_name string, whosampled_artist_url string")
    searches = spark.createDataFrame([("ART_n", "no_results", "New One", ""), ("ART_o", "searched", "", ""), ("ART_p", "no_results", "Other Name", "")], "provisional_artist_id string, status string, artist_name string, whosampled_url string")
    rows = [("", "x", "https://pages.example/cy-m"), ("", "Cyrus", ""), ("", "Cy M", ""), ("", "x", "u/ann"), ("", "Cy Moe", ""), ("", "Bo Ray", ""), ("ART_n", "New One", "n/1/"), ("ART_n", "New One", "n/1/"), ("", "Zed", "n/1"), ("", "new one", ""), ("ART_o", "Old", "o/1"), ("ART_p", "Else", "p/1"), ("", "Nope", "")]
    out = R.reconcile_credits(_credits(spark, rows), artists, reviews, searches)
    got = [(r.artist_reconciliation_status, r.canonical_artist_id, r.artist_reconciliation_method) for r in out["credits"].orderBy("position").collect()]
    url, alias, exact, name = R.METHODS[:4]
    assert got == [("resolved", "A4", url), ("resolved", "A4", alias), ("resolved", "A4", alias), ("resolved", "A1", exact), ("resolved", "A4", name), ("ambiguous", "", "exact_name_conflict"), ("resolved", "ART_n", "catalog_only_canonical"),
                   ("resolved", "ART_n", exact), ("resolved", "ART_n", exact), ("resolved", "ART_n", name), ("unresolved", "", ""), ("unresolved", "", ""), ("unresolved", "", "")]
    assert [r.artist_id for r in out["artists"].collect()] == ["ART_n"] and out["issues"].count() == 0
    twice = artists.union(spark.createDataFrame([("A9", "X", "s1", "u/ann")], artists.schema))
    issues = R.reconcile_credits(_credits(spark, rows), twice, reviews, searches)["issues"]
    assert {r.check_name for r in issues.collect()} == {"repeated_spotify_id", "repeated_address"}
    with pytest.raises(ValueError, match="repeated_address"):
        R.gates(issues)


CR = "position int, recording_id string, artist_id string, artist_name string, role string, source_role string, source string, source_url string, artist_order string"


def test_credits_are_materialised_once(spark):
    old = spark.createDataFrame([(1, "R", "A", "Ann", "produced_by", "Producer", "s", "u", "1.0"), (2, "R", "A", "", "producer", "Producer", "s", "u2", "1")], CR)
    cat = spark.createDataFrame([(1, "R", "A", "Ann L", "x", "Producer", "c", "u", "1"), (2, "R", "B", "Bo", "x", "Guest Vocals", "c", "u", ""), (3, "R", "B", "Bo", "x", "track artist", "c", "u", "2"), (4, "R", "", "Z", "x", "Nobody", "c", "u", "")], CR)
    cat = cat.withColumns({"canonical_recording_id": F.col("recording_id"), "canonical_artist_id": F.col("artist_id"), "canonical_artist_name": F.lit("")})
    artists = spark.createDataFrame([("B", "Bo Ray")], "artist_id string, canonical_name string")
    first = R.migrate_credits(old, cat, artists)
    assert first["issues"].count() == 0
    assert {(r.artist_id, r.role, r.function, r.artist_name, r.artist_order) for r in first["credits"].collect()} == {("A", "producer", "", "Ann", 1), ("B", "performer", '["guest_vocals"]', "Bo Ray", 2)}
    assert first["credit_evidence"].count() == 5
    again = R.materialize_credits(first["credits"], first["credit_evidence"], cat)
    assert again["issues"].count() == 0 and again["credits"].count() == 2 and again["credit_evidence"].count() == 5
    bad = R.materialize_credits(first["credits"], first["credit_evidence"], cat.withColumn("artist_order", F.lit("7")).union(cat.withColumn("source_role", F.lit("Odd"))))
    assert {r.check_name for r in bad["issues"].collect()} == {"unmapped_role", "order_conflict"}


def test_library_and_memberships(spark):
    lib = {n: spark.createDataFrame([], f"{i} string, x string") for n, i in R.LIBRARY.items()}
    lib["recordings"] = spark.createDataFrame([("R1", "")], "recording_id string, x string")
    lib["credits"] = spark.createDataFrame([], "credit_id string, recording_id string, artist_id string")
    lib["credit_evidence"] = spark.createDataFrame([], "credit_evidence_id string, credit_id string")
    lib["relationships"] = spark.createDataFrame([], "relationship_id string, source_recording_id string, target_recording_id string")
    new = dict(lib)
    new["recordings"] = spark.createDataFrame([("R1", "v"), ("R2", "w")], "recording_id string, x string")
    new["credits"] = spark.createDataFrame([("C1", "R1", ""), ("C2", "R9", "A9"), ("C3", "", "")], "credit_id string, recording_id string, artist_id string")
    new["credit_evidence"] = spark.createDataFrame([("E1", "")], "credit_evidence_id string, credit_id string")
    new["relationships"] = spark.createDataFrame([("L1", "", "R7"), ("L2", "R2", "")], lib["relationships"].schema)
    out = R.merge_library(new, lib)
    assert {tuple(r) for r in out["recordings"].collect()} == {("R1", "v"), ("R2", "w")}
    assert {r.check_name: r.n_rows for r in R.library_errors({k: out[k] for k in R.LIBRARY}).collect()} == {"credit_recording": 2, "credit_artist": 1, "evidence_credit": 1, "relationship_source": 0, "relationship_target": 1}
    assert {r.detail for r in out["issues"].where("check_name = 'broken_key'").collect()} == {"credit_recording", "credit_artist", "evidence_credit", "relationship_target"}
    t = spark.createDataFrame([("t1", "p"), ("t2", "p"), ("", "p")], "spotify_track_id string, playlist_id string")
    r = spark.createDataFrame([("R1", "t1")], "recording_id string, spotify_track_id string")
    none = spark.createDataFrame([], "library_membership_id string, contributor_id string, recording_id string, added_via string, import_source_type string, import_source_id string, added_at string")
    m = R.memberships(t, r, none, "C")
    assert [x.recording_id for x in m["new"].collect()] == ["R1"] and {x.check_name for x in m["issues"].collect()} == {"entry_without_track", "no_recording"}
    assert R.memberships(t, r, m["memberships"], "C")["new"].count() == 0


def test_upgrades_and_guards(spark):
    eq = R.accepted_equivalences(spark.createDataFrame([("accepted", "Jorge Ben Jor", "https://pages.example/Jorge-Ben/"), ("rejected", "X", "/Y/")], "decision string, spotify_artist_name string, whosampled_artist_url string"))
    base = dict(whosampled_artist_names="jorge ben", artist_names="Jorge Ben Jor", match_status="review", title_score=0.99, year_difference=0, year_conflict="", title_year_conflict="false", version_conflict="", target_versions=["live"], candidate_versions=["live"])
    rows = [base, base | {"year_difference": 1}, base | {"artist_names": "Jorge Ben Jor, X"}, base | {"candidate_versions": ["remix"]}, base | {"year_conflict": "yes"}, base | {"match_status": "unmatched"}]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "whosampled_artist_names string, artist_names string, match_status string, title_score double, year_difference int, year_conflict string, title_year_conflict string, version_conflict string, target_versions array<string>, candidate_versions array<string>")
    assert sorted(r.match_status for r in R.upgrade_reviews(df, eq).collect()) == ["matched", "review", "review", "review", "review", "unmatched"]
    a, b = spark.createDataFrame([("1", "x"), ("2", None)], "id string, c string"), spark.createDataFrame([("1", "x"), ("2", "y")], "id string, c string")
    assert [r.detail for r in R.unchanged(a, b, "id", "c").collect()] == ["2"]
    pages = spark.createDataFrame([("p", "T1"), ("p", "T2"), ("q", "T1"), ("q", "")], "page string, target string")
    assert [r.detail for r in R.one_target(pages, "page", "target").collect()] == ["p"]


def test_pages_and_evidence(spark):
    wanted = spark.createDataFrame([("https://pages.example/A/B",), ("https://pages.example/A/C/",), ("https://pages.example/A/D/",)], "url string")
    index = spark.createDataFrame([("html", "http://www.pages.example/A/B/", "h", 1, "p1"), ("png", "https://pages.example/A/B", "h", 1, "p2")], "evidence_type string, source_url string, sha256 string, bytes int, relative_path string")
    cached = spark.createDataFrame([("https://pages.example/a/c",)], "requested_url string")
    assert [r.fetch_plan for r in R.fetch_plan(wanted, cached, index, "url").orderBy("url").collect()] == ["evidence", "cache", "to_fetch"]
    assert [r.evidence for r in R.evidence_lookup(wanted, index, "url").orderBy("url").collect()] == ["ambiguous", "absent", "absent"]
    assert [r.evidence for r in R.evidence_lookup(wanted, index, "url", "html").orderBy("url").collect()] == ["single", "absent", "absent"]
    manifest = spark.createDataFrame([(1, "/A/B/", "archived", "f1"), (2, "/A/B", "archived", "f2"), (3, "/A/C/", "http_404", "f3"), (4, "/A/D/", "archived", "gone")], "position int, requested_url string, status string, archive_path string")
    docs = spark.createDataFrame([("f1", "x"), ("f2", "y"), ("f3", "z")], "path string, html string")
    assert [r.archive_path for r in R.documents_of(manifest, docs).collect()] == ["f1"]
    files = spark.createDataFrame([("/b/n.html",), ("/a/n.html",), ("/c/m.html",)], "path string")
    got = R.find_in_order(spark.createDataFrame([("n.html",), ("m.html",)], "n string"), files, F.col("n"), ["/a", "/b"])
    assert {tuple(r) for r in got.collect()} == {("n.html", "/a/n.html"), ("m.html", None)}
    rel = spark.createDataFrame([("s", "s/", "t"), ("s", "t", "s"), ("s", "s", "s"), ("s", "t", "u"), ("", "s", "t")], "source_url string, track_1_url string, track_2_url string")
    assert [(r.orientation, r.error) for r in R.orient(rel).collect()] == [("track_1_primary", None), ("track_2_primary", None), (None, "both tracks fit"), (None, "no track fits"), (None, "source without address")]
    back = R.back_propagate(spark.createDataFrame([("Song", "Jo", ""), ("Song", "Jo", "R0"), ("X", "Y", "")], "related_track string, related_artist string, target_recording_id string"),
                            R.resolve_targets(R.targets(spark.createDataFrame([(1, "Song", "Jo")], "position int, related_track string, related_artist string")), spark.createDataFrame([("song", ["JO"], "u/1")], "title string, artist_names array<string>, canonical_url string")))
    assert sorted(r.target_recording_id for r in back.collect())[0] == "" and back.where("target_recording_id like 'REC_%'").count() == 1


def test_promotion_of_recordings(spark):
    rec = spark.createDataFrame([(1, "R1", "t1", "", "")], "position int, recording_id string, spotify_track_id string, whosampled_title string, title string")
    cat = spark.createDataFrame([("1", "P1", "WT", "", "t1", "", "0.9"), ("2", "P2", "W2", "matched", "t1", "", ""), ("3", "P3", "W3", "matched", "t3", "", ""), ("4", "P4", "W4", "matched", "t3", "", ""), ("5", "P5", "W5", "matched", "t9", "", ""), ("6", "R1", "W6", "matched", "t6", "", "")],
                                "position string, recording_id string, whosampled_title string, spotify_match_status string, spotify_track_id string, canonical_recording_id string, spotify_match_score string").withColumns({"whosampled_artist_names": F.lit(""), "whosampled_release_year": F.lit("")})
    rev = spark.createDataFrame([("accepted", "P1", "t1", "0.9", "1")], "decision string, recording_id string, spotify_track_id string, match_score string, position string")
    tracks = spark.createDataFrame([(1, "t3", "Song 3"), (2, "t6", "Song 6")], "entry_id long, spotify_track_id string, title string").withColumns({c: F.lit("") for c in "artist_names album_name album_label album_release_date album_id album_release_precision album_image_url spotify_uri spotify_url isrc duration_ms".split()})
    out = R.reconcile_recordings(rec, cat, rev, tracks, F.lit("now"))
    assert {tuple(r) for r in out["mappings"].collect()} == {("P1", "R1", "accepted_reconciled"), ("P2", "R1", "matched_reconciled_existing"), ("P3", "P3", "matched_promoted"), ("P4", "P3", "matched_reconciled_existing"), ("P5", "P5", "matched_promoted"), ("R1", "R1", "matched_promoted")}
    assert {(r.check_name, r.detail) for r in out["issues"].collect()} == {("promoted_id_exists", "R1"), ("no_cached_track", "t9")}
    got = {r.recording_id: (r.title, r.whosampled_title, r.catalog_reconciliation_status) for r in out["recordings"].collect() if r.catalog_reconciliation_status != "matched_promoted" or r.recording_id == "P3"}
    assert got["R1"] == ("", "WT", "accepted_reconciled") and got["P3"] == ("Song 3", "W3", "matched_promoted")
    linked = R.propagate_ids(spark.createDataFrame([("P2",), ("zz",)], "recording_id string"), out["mappings"], "recording_id", "canonical_recording_id", "recording_reconciled", F.lit("now"))
    assert {(r.recording_id, r.canonical_recording_id) for r in linked.collect()} == {("P2", "R1"), ("zz", "")}
