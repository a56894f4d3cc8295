"""Scalar functions against written-out cases."""

import pytest
from pyspark.sql import functions as F

from crateloom.functions import arrays as A
from crateloom.functions import keys as K
from crateloom.functions import pages as P
from crateloom.functions import similarity as S
from crateloom.functions import titles as TT
from crateloom.functions.text import fold_ascii_lower, fold_descriptor, truthy_text


@pytest.fixture
def each(spark):
    """The results of a column function over texts."""

    def run(fn, values):
        return [r[0] for r in spark.createDataFrame([(v,) for v in values], "x string").select(fn(F.col("x"))).collect()]

    return run


def test_relationship_types(each):
    urls = ["https://pages.example/sample/1/", "/cover/2/", "/interpolation/3/x/", "/REMIX/4/", "/sampled/5/", "", None]
    assert each(K.relation_type, urls) == ["sampled", "covered", "interpolated", "remixed", "", "", ""]
    assert each(lambda c: K.relation_type(c, 1), urls) == ["sampled", "covers", "interpolates", "remix", "", "", ""]
    assert each(lambda c: K.relation_of_page(F.lit("/x/"), c), ["A Remix of a sample", "Cover", "interpolated", "Sample", "x"]) == ["remix", "covers", "interpolates", "sampled", ""]


def test_roles(each):
    assert each(K.canonical_role, ["Producer(s)", "composer(s)", "Mix Engineer", "Guest Vocals", "Engineer", "producers", "co-writer", None]) == [
        "produced_by", "composed_by", "mixed_by", "guest_vocals", "engineered_by", "producers", "co-writer", ""]


def test_version_suffixes(each):
    cases = {
        "Song - 2011 Digital Remaster": "Song", "Song - 2011 Remaster": "Song - 2011 Remaster", "Song - Remastered 2011": "Song", "Song - Remasterizado": "Song", "Song (Remastered 2011)": "Song",
        "Song (Remastered) Live": "Song (Remastered) Live", "Song [Remaster]": "Song", "Song - Radio  Edit ": "Song", "Song - Single Version": "Song", "Song - Album Version": "Song", "Song - Radio Edit x": "Song - Radio Edit x",
    }
    assert each(TT.without_version, cases) == list(cases.values())


def test_link_classes(each):
    cases = {
        "https://other.example/x": ("external", "external"), "https://www.pages.example/": ("site_root", "site_root"), "/sample/12/x/": ("relationship_detail",) * 2, "/Other/": ("other", "other"), "/Jo-Moe/?sp=2": ("artist_pagination", "artist_listing"),
        "/jo-moe/": ("artist_profile", "artist_listing"), "/Jo-Moe/Samples/": ("artist_catalog_page", "artist_subpage"), "/Jo-Moe/facts/": ("artist_track_candidate", "artist_subpage"), "/Jo%2DMoe/Song/": ("artist_track_candidate", "track_candidate"),
        "/Jo-Moe/Song/x/": ("artist_internal_other", "artist_internal_other"), "/Jo-Moe/tracks/x/": ("artist_catalog_page", "artist_internal_other"),
    }
    assert each(lambda c: K.link_class(c, F.lit("Jo-Moe")), cases) == [a for a, _ in cases.values()]
    assert each(lambda c: K.artist_link_class(c, F.lit("Jo-Moe")), cases) == [b for _, b in cases.values()]


def test_page_addresses(each, spark):
    assert each(P.strict_url, ["http://pages.example//A//B?x=1#y", "https://www.pages.example", "https://x.example/A", "/A", None]) == ["https://www.pages.example/A/B/", "https://www.pages.example/", None, None, None]
    with pytest.raises(Exception, match="not a page"):
        each(P.strict_url_or_fail, ["https://x.example/"])
    assert each(lambda c: P.manual_url(c, "track"), ["pages.example/A%20B/C", "https://pages.example/search/x", "https://pages.example/A", "https://x.example/A/B", ""]) == [("https://www.pages.example/A%20B/C/", "A B", "C"), None, None, None, None]
    assert each(lambda c: P.manual_url(c, "artist")["artist_slug"], ["https://pages.example:443/A/", "pages.example/remix"]) == ["A", None]
    assert each(P.is_track_page, ["https://pages.example/A/B/", "/cover/B/", "/A/", None]) == [True, False, False, False]
    assert each(P.is_track_page_strict, ["https://pages.example/A/B", "https://pages.example/A/facts", "https://pages.example/User/B", "/A/B"]) == [True, False, False, False]
    assert each(P.is_artist_link, ["/A/", "/A/B/", "/album/", "A/", "", None]) == [True, False, False, False, False, False]
    assert each(P.is_idle_label, ["", " Next ", "See 4 more connections", "Song", None]) == [True, True, True, False, True]
    assert each(P.video_or_blank, ["https://youtu.be/x", "https://m.youtube.com/watch?v=1", "https://x.example/youtube.com"]) == ["https://youtu.be/x", "https://m.youtube.com/watch?v=1", ""]
    assert each(P.profile_of_track, ["https://pages.example/A/B/", "/A/B/", "/sample/1/", ""]) == ["https://pages.example/A/", "https://www.pages.example/A/", "", ""]
    assert each(P.profile_url, ["Secos-&-Molhados", "É-Preciso", "a/b", " ", "It's-(x)"]) == ["https://www.pages.example/Secos-&-Molhados/", "https://www.pages.example/%C3%89-Preciso/", "https://www.pages.example/a%2Fb/", "", "https://www.pages.example/It's-(x)/"]
    assert each(lambda c: P.listing_url(c, F.lit("artist"), F.lit(1)), ["https://pages.example/A/?x=1"]) == ["https://pages.example/A/?role=1"]
    assert each(P.ascii_name, ["Ação x", "", "__a__"]) == ["A_o_x", "track", "a"] and each(P.media_name, ["a/b  c", None]) == ["a_b_c", "track"] and each(P.safe_part, ["a%2Fb c"]) == ["a_b_c"]
    assert each(P.detail_archive_name, ["/cover/12/x/", "/A/B/"]) == ["relationship_detail_cover_12.html", None]
    assert each(lambda c: P.detail_archive_name(c, True), ["/cover/12/x/"]) == ["relationship_detail_covers_12.html"]
    assert each(P.secondary_archive_name, ["https://pages.example/A/B b/", "https://pages.example/"]) == ["A-B_b.html", None]
    assert each(lambda c: P.same_type(c, F.lit("covers")), ["covered", "remix", "", "covers"]) == [True, False, True, True]
    assert each(lambda c: P.opposite_url(F.lit(""), c, F.lit('{"url":"/1"}'), F.lit('{"url":"/2"}')), ["track_1_primary", "track_2_primary", "x"]) == ["/2", "/1", ""]


def test_keys(each, spark):
    row = spark.range(1)
    assert row.select(K.resolution_key(F.lit("bound"), F.array(F.lit("b"), F.lit("a"), F.lit("b"), F.lit("")), F.lit("1971-02"))).first()[0] == "a|b::bound::1971"
    assert each(lambda c: K.storage_key(c, F.lit("k"), c == "s"), ["s", "t", ""]) == ["s", "k", "k"]
    assert each(lambda c: K.review_key(c, F.lit("u")), ["r", " "]) == ["r", "whosampled:u"]
    assert row.select(K.url_hash_id(F.lit("abc"))).first()[0] == "REC_a9993e364706816a"


def test_lists(each):
    text = '[{"name": "A, B"}, 3, {"name": " "}, {"name": "C"}]'
    assert each(lambda c: A.names(c, F.lit("x, y")), [text, "", "[broken", "{}"]) == [["A, B", "C"], ["x", "y"], ["x", "y"], ["x", "y"]]
    assert each(A.parse_functions, ['["b","a"," ","b"]', "", None]) == [["a", "b"], [], []]
    assert each(lambda c: A.serialize_functions(A.parse_functions(c)), ['["b","é"]', "[]"]) == ['["b","é"]', ""]
    with pytest.raises(Exception, match="not a JSON list"):
        each(A.parse_functions, ["{}"])
    assert each(lambda c: F.size(A.credit_list(c)), [text, "x", None]) == [3, 0, 0]


def test_seconds_years_numbers(each):
    assert each(TT.iso_duration_seconds, ["PT0H6M14S", "PT3M11S", "PT5.5S", "PT", "x", "", None]) == [374, 191, 5.5, 0, None, None, None]
    assert each(TT.spoken_seconds, ["at 1:33", "0:05", "93 seconds", "5 sec", "1m 33s", "2 min 3 sec", "none", None]) == [93, 5, 93, 5, 93, 123, None, None]
    assert each(TT.title_year, ["Song 1999 (2001)", "x19990", None]) == ["1999", "", ""] and each(TT.year_of, ["c1899", "1899-01", "18999"]) == [None, 1899, None]
    assert each(lambda c: TT.display_number(c, 2), ["1.005", "x", ""]) == ["1.00", "", ""]
    assert each(truthy_text, ["0", "a", None, "False"]) == ["", "a", "", ""]
    assert fold_descriptor("Ação (Ao-Vivo)") == "acao ao vivo" and fold_ascii_lower("Straße & X") == "stra e and x"


def test_scores_and_decisions(spark):
    row = spark.range(1)
    val = lambda c: row.select(c).first()[0]
    lit = F.lit
    assert val(S.summed({"title": lit(1.0), "artist": lit(None).cast("double"), "year": lit(1.0)}, S.ENRICHMENT_WEIGHTS)) == pytest.approx(0.7)
    assert val(S.cache_score(lit(1.0), lit(0.8), lit(True))) == 0.95 and val(S.cache_score(lit(1.0), lit(0.7), lit(True))) == pytest.approx(0.895)
    assert [val(S.cache_decision(lit(a), lit(b))) for a, b in ((0.9, 0.05), (0.9, 0.01), (0.7, 1.0))] == ["HIGH_CONFIDENCE", "REVIEW", "NO_CONFIDENT_MATCH"]
    safe = lambda **k: val(S.safe_cached(*[lit(v) for v in ({"s": "matched", "t": "x", "y": 0, "a": False, "b": False, "d": ""} | k).values()]))
    assert safe() and not any(safe(**k) for k in ({"s": "review"}, {"y": 1}, {"y": None}, {"a": True}, {"b": True}, {"d": "1000"}, {"t": ""}))
    arr = lambda *x: F.array(*map(lit, x)) if x else F.array().cast("array<string>")
    rank = lambda *a: tuple(val(S.kb_rank(*a, ["singer"])))
    assert rank(lit("jo"), lit("jo"), arr(), arr("Q5"), arr("Q639669"), lit("a singer")) == (230, True, True)
    assert rank(lit("jo"), lit("x"), arr("jo"), arr("Q5"), arr(), lit("a film")) == (-65, True, False)
    assert rank(lit("jo"), lit("x"), arr(), arr(), arr(), lit("a rock band given name")) == (0, False, True)
    assert [val(S.kb_status(lit(a), lit(b), lit(c))) for a, b, c in ((True, True, True), (True, False, True), (True, True, False))] == ["resolved", "review", "not_found"]
    page = lambda t, a, u, r=False, **k: val(S.page_status(lit("song"), arr("jo moe"), lit(t), arr(a), lit(u), lit(r), **k))
    assert [page("song", "jo", "/A/B/"), page("song", "ann", "/A/B/"), page("x", "jo", "/A/B/"), page("song", "jo", ""), page("song", "jo", "/x/", True)] == ["matched", "review", "review", "review", "rejected"]
    assert [page("song", "jo", u, cached=True, two_parts=lit(p)) for u, p in (("/A/B/", True), ("/A/", False), ("", False))] == ["matched", "rejected", "rejected"]
    assert val(S.loose_page(lit("song"), lit("song by jo moe"), arr("jo", "jo moe"), lit("text"), lit(True))) and not val(S.loose_page(lit("song"), lit("song"), arr("jo"), lit("jo"), lit(True)))
    assert val(S.year_equal(lit("1999"), lit("1999-02"))) == 1.0 and val(S.year_equal(lit(None).cast("string"), lit("1999"))) == 0.0
