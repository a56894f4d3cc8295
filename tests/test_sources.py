"""Sources, sinks, pages and stream states."""

import hashlib

import pytest
from pyspark.sql import functions as F

from crateloom.plans import stream_queries as Q
from crateloom.sources import html as H
from crateloom.sources import readers, writers
from crateloom.streaming import flows
from tests import tables
from tests.tables import day


def test_json_maps_come_back(spark, tmp_path):
    df = spark.createDataFrame([("a", "1", None), ("b", 'x"y', "")], "id string, x string, y string")
    writers.write_json_map(df, "id", str(tmp_path / "m"))
    writers.write_json_map(df, "id", str(tmp_path / "m"))  # over itself
    got = readers.read_json_map(spark, str(tmp_path / "m"), "struct<x:string,y:string>").select("key", "value.*")
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in df.collect()}
    (tmp_path / "a.json").write_text('{"jo": "jo-moe", "ann": ["a", "b"], "x": ""}')
    assert {r.key: r["values"] for r in readers.read_alias_map(spark, str(tmp_path / "a.json")).collect()} == {"jo": ["jo-moe"], "ann": ["a", "b"], "x": []}
    assert readers.read_alias_map(spark, str(tmp_path / "none.json")).count() == 0


def test_csv_readers(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,n,t\n1,2.5,NA\n2,,None\n3,1,x\n")
    got = readers.read_csv_inferred(spark, str(tmp_path / "t.csv")).orderBy("id").collect()
    assert [(r.n, r.t) for r in got] == [(2.5, ""), (None, ""), (1.0, "x")]
    (tmp_path / "m.csv").write_text("url,status\n/A/B,old\n/C/,x\n/A//B/?q=1,new\n")
    assert {(r.url_key, r.status) for r in readers.read_manifest(spark, str(tmp_path / "m.csv"), ["url", "status"], "url").collect()} == {("https://pages.example/A/B/", "new"), ("https://pages.example/C/", "x")}


def test_api_objects(spark):
    track = '{"id":"t","name":"N","uri":"u","duration_ms":5,"external_ids":{"isrc":"I"},"external_urls":{"spotify":"s"},"artists":[{"id":"a","name":"A"},{"id":"b","name":"B"}],"album":{"id":"l","name":"L","release_date":"1999","images":[{"url":"i"}]}}'
    row = readers.flatten_tracks(spark.createDataFrame([(track,), ("{}",), ("x",)], "value string")).collect()
    assert [(r.spotify_track_id, r.artist_names, r.album_image_url, r.isrc) for r in row] == [("t", "A, B", "i", "I")]
    page = spark.createDataFrame([('{"items":[{"track":' + track + '},{"track":null}]}',)], "value string")
    assert readers.flatten_playlist(page).count() == 1 and readers.flatten_playlist(page, old=True).columns[:3] == ["spotify_track_id", "title", "artist_names"]
    artist = readers.flatten_artists(spark.createDataFrame([('{"id":"a","name":" A ","popularity":7,"images":[]}',)], "value string")).first()
    assert (artist.spotify_artist_name, artist.popularity, artist.image_url, artist.genres) == ("A", 7, None, [])


def test_evidence(spark, tmp_path):
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "p.html").write_bytes(b"page")
    sha = hashlib.sha256(b"page").hexdigest()
    schema = "evidence_type string, source_url string, sha256 string, bytes int, relative_path string"
    index = spark.createDataFrame([("html", "u", sha, 4, "p.html"), ("html", "v", sha, 5, "p.html"), ("html", "w", sha, 4, "../p.html"), ("html", "x", sha, 4, "none.html")], schema)
    files = spark.read.format("binaryFile").load(str(tmp_path / "e"))
    assert {r.source_url: r.ok for r in readers.verified(readers.open_index(index), files, str(tmp_path / "e")).collect()} == {"u": True, "v": False, "w": False, "x": False}
    with pytest.raises(ValueError, match="extra"):
        readers.open_index(index.withColumn("extra", F.lit("")))
    with pytest.raises(ValueError, match="no rows"):
        readers.open_index(index.limit(0))


def test_commits_survive_failures(spark, tmp_path):
    root, df = str(tmp_path / "lib"), spark.createDataFrame([("1", None), ("2", "x")], "id string, t string")
    assert writers.commit({"t": df}, root, dry_run=True) == {"t": 2} and not (tmp_path / "lib").exists()
    writers.commit({"t": df}, root, expected=0)
    with pytest.raises(ValueError, match="has changed"):
        writers.commit({"t": df}, root, expected=0)
    with pytest.raises(Exception):
        writers.commit({"t": df.limit(1), "bad": df.select(F.raise_error(F.lit("no")).alias("e"))}, root)
    assert writers.current(spark, root, "t").count() == 2
    writers.commit({"t": df.limit(1)}, root)
    assert writers.current(spark, root, "t").count() == 1 and writers.rollback(spark, root) == 1 and writers.current(spark, root, "t").count() == 2
    with pytest.raises(ValueError, match="no earlier"):
        writers.rollback(spark, root)


def test_backups_and_lists(spark, tmp_path):
    path = str(tmp_path / "c.csv")
    assert writers.backup(spark, path) is None
    writers.write_csv(spark.createDataFrame([("b",), ("a",), ("b",)], "x string"), path, [F.asc("x")])
    assert [writers.backup(spark, path), writers.backup(spark, path), writers.backup(spark, path, first_only=True)] == [path + ".bak", path + ".bak1", path + ".bak"]
    writers.write_csv(readers.read_csv(spark, path, ["x"]), path)  # what it reads
    assert readers.read_csv(spark, path, ["x"]).count() == 3
    writers.write_lists(readers.read_csv(spark, path, ["x"]), "x", str(tmp_path / "l"))
    assert [r.value for r in spark.read.text(str(tmp_path / "l")).orderBy("value").collect()] == ["a", "b", "b"] and spark.read.text(str(tmp_path / "l_unique")).count() == 2


TRACK = """<html><head><link rel="canonical" href="https://pages.example/Jo/Song/"></head><h1><meta itemprop="name" content="Song"> Song page</h1>
<div class="trackArtistNames"><a href="/Jo/">Jo</a> <a href="/album/x/">Ann</a> <a href="/Jo/">Jo</a></div>
<div class="track-credit-item"><span class="track-credit-title">Lyricist(s):</span><span itemprop="contributor"><span itemprop="name">Bo</span></span><span itemprop="contributor"><span itemprop="name"><a href="/Bo/">Bo</a></span></span></div>
<div itemprop="producer"><span itemprop="name"><a href="/Cy/">Cy</a></span></div><div itemprop="inAlbum"><span itemprop="name">Alb</span></div><span itemprop="recordLabel">Lab</span><meta itemprop="datePublished" content="1999">
<meta itemprop="duration" content="PT0H2M0S"><span itemprop="genre">Soul</span><meta itemprop="keywords" content="a, b,a"><img itemprop="thumbnailUrl" srcset="/s.jpg 1x, /l.jpg 2x"><div class="youtube-placeholder" data-id="abcdefghijk"></div>
<div><h3 class="section-header-title">Sampled in 5 songs</h3><a href="/Jo/Song/sampled/">see all</a><a href="/x/">y</a></div><a href="/cover/2/x/">c</a><a href="/sample/1/x">s</a></html>"""
DETAIL = """<div id="sampleWrap_dest"><a itemprop="url" href="/A//B"></a><span itemprop="name">B</span><div itemprop="byArtist"><meta itemprop="name" content="DJ"><meta itemprop="name" content="MC"></div><div itemprop="producer"><a href="/P/">P</a></div>
<div itemprop="inAlbum"><span itemprop="name">Al</span><span itemprop="recordLabel">La</span> 1987</div><meta itemprop="duration" content="PT3M11S"><i class="x sample-dest-timing">at 1:33</i></div><div id="sampleWrap_source"><div itemprop="byArtist"><a href="/Z/">Zed</a></div></div><b class="sample-type">Hook / Riff</b>"""


def test_track_pages(spark):
    pages = spark.createDataFrame([("u", TRACK), ("n", None)], "url string, html string")
    rows = {r.url: r for r in H.recording(pages).collect()}
    r = rows["u"]
    assert (r.title, r.canonical_url, r.artist_names, r.producers, r.album, r.label, r.release_year, r.duration_ms, r.genre, r.keywords, r.thumbnail_url, r.youtube_video_id) == (
        "Song", "https://pages.example/Jo/Song/", ["Jo", "Ann"], ["Cy"], "Alb", "Lab", "1999", 120000, "Soul", "a, b", "https://pages.example/l.jpg", "abcdefghijk")
    assert [tuple(x) for x in r.artist_profiles] == [("Jo", "https://pages.example/Jo/")]
    assert [tuple(x) for x in r.credits] == [("Bo", "written_by", "Lyricist(s)", "https://pages.example/Bo/"), ("Cy", "produced_by", "Producer", "https://pages.example/Cy/")]
    assert rows["n"].title == "" and rows["n"].duration_ms is None and rows["n"].credits == []
    assert [tuple(x) for x in H.secondary_pages(pages).collect()] == [("u", "Sampled in 5 songs", "https://pages.example/Jo/Song/sampled/", "see all")]
    one = pages.where("url = 'u'")
    assert one.select(H.relationship_links(F.col("html"))).first()[0] == ["https://pages.example/cover/2/x/", "https://pages.example/sample/1/x/"]
    assert one.select(H.first_relationship(F.col("html"))).first()[0] == "/sample/1/x"
    assert {(r.kind, r.artist) for r in H.page_artists(pages).collect()} == {("recording", "Jo"), ("credit", "Bo"), ("credit", "Cy")}
    media = spark.createDataFrame([('<meta property="og:image" content="o.jpg"><img src="i.jpg"><a href="https://youtu.be/x">v</a>',), ('<img src="i.jpg"><iframe src="https://www.youtube.com/embed/abcdefghijk">',), ("",)], "html string")
    assert [tuple(r[0]) for r in media.select(H.media(F.col("html"))).collect()] == [("o.jpg", "https://youtu.be/x"), ("i.jpg", "https://www.youtube.com/watch?v=abcdefghijk"), ("", "")]
    assert media.select(H.artwork(F.col("html"))).first()[0] == ["o.jpg", "i.jpg"]
    assert spark.createDataFrame([(bytearray(b"ab"),)], "b binary").select(H.data_uri(F.col("b"), F.lit("image/png"))).first()[0] == "data:image/png;base64,YWI="


def test_relationship_pages(spark):
    pages = spark.createDataFrame([("https://pages.example/sample/12/x/", DETAIL), ("/cover/3/", "<div id='sampleWrap_dest'></div>"), ("", "<p>nothing</p>")], "url string, html string")
    rows = {r.url: r for r in H.relationship_details(pages).collect()}
    r = rows["https://pages.example/sample/12/x/"]
    t = r.track_1
    assert (r.relationship_type, r.number, r.sample_type, r.error) == ("sampled", 12, "Hook / Riff", None)
    assert (t.name, t.artists, t.year, t.album, t.label, t.url, t.producers, t.sample_timestamp_seconds, t.duration) == ("B", ["DJ", "MC"], 1987, "Al", "La", "https://pages.example/A/B/", ["P"], 93.0, 191.0)
    assert r.track_2.artists == ["Zed"] and r.track_2.url is None
    assert (rows["/cover/3/"].error, rows[""].error) == ("no source container", "no destination container")
    assert [x.tag for x in H.structure(pages.limit(1)).orderBy("position").collect()][:3] == ["div", "a", "span"]
    table = spark.createDataFrame([("u", '<tr><td><a href="/sample/1/x/">T</a></td><td><a href="/A/">A</a><a href="/B/">B</a></td></tr>')], "url string, html string")
    assert [H.relationships(table, pick).first().related_artist for pick in ("first", "last")] == ["A", "B"]


def test_streams_go_on_after_a_stop(spark, tmp_path):
    ref = lambda k, ref_id, d: ("t", "f", str(k), ref_id, day(d))
    schema = "table_name string, field_name string, record_id string, ref_id string, loaded_at timestamp_ntz"
    parents = spark.createDataFrame([("A", day(5))], "ref_id string, first_loaded timestamp_ntz")
    gone = spark.createDataFrame([("C", day(1))], "ref_id string, deleted_at timestamp_ntz")
    root = str(tmp_path / "s")
    flows.orphan_sink(root, parents.limit(0), gone)(spark.createDataFrame([ref(1, "A", 1), ref(2, "B", 1)], schema), 0)
    after = flows.orphan_sink(root, parents, gone)  # another process, later
    for _ in range(2):  # the batch is run again
        after(spark.createDataFrame([ref(3, "A", 9), ref(4, "C", 2)], schema), 1)
    assert {(r.record_id, r.kind) for r in flows.pending_of(spark, root).collect()} == {("1", "later"), ("2", "missing"), ("4", "deleted")}
    rows = [dict(credit_id=str(k % 7), loaded_at=day(k)) for k in range(20)]
    path = tables.write(tmp_path / "t", {"credits": rows})
    assert Q.stream_first_credits(spark, path).first().n_credits == 7
