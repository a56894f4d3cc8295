import random
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from crateloom.functions import titles as TT
from crateloom.functions.similarity import ratio
from crateloom.functions.text import clean, fold_ascii, fold_unicode, visible
from crateloom.operators import frames as O
from crateloom.operators.components import components
from crateloom.plans.queries import QUERIES, SQL
from crateloom.sources import html as H
from crateloom.sources import readers, writers


def test_components(spark):
    rnd = random.Random(3)
    edges = [(k, k + 1) for k in range(100, 180)] + [(0, rnd.randrange(1, 60)) for _ in range(60)] + [(rnd.randrange(200, 240), rnd.randrange(200, 240)) for _ in range(25)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = components(spark.createDataFrame(edges, "u int, v int")).collect()
    assert {r.node: r.root for r in got} == {x: find(x) for x in parent} and len(got) == len(parent)


def test_folds():
    assert fold_ascii("Straße & Café") == "strasse and cafe"
    assert fold_unicode("L’Été – Nº1") == "l'été - nº1"
    assert visible("Ｆｕｌｌ​ width") == "Full width"
    assert ratio("abc", "abd") == pytest.approx(2 / 3) and ratio("", "a") == 0 and ratio("a", "a") == 1


def test_titles(spark):
    assert TT.title_variants("Song (Live)") == [("Song (Live)", "full")]
    assert [v for v, _ in TT.title_variants("Song (From X) - Remastered")] == ["Song (From X) - Remastered", "Song - Remastered", "Song (From X)", "Song"]
    df = spark.createDataFrame([("PT1H2M3.5S",), ("PT",), ("PT2.0005S",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(TT.iso_duration_ms(F.col("t"))).collect()] == [3723500, None, 2000, None, None]
    assert spark.range(1).select(clean(F.lit(" \tx  "))).first()[0] == "x"


def test_merge_and_lookup(spark):
    lib = spark.createDataFrame([("1", "a", ""), ("2", "b", "c")], "id string, x string, y string")
    new = spark.createDataFrame([("1", "A", "y"), ("3", "n", "m"), ("2", "", "c")], "id string, x string, y string")
    merged, cells = O.merge_cells(lib, new, "id")
    assert {tuple(r) for r in merged.collect()} == {("1", "a", "y"), ("2", "b", "c"), ("3", "n", "m")}
    assert {(r.id, r.column_name): r.outcome for r in cells.collect()} == {
        ("1", "x"): "conflict", ("1", "y"): "enriched", ("2", "x"): "preserved", ("2", "y"): "identical", ("3", "x"): "new", ("3", "y"): "new"}
    with pytest.raises(Exception, match="repeated key"):
        O.many_to_one(lib, new.union(new), ["id"]).collect()
    row = spark.createDataFrame([("[{\"id\":\"i\",\"name\":\"n\"},3]", "", ""), ("", "a, b", "A, B"), ("", "a, b", "A, B, C"), ("", "a", "A, B")], "j string, i string, n string")
    got = [[tuple(p) for p in r[0]] for r in row.select(O.parse_artists(F.col("j"), F.col("i"), F.col("n"))).collect()]
    assert got == [[("i", "n")], [("a", "A"), ("b", "B")], [], [("a", "A, B")]]


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([("1", 'say "hi", you'), ("2", "")], "id string, t string")
    writers.write_csv(df, str(tmp_path / "c.csv"))
    back = readers.read_csv(spark, str(tmp_path / "c.csv"), ["id", "t"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert readers.read_csv(spark, str(tmp_path / "none.csv"), ["id"], required=False).count() == 0
    (tmp_path / "m.json").write_text('{"a": {"x": "1"}, "b": {"x": "2"}}')
    assert {r.key: r.value.x for r in readers.read_json_map(spark, str(tmp_path / "m.json"), "struct<x:string>").collect()} == {"a": "1", "b": "2"}
    root = str(tmp_path / "lib")
    writers.commit({"t": df}, root)
    with pytest.raises(Exception):
        writers.commit({"t": df.limit(1), "bad": df.select(F.raise_error(F.lit("no")).alias("e"))}, root)
    assert writers.current(spark, root, "t").count() == 2


def test_html(spark):
    page = """<html><h1>X</h1><p>Aliases: A, B</p><table><tr><td><a href="/sample/12/x/">T &amp; U</a></td><td><a href="/Some-One/">Some One</a></td><td>1999</td><td>Drums</td></tr></table>
    <div class="trackItem"><a href="/a/b/?q=1">Song</a></div><a href="?sp=7">7</a></html>"""
    pages = spark.createDataFrame([("u", page), ("n", None), ("b", "<a href='x'")], "url string, html string")
    assert [tuple(r)[1:] for r in H.relationships(pages).collect()] == [("sampled", "T & U", "Some One", "1999", "/sample/12/x/", "Drums")]
    assert [(r.href, r.title) for r in H.listing(pages).collect()] == [("/a/b/", "Song")]
    assert pages.where("url = 'u'").select(H.max_page(F.col("html"))).first()[0] == 7
    assert H.profile(pages).where("url = 'u'").first().aliases == ["A", "B"]


TABLES_ONLY = sorted(n for n in QUERIES if not n.startswith(("p2_", "p6_", "stream_")))


@pytest.mark.parametrize("name", TABLES_ONLY)
def test_awkward_tables(spark, inputs, name):
    QUERIES[name](spark, inputs["awkward"]).collect()


DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    want = con.execute(SQL[name])
    columns = sorted(d[0] for d in want.description)
    order = [[d[0] for d in want.description].index(x) for x in columns]
    norm = lambda v: round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    wanted = sorted(repr([norm(r[k]) for k in order]) for r in want.fetchall())
    got = QUERIES[name](spark, str(DATA))
    assert sorted(got.columns) == columns
    assert sorted(repr([norm(r[x]) for x in columns]) for r in got.collect()) == wanted
