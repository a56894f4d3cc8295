"""Packing, mixing and languages."""

import bisect
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from crateloom.llm import languages as G
from crateloom.llm import mixing as X
from crateloom.llm import packing as P
from crateloom.llm.tokens import TOKENIZER


def best_fit(sizes, capacity):
    gaps, n = [], 0
    for s in sorted(sizes, reverse=True):
        i = bisect.bisect_left(gaps, s)
        gap = gaps.pop(i) if i < len(gaps) else capacity
        n += gap == capacity
        if gap > s:
            bisect.insort(gaps, gap - s)
    return n


def test_sweep_equals_sequential_best_fit():
    rnd = random.Random(4)
    for _ in range(200):
        capacity = rnd.randint(3, 60)
        sizes = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 250))]
        assert P.sweep(Counter(sizes), capacity)[1] == best_fit(sizes, capacity)


def test_pack(spark):
    rnd = random.Random(6)
    sizes = {k: rnd.choice([0, 3, 3, 3, rnd.randint(1, 40)]) for k in range(500)}
    counts = spark.createDataFrame(list(sizes.items()), "doc_id long, n_tokens long")
    caps = spark.createDataFrame([("c", 16)], "capacity_name string, capacity_tokens int")
    rows = P.pack(counts, caps).collect()
    got, fill = Counter(), Counter()
    for r in rows:
        got[r.doc_id] += r.size
        fill[r.container_id] += r.size
    assert all(got[k] == n for k, n in sizes.items()) and len({r.doc_id for r in rows}) == 500
    assert max(fill.values()) <= 16 and all(sizes[r.doc_id] > 16 for r in rows if r.piece_no > 0)
    items = [p for n in sizes.values() for p in ([16] * (n // 16) + ([n % 16] if n % 16 else []))]
    assert len([c for c, n in fill.items() if n]) == best_fit(items, 16)


def test_many_empty_texts_share_bounded_containers(spark):
    counts = spark.createDataFrame([(k, 0 if k else 5) for k in range(101)], "doc_id long, n_tokens long")
    caps = spark.createDataFrame([("c", 16)], "capacity_name string, capacity_tokens int")
    got = Counter(r.container_id for r in P.pack(counts, caps).collect())
    assert sum(got.values()) == 101 and max(got.values()) <= 17


def test_mix(spark):
    rnd = random.Random(7)
    docs = [(k, rnd.choice("aaaaaaab"), rnd.randint(0, 90)) for k in range(3000)] + [(9001, "c", 10), (9002, None, 10), (9003, "", 4)]
    targets = spark.createDataFrame([("m", "a", 0.6, 1), ("m", "b", 0.4, 3), ("n", "a", 0.9, 2), ("n", "zz", 0.1, 2)], "mix_name string, source string, target_share double, max_repeats int").collect()
    hashed = X.hashed(spark.createDataFrame(docs, "doc_id long, source string, n_tokens long"))
    rows = X.draw(hashed, X.thresholds(hashed, targets)).collect()
    drawn = Counter()
    for r in rows:
        drawn[r.mix_name, r.source] += r.n_tokens * r.repeats
    total = sum(drawn[k] for k in drawn if k[0] == "m")
    assert abs(drawn["m", "a"] / total - 0.6) < 0.005 and {k for k in drawn} == {("m", "a"), ("m", "b"), ("n", "a")}
    assert max(r.repeats for r in rows if r.source == "b") == 3 and max(r.repeats for r in rows if r.source == "a" and r.mix_name == "m") == 1
    assert len({(r.mix_name, r.doc_id) for r in rows}) == len(rows)
    small = X.draw(hashed, X.thresholds(hashed, targets, total_tokens=2000)).where("mix_name = 'm' and source = 'a'")
    assert {r.doc_id for r in small.collect()} <= {r.doc_id for r in rows if r.mix_name == "m" and r.source == "a"}


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists() or not Path(TOKENIZER).exists(), reason="no test tables here")
def test_shares_of_the_test_tables(spark):
    rows = X.p8_shares(spark, "/root/testdata/sf0.01").collect()
    assert rows and all(abs(r.actual_share - r.target_share) < 0.01 and r.most_repeats <= r.max_repeats for r in rows)


def test_tokens_match_the_tokenizer(spark):
    if not Path(TOKENIZER).exists():
        pytest.skip("no tokenizer file here")
    import tiktoken  # noqa: F401

    from crateloom.llm.tokens import count_tokens, encoder

    texts = ["Hello, world", "", None, "naïve 東京 " * 50, "<|endoftext|>"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs, ["doc_id"]).collect()}
    assert got == {k: len(encoder(TOKENIZER).encode_ordinary(t or "")) for k, t in enumerate(texts)}


TEXTS = {
    "en": ["The record was made in a small room near the harbour.", "Nobody knew who had played the second part.", "They moved to another town and never came back.", "We listened to the tape twice that evening."],
    "de": ["Die Platte wurde in einem kleinen Zimmer am Hafen gemacht.", "Niemand wusste, wer die zweite Stimme gespielt hatte.", "Sie zogen in eine andere Stadt und kamen nie zurück.", "Wir haben das Band an diesem Abend zweimal gehört."],
}


@pytest.fixture(scope="module")
def trees():
    return G.Trees({lang: [s.lower() for s in own] * 3 for lang, own in TEXTS.items()})


def test_costs_are_prediction_by_partial_matching(trees):
    """The table look-ups equal a direct count of contexts."""
    import math

    blob = b"".join(G.PAD + s.lower().encode() + b" " for s in TEXTS["de"] * 3)
    seen = Counter()
    for i in range(G.DEPTH, len(blob)):
        for k in range(G.DEPTH + 1):
            seen[blob[i - k : i], blob[i]] += 1

    def direct(context, symbol):
        bits = 0.0
        for k in range(G.DEPTH, -1, -1):
            c = context[len(context) - k :]
            own = {s: n for (x, s), n in seen.items() if x == c}
            if symbol in own:
                return bits + math.log2((sum(own.values()) + len(own)) / own[symbol])
            if own:
                bits += math.log2((sum(own.values()) + len(own)) / len(own))
        return bits + 8.0

    import numpy as np

    text = G.PAD + "wir haben the zqx".encode()
    bits = trees.bits(G._codes(np.frombuffer(text, np.uint8)))[:, trees.langs.index("de")]
    want = [direct(text[i - G.DEPTH : i], text[i]) for i in range(G.DEPTH, len(text))]
    assert bits == pytest.approx(want, rel=1e-4)


def test_passages(trees):
    mixed = G.masked("We listened to the record twice that evening. Niemand wusste, wer die zweite Platte gemacht hatte.")
    found = trees.passages([mixed, "", G.masked("NOBODY KNEW WHO HAD PLAYED THE TAPE TWICE.")])
    assert [p[0] for p in found[0]] == ["en", "de"] and found[1] == [] and [p[0] for p in found[2]] == ["en"]


def test_masks_and_labels():
    assert G.masked('<p>He played "La Luna Azul" &amp; left.</p>\n1. Some Song (3:55)\n2) Other (4:01)') == "he played left."
    assert [G.label_code(x) for x in ("en-US", "Deutsch", "PT", "português", "xx", "", None, "und", " ger ")] == ["en", "de", "pt", "pt", None, None, None, None, "de"]


def test_labels_come_from_the_table_of_languages(spark):
    languages = spark.createDataFrame([("fi", "Finnish"), ("en", "English"), (None, "x")], "lang string, lang_name string")
    known = G.labels(languages)
    rows = spark.createDataFrame([(x,) for x in ("FI", " finnish ", "fi-FI", "Deutsch", "en_US", "xx", "", None)], "lang string")
    assert [r[0] for r in rows.select(G.label(F.col("lang"), known)).collect()] == ["fi", "fi", "fi", "de", "en", None, None, None]


def test_a_language_without_labelled_sentences_is_named(spark):
    docs = spark.createDataFrame([(k, t, lang) for lang, own in TEXTS.items() for k, t in enumerate(own * 3)], "doc_id long, text string, lang string")
    with pytest.warns(UserWarning, match="fi"):
        assert G.train(docs, ["de", "en", "fi"]).langs == ["de", "en"]


def test_short_sentences_count_by_their_evidence():
    assert G._is_text(3, 150.0, True) and G._is_text(6, 41.0, True) and not G._is_text(3, 60.0, True) and not G._is_text(6, 41.0, False)


DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="no test tables here")
def test_held_out_accuracy(spark):
    """Sentences of documents outside the sample get the language of their label, wrong labels aside."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id % 2 = 0")
    held = spark.read.parquet(f"{DATA}/documents.parquet").where("doc_id % 2 = 1")
    langs = sorted(r.lang for r in spark.read.parquet(f"{DATA}/languages.parquet").collect())
    found = G.passages(held, G.train(docs, langs)).where("is_text").groupBy("doc_id").agg(F.max_by("lang", "n_words").alias("found"))
    rows = held.select("doc_id", G.label(F.col("lang"), G._LABEL).alias("label")).join(found, "doc_id").where("label is not null").collect()
    assert len(rows) > 20 and sum(r.label == r.found for r in rows) / len(rows) > 0.8
