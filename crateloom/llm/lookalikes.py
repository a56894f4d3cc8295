"""One form for texts that look identical but differ in their characters.

A text is brought to its compatibility form without ignorable characters, then every token becomes
a lattice: each letter with the letters of other scripts that look the same. Viterbi picks the
likeliest path under letter trigrams, backed off to bigrams, that are counted over all texts, with a
charge for leaving a script inside a token. Texts are equal in form exactly when every token has the
same lattice, that is, the same look; which letters the form is written with is decided by the path.
Accents, case and words stay what a reader sees.

In the trigrams a letter without look-alikes counts as its script (Latin, Cyrillic, Greek or other), so
the table is bounded by the cube of the list of look-alikes, whatever the texts. Every distinct text is
counted with the number of its rows and brought to its form once.

Null stays null, an empty text or one of ignorable characters only becomes ''. Characters without
look-alikes pass unchanged. Ties go to the alternative listed first (Latin, then Cyrillic, Greek).
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crateloom.functions.text import clean, visible
from crateloom.runtime import materialize, table

#: Letters of one look, Latin first.
LOOKALIKES = [
    "aаɑα", "cсϲ", "dԁ", "eе", "gɡ", "hһ", "iіι", "jјϳ", "kκ", "lӏ", "nո", "oоοօ", "pрρ", "qԛ", "sѕ", "uυս", "vνѵ", "wԝ", "xхχ", "yуγ", "rг", "zᴢ",
    "AАΑ", "BВΒ", "CСϹ", "DᎠ", "EЕΕ", "FϜ", "GԌ", "HНΗ", "IІΙӀ", "JЈͿ", "KКΚ", "LᏞ", "MМΜ", "NΝ", "OОΟ", "PРΡ", "QԚ", "SЅ", "TТΤ", "VѴ", "WԜ", "XХΧ", "YҮΥ", "ZΖ",
]
CLASS = {ch: group for group in LOOKALIKES for ch in group}
#: Look-alikes whose compatibility form has another look; they become the first letter of their class before it.
APART = {ord(ch): group[0] for ch, group in CLASS.items() if unicodedata.normalize("NFKC", ch) not in group}
SWITCH_BITS, UNSEEN_BITS = 30.0, 16.0
#: Scripts that have look-alikes; letters of all others count as one.
SCRIPTS = {"LATIN": "L", "CYRILLIC": "C", "GREEK": "G"}
#: Rows of one look in one field of a track that a task meets with each other.
BLOCK_ROWS = 2000


@lru_cache(maxsize=100_000)
def script(ch: str) -> str:
    """The script of a letter, '' for anything else."""
    if not ch.isalpha():
        return ""
    return unicodedata.name(ch, "").split(" ")[0]


@lru_cache(maxsize=100_000)
def symbol(ch: str) -> str:
    """What a character counts as: itself where it has look-alikes, else a digit for its kind."""
    if ch in CLASS:
        return ch
    own = script(ch)
    return str(list(SCRIPTS).index(own)) if own in SCRIPTS else "3" if own else "4"


def letters(text: str) -> str:
    """The visible text with accents as letters of their own."""
    return unicodedata.normalize("NFD", visible(text.translate(APART)))


class Lattice:
    """Viterbi over look-alike letters; keeps the tokens it has solved."""

    def __init__(self, grams: dict[str, int]):
        self.bits = letter_bits(grams)
        self.solved: dict[str, str] = {}

    def token(self, token: str) -> str:
        key = "".join(CLASS.get(ch, ch)[0] for ch in token)
        known = self.solved.get(key)
        if known is None:
            known = self._best(key)
            if len(self.solved) > 200_000:
                self.solved.clear()
            self.solved[key] = known
        return known

    def _cost(self, before: str, letter: str) -> float:
        """Bits of a letter after two others, else after one, else of one never seen there."""
        found = self.bits.get(before + letter)
        if found is None:
            found = self.bits.get(before[1:] + letter)
            found = UNSEEN_BITS if found is None else min(UNSEEN_BITS, found + 2.0)
        return found

    def _best(self, key: str) -> str:
        # state: the two letters before and the script of the last letter, so accents do not hide a switch
        states = {("^^", ""): (0.0, "")}
        for ch in key:
            nxt: dict[tuple[str, str], tuple[float, str]] = {}
            for alt in CLASS.get(ch, ch):
                own, sign = script(alt), symbol(alt)
                for (last, before), (cost, path) in states.items():
                    c = cost + self._cost(last, sign)
                    if own and before and own != before:
                        c += SWITCH_BITS
                    k = (last[1] + sign, own or before)
                    if k not in nxt or c < nxt[k][0]:
                        nxt[k] = (c, path + alt)
            states = nxt
        return min(states.values(), key=lambda x: x[0])[1] if states else ""

    def text(self, text: str) -> str:
        return unicodedata.normalize("NFC", " ".join(self.token(t) for t in letters(text).split(" ")))


def letter_bits(grams: dict[str, int]) -> dict[str, float]:
    """Code lengths of a letter after the one or two before it, from counts of trigrams."""
    out: dict[str, float] = {}
    for width in (2, 3):
        counts: Counter = Counter()
        for gram, n in grams.items():
            counts[gram[3 - width :]] += n
        before: Counter = Counter()
        for gram, n in counts.items():
            before[gram[:-1]] += n
        out |= {gram: min(UNSEEN_BITS, math.log2(before[gram[:-1]] / n)) for gram, n in counts.items()}
    return out


def distinct_texts(texts: DataFrame) -> DataFrame:
    """Distinct non-null texts of ``texts(text)`` with the number of their rows."""
    return materialize(texts.where("text is not null").groupBy("text").agg(F.count("*").alias("n")), even=True)


def trigrams(texts: DataFrame) -> dict[str, int]:
    """Counts of letter trigrams over ``texts(text, n)``; the rows are bounded by the cube of the look-alikes."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            seen: Counter = Counter()
            for text, n in zip(b["text"], b["n"]):
                for word in letters(text).split(" "):
                    signs = "^^" + "".join(map(symbol, word))
                    for i in range(len(word)):
                        seen[signs[i : i + 3]] += n
            yield pd.DataFrame({"gram": pd.Series(list(seen), dtype=object), "n": pd.Series(list(seen.values()), dtype="int64")})

    counts = texts.select("text", "n").mapInPandas(count, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r.gram: r.n for r in counts.toLocalIterator()}


def forms(texts: DataFrame) -> DataFrame:
    """(text, form) of every row of ``distinct_texts``."""
    sent = texts.sparkSession.sparkContext.broadcast(trigrams(texts))

    def bring(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(sent.value)
        for b in batches:
            texts = b["text"].tolist()
            yield pd.DataFrame({"text": pd.Series(texts, dtype=object), "form": pd.Series([lattice.text(t) for t in texts], dtype=object)})

    return materialize(texts.select("text").mapInPandas(bring, "text string, form string"))


def _fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entry_id, spotify_track_id, field_name, raw): both texts of every entry."""
    return table(spark, sf_dir, "spotify_tracks").select(
        "entry_id", "spotify_track_id",
        F.explode(F.array(*[F.struct(F.lit(c).alias("field_name"), F.col(c).alias("raw")) for c in ("title", "artist_names")])).alias("x"),
    ).select("entry_id", "spotify_track_id", "x.*")


def p4_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry with the one form of its title and artist names."""
    entries = table(spark, sf_dir, "spotify_tracks").select("entry_id", "spotify_track_id", "title", "artist_names")
    known = forms(distinct_texts(_fields(spark, sf_dir).select(F.col("raw").alias("text"))))
    of = lambda name, form: known.select(F.col("text").alias(name), F.col("form").alias(form))
    return entries.join(of("title", "title_form"), "title", "left").join(of("artist_names", "artist_form"), "artist_names", "left").select(
        *entries.columns, "title_form", "artist_form"
    )


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = _fields(spark, sf_dir)
    texts = distinct_texts(fields.select(F.col("raw").alias("text")))
    known = forms(texts).where("form <> ''")
    # Only tracks with two texts in a field go on; minimum and maximum are combined before the shuffle.
    own = ["spotify_track_id", "field_name"]
    named = fields.where(clean(F.col("spotify_track_id")) != "").where("raw is not null")
    apart = named.groupBy(*own).agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).where("lo <> hi").select(*own)
    long = materialize(named.join(apart, own, "left_semi").join(known.withColumnRenamed("text", "raw"), "raw"))
    key = [*own, "form"]
    blocks = F.ceil(F.count("*") / F.lit(BLOCK_ROWS)).cast("int").alias("blocks")
    mixed = long.groupBy(*key).agg(F.min("raw").alias("lo"), F.max("raw").alias("hi"), blocks).where("lo <> hi").select(*key, "blocks")
    rows = materialize(long.join(mixed, key))
    # A hot look is cut into blocks on one side and copied to them on the other.
    a = rows.select(*key, F.col("entry_id").alias("entry_id_a"), F.col("raw").alias("raw_a"), F.pmod(F.xxhash64("entry_id"), F.col("blocks")).cast("int").alias("block"))
    b = rows.select(*key, "entry_id", "raw", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"))
    return (
        a.join(b, [*key, "block"]).where("entry_id_a < entry_id and raw_a <> raw")
        .select("entry_id_a", F.col("entry_id").alias("entry_id_b"), "field_name").distinct()
    )


QUERIES = {"p4_found": p4_found, "p4_forms": p4_forms}
SQL: dict[str, str] = {}
