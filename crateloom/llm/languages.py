"""Document and passage languages by prediction by partial matching.

For each language a tree of byte contexts up to ``DEPTH`` is counted on a bounded sample of labelled
documents, cleaned once by its own verdicts. A byte costs its share in the longest context that knows
it, plus the escapes from the longer ones; statistics are frozen, so the cost depends on the last
``DEPTH`` bytes only and all costs are exact table look-ups, one vector of languages per byte. Words
take the sum of their bytes, and Viterbi over words with a charge for changing the language gives the
passages; a change is cheaper where a sentence ends.

A passage counts as sentences of its language from ``SURE_BITS`` bits of margin to the next language, however
short it is, or from ``MIN_BITS`` where it has the ``MIN_WORDS`` words that tell a sentence from a name or title;
both are more where it touches no sentence end, as names within a sentence do. Its confidence is the odds of
that margin. Titles in quotes, markup and track lists are masked before. Null
and empty texts, and texts without such a passage, have no language. Labels are read as the codes and names
of the table of languages, and in the writings of ``SPELLINGS``, with any region; others are no label. Labels
enter only the training. A language without a labelled sentence cannot be found; a warning names it.
"""

from __future__ import annotations

import json
import re
import unicodedata
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crateloom.functions.text import clean, strip_marks
from crateloom.runtime import materialize, spread_scan, table

#: Parameters of the sample that the trees are counted on: documents per language, longest document.
TRAIN_DOCS, TRAIN_CHARS = 300, 6000
WEEDING_BYTES, WEEDING_ROUNDS = 4, 3
DEPTH = 5
SWITCH_BITS, SWITCH_AT_END_BITS = 28.0, 12.0
MIN_WORDS, INNER_WORDS, MIN_BITS, SURE_BITS, INNER_SURE_BITS = 6, 9, 40.0, 130.0, 200.0
SLICE_BYTES = 400_000

#: Writings of language names and codes, without regions.
SPELLINGS = {
    "en": "en eng english anglais inglés inglês englisch ingles",
    "pt": "pt por portuguese português portugues portugais portugués",
    "es": "es spa spanish español espanol castellano espagnol espanhol",
    "fr": "fr fra fre french français francais francés",
    "de": "de deu ger german deutsch allemand alemán alemão",
    "it": "it ita italian italiano italien italienisch",
    "nl": "nl nld dut dutch nederlands néerlandais holländisch",
    "sv": "sv swe swedish svenska suédois schwedisch",
    "ru": "ru rus russian русский russe russisch ruso",
}
_LABEL = {name: code for code, names in SPELLINGS.items() for name in names.split()}

_QUOTED = re.compile(r'"[^"\n]{1,90}?"|“[^”“\n]{1,90}?[”“]|„[^“”\n]{1,90}?[“”]|«[^»\n]{1,90}?»|”[^”\n]{1,90}?”|»[^«\n]{1,90}?«|(?<![\w])[\'‘][^\'\n]{1,90}?[\'’](?![\w])')
_TRACK = re.compile(r"^[^\n]{0,120}\(\d{1,2}:\d\d\)[^\n\w]*$", re.M)
_MARKUP = re.compile(r"<[^<>\n]{1,80}>|&(?:[a-z]{2,8}|#\d{1,6});|https?://\S+")
_LISTED = re.compile(r"^\s*(?:\d{1,3}[.)]?|[-*•–>#]+)\s+(?=\S)", re.M)


def masked(text: str) -> str:
    """The running text: lower case, without markup, quoted titles and track lists; line breaks stay."""
    text = unicodedata.normalize("NFC", text)
    text = _MARKUP.sub(" ", re.sub(r"<(?:/p|br ?/?|/li|/h\d)>", "\n", text))
    text = _LISTED.sub("", _TRACK.sub("\n", text))
    text = re.sub(r"[^\S\n]+", " ", _QUOTED.sub(" ", text).lower())
    return re.sub(r" ?\n[\s\n]*", "\n", text).strip()


def label_code(label: str | None) -> str | None:
    """The language code that a label names in any known writing, else None."""
    text = (label or "").strip().casefold()
    return _LABEL.get(text) or _LABEL.get(re.split(r"[-_ (]", text)[0]) if text else None


def labels(languages: DataFrame) -> dict[str, str]:
    """Every writing of the languages of the table ``languages(lang, lang_name)`` with its code."""
    out = dict(_LABEL)
    for r in languages.where("lang is not null").collect():
        out |= {x.strip().casefold(): r.lang for x in (r.lang, r.lang_name) if x and x.strip()}
    return out


def label(c: Column, known: dict[str, str]) -> Column:
    """The language code that a label names, else null; a constant of some hundred writings, looked up in the JVM."""
    codes = F.from_json(F.lit(json.dumps(known)), "map<string,string>")
    text = F.lower(clean(c))
    return F.coalesce(F.try_element_at(codes, text), F.try_element_at(codes, F.split_part(F.regexp_replace(text, r"[-_ (]", "-"), F.lit("-"), F.lit(1))))


def _codes(data: np.ndarray) -> np.ndarray:
    """The last DEPTH + 1 bytes at every position from DEPTH on, as one number."""
    out = np.zeros(len(data) - DEPTH, dtype=np.uint64)
    for j in range(DEPTH + 1):
        out = (out << np.uint64(8)) | data[j : len(data) - DEPTH + j].astype(np.uint64)
    return out


PAD = b" " * DEPTH


class Trees:
    """The context trees of all languages as look-up tables per order."""

    def __init__(self, texts: dict[str, list[str]]):
        self.langs = sorted(texts)
        n = len(self.langs)
        raw: list[list[tuple[np.ndarray, np.ndarray]]] = []
        for lang in self.langs:
            blob = b"".join(PAD + t.replace("\n", " ").encode() + b" " for t in texts[lang]) or PAD + b" "
            codes = _codes(np.frombuffer(blob, dtype=np.uint8))
            raw.append([np.unique(codes & np.uint64((1 << 8 * (k + 1)) - 1), return_counts=True) for k in range(DEPTH + 1)])
        self.grams, self.costs, self.contexts, self.escapes = [], [], [], []
        for k in range(DEPTH + 1):
            grams = np.unique(np.concatenate([r[k][0] for r in raw]))
            ctx = np.unique(grams >> np.uint64(8))
            cost, esc = np.empty((len(grams), n), np.float32), np.zeros((len(ctx), n), np.float32)
            for i, r in enumerate(raw):
                g, c = r[k]
                own, where = np.unique(g >> np.uint64(8), return_inverse=True)
                total, kinds = np.bincount(where, weights=c), np.bincount(where)
                esc[np.searchsorted(ctx, own), i] = np.log2((total + kinds) / kinds)
                if k:
                    low = np.searchsorted(self.grams[k - 1], grams & np.uint64((1 << 8 * k) - 1))
                    cost[:, i] = self.costs[k - 1][low, i] + esc[np.searchsorted(ctx, grams >> np.uint64(8)), i]
                else:
                    cost[:, i] = esc[0, i] + 8.0
                cost[np.searchsorted(grams, g), i] = np.log2((total + kinds)[where] / c)
            self.grams.append(grams)
            self.costs.append(cost)
            self.contexts.append(ctx)
            self.escapes.append(esc)
        self.floor = self.escapes[0][0] + np.float32(8.0)

    def bits(self, codes: np.ndarray) -> np.ndarray:
        """Code lengths in every language of the bytes behind ``codes``."""
        out = np.zeros((len(codes), len(self.langs)), np.float32)
        todo = np.arange(len(codes))
        for k in range(DEPTH, -1, -1):
            if not len(todo):
                break
            gram = codes[todo] & np.uint64((1 << 8 * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(self.grams[k], gram), len(self.grams[k]) - 1)
            hit = self.grams[k][at] == gram
            out[todo[hit]] += self.costs[k][at[hit]]
            todo, ctx = todo[~hit], gram[~hit] >> np.uint64(8)
            if k and len(todo):
                at = np.minimum(np.searchsorted(self.contexts[k], ctx), len(self.contexts[k]) - 1)
                seen = self.contexts[k][at] == ctx
                out[todo[seen]] += self.escapes[k][at[seen]]
        out[todo] += self.floor
        return out

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code lengths per word, whether a sentence may end before the word, and the words per text."""
        joined = np.frombuffer(b"".join(PAD + t.encode() + b" " for t in texts) or b" ", dtype=np.uint8)
        blank = (joined == 32) | (joined == 10)
        plain = np.where(joined == 10, np.uint8(32), joined)
        ends = blank & ~np.concatenate([[True], blank[:-1]])
        word = np.concatenate([[0], np.cumsum(ends)[:-1]])
        n_words = int(ends.sum())
        sums = np.zeros((n_words + 1, len(self.langs)), np.float32)
        for a in range(DEPTH, len(plain), SLICE_BYTES):
            b = min(len(plain), a + SLICE_BYTES)
            cost = self.bits(_codes(plain[a - DEPTH : b]))
            # the blanks that only set texts apart cost nothing
            cost[blank[a:b] & blank[a - 1 : b - 1]] = 0
            first = word[a]
            starts = np.flatnonzero(np.diff(word[a:b], prepend=first - 1))
            sums[word[a:b][starts]] += np.add.reduceat(cost, starts, axis=0)
        last = joined[np.flatnonzero(ends) - 1] if n_words else joined[:0]
        line = joined[np.flatnonzero(ends)] == 10
        after = np.concatenate([[True], (np.isin(last, np.frombuffer(b".!?:;", np.uint8)) | line)[:-1]]) if n_words else last
        lengths = np.array([len(t.split()) for t in texts])
        return sums[:n_words], after, lengths

    def passages(self, texts: list[str]) -> list[list[tuple[str, int, float, bool]]]:
        """For each text its passages (language, words, margin in bits, whether an end touches a sentence's end)."""
        cost, end, lengths = self.words(texts)
        n = len(self.langs)
        offset = np.concatenate([[0], np.cumsum(lengths)])
        order = np.argsort(-lengths, kind="stable")
        active = lengths[order]
        state = np.zeros((len(texts), n), np.float32)
        back = np.zeros((offset[-1], n), np.int8)
        own = np.arange(n)
        for t in range(int(active[0]) if len(active) else 0):
            live = order[: int(np.searchsorted(-active, -t, side="left"))]
            at = offset[live] + t
            if t:
                prev = state[live]
                best = prev.argmin(axis=1)
                charge = np.where(end[at], SWITCH_AT_END_BITS, SWITCH_BITS).astype(np.float32)
                switch = prev[np.arange(len(live)), best] + charge
                stay = prev <= switch[:, None]
                back[at] = np.where(stay, own, best[:, None])
                state[live] = np.where(stay, prev, switch[:, None]) + cost[at]
            else:
                state[live] = cost[at]
        path = np.zeros(offset[-1], np.int8)
        here = state.argmin(axis=1)
        for t in range((int(active[0]) if len(active) else 0) - 1, -1, -1):
            live = order[: int(np.searchsorted(-active, -t, side="left"))]
            at = offset[live] + t
            path[at] = here[live]
            here[live] = back[at, here[live]]
        out: list[list[tuple[str, int, float, bool]]] = []
        for i in range(len(texts)):
            a, b = offset[i], offset[i + 1]
            found = []
            if b > a:
                cuts = a + np.concatenate([[0], np.flatnonzero(np.diff(path[a:b])) + 1])
                sums = np.add.reduceat(cost[a:b], cuts - a, axis=0)
                stops = np.append(cuts[1:], b)
                for k, (s, e) in enumerate(zip(cuts, stops)):
                    lang = path[s]
                    own_sum, sums[k, lang] = float(sums[k, lang]), np.inf
                    whole = bool(end[s]) or e == b or bool(end[e])
                    found.append((self.langs[lang], int(e - s), float(sums[k].min()) - own_sum, whole))
            out.append(_joined(found))
        return out


def _is_text(n: int, margin: float, whole: bool) -> bool:
    """Whether a passage of ``n`` words is sentences and no name."""
    return margin >= (SURE_BITS if whole else INNER_SURE_BITS) or (n >= (MIN_WORDS if whole else INNER_WORDS) and margin >= MIN_BITS)


def _joined(found: list[tuple[str, int, float, bool]]) -> list[tuple[str, int, float, bool]]:
    """Passages after names have gone back to the sentence around them.

    A short or doubtful stretch between two passages of one language, or one that touches no sentence end,
    counts as words of the passage before it; margins are those of the passage's own stretches.
    """
    out: list[tuple[str, int, float, bool]] = []
    for k, (lang, n, margin, whole) in enumerate(found):
        if out:
            between = k + 1 < len(found) and found[k + 1][0] == out[-1][0]
            small = not _is_text(n, margin, whole)
            last = out[-1]
            if lang == last[0]:
                out[-1] = (lang, last[1] + n, last[2] + margin, last[3] or whole)
                continue
            if small and (between or not whole):
                out[-1] = (last[0], last[1] + n, last[2], last[3])
                continue
        out.append((lang, n, margin, whole))
    return out


def train(docs: DataFrame, langs: list[str], known: dict[str, str] = _LABEL) -> Trees:
    """Trees from at most ``TRAIN_DOCS`` documents of each label, the ones of least hash.

    Wrong labels are weeded first: joint rates of short byte strings judge every sentence, and only
    sentences of the label's own language are counted, each also without accents.
    """
    rank = Window.partitionBy("code").orderBy(F.xxhash64("doc_id"), "doc_id")
    sample = (
        docs.where(F.length("text").between(1, TRAIN_CHARS)).withColumn("code", label(F.col("lang"), known))
        .where(F.col("code").isin(langs)).withColumn("k", F.row_number().over(rank))
        .where(F.col("k") <= TRAIN_DOCS).select("code", "text").collect()
    )
    sentences: dict[str, list[str]] = {lang: [] for lang in langs}
    for code, text in sorted(map(tuple, sample)):
        sentences[code] += [s for s in re.split(r"(?<=[.!?])\s|\n", masked(text)) if len(s.split()) > 3]
    good = sentences
    for _ in range(WEEDING_ROUNDS):
        verdict = _rates(good)
        good = {code: [s for s, v in zip(own, verdict(own)) if v == code] for code, own in sentences.items()}
    mute = sorted(code for code, own in good.items() if not own)
    if mute and len(mute) < len(good):
        warnings.warn(f"no labelled sentences for {', '.join(mute)}")
        good = {code: own for code, own in good.items() if own}
    return Trees({code: own + [x for s in own if (x := plain(s)) != s] for code, own in good.items()})


def _rates(texts: dict[str, list[str]]):
    """A judge of sentences by the joint rates of their short byte strings in every language.

    Conditional shares would not do here: a stray sentence is as certain within its own contexts.
    """
    langs, mask = sorted(texts), np.uint64((1 << 8 * WEEDING_BYTES) - 1)

    def codes(t: str) -> np.ndarray:
        return _codes(np.frombuffer(PAD + t.encode() + b" ", dtype=np.uint8)) & mask

    counts = [np.unique(np.concatenate([codes(t) for t in texts[lang]] or [codes("")]), return_counts=True) for lang in langs]
    grams = np.unique(np.concatenate([g for g, _ in counts]))
    bits = np.empty((len(grams), len(langs)))
    for i, (g, n) in enumerate(counts):
        row = np.full(len(grams), 0.1)
        row[np.searchsorted(grams, g)] += n
        bits[:, i] = np.log2(row / row.sum())

    def judge(own: list[str]) -> list[str]:
        out = []
        for t in own:
            c = codes(t)
            at = np.minimum(np.searchsorted(grams, c), len(grams) - 1)
            out.append(langs[int(bits[at[grams[at] == c]].sum(axis=0).argmax())])
        return out

    return judge


def plain(text: str) -> str:
    """A Latin text without its accents; other scripts keep their letters."""
    return "".join(strip_marks(ch) if unicodedata.name(ch, "").startswith("LATIN") else ch for ch in text)


PASSAGES = "doc_id long, passage_no int, lang string, n_words int, margin_bits double, is_text boolean"


def passages(docs: DataFrame, trees: Trees) -> DataFrame:
    """The passages of ``docs(doc_id, text)`` in order."""
    sent = docs.sparkSession.sparkContext.broadcast(trees)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trees = sent.value
        for b in batches:
            texts = [masked(t or "") for t in b["text"]]
            ids, rows, start, size = b["doc_id"].tolist(), [], 0, 0
            for i in range(len(texts) + 1):
                if i == len(texts) or size > 2_000_000:
                    for doc, found in zip(ids[start:i], trees.passages(texts[start:i])):
                        rows += [
                            (doc, k, lang, n, margin, _is_text(n, margin, whole))
                            for k, (lang, n, margin, whole) in enumerate(found)
                        ]
                    start, size = i, 0
                if i < len(texts):
                    size += len(texts[i])
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in PASSAGES.split(", ")])

    return spread_scan(docs.select("doc_id", "text")).mapInPandas(judge, PASSAGES)


def _passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    languages = table(spark, sf_dir, "languages")
    langs = sorted(r.lang for r in languages.where("lang is not null").collect())
    return passages(docs, train(docs, langs, labels(languages)))


def p9_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage with its language and confidence."""
    confidence = F.round(1 / (1 + F.pow(F.lit(2.0), -F.least("margin_bits", F.lit(60.0)))), 6)
    return _passages(spark, sf_dir).where("is_text").select("doc_id", "passage_no", "lang", "n_words", confidence.alias("confidence"))


def p9_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's main language, its share of the words as confidence, and whether the label agrees."""
    by_lang = _passages(spark, sf_dir).where("is_text").groupBy("doc_id", "lang").agg(F.sum("n_words").alias("n"))
    main = by_lang.groupBy("doc_id").agg(
        F.max_by("lang", F.struct("n", "lang")).alias("found_lang"), (F.max("n") / F.sum("n")).alias("share"),
        F.count("*").alias("n_langs"),
    )
    known = labels(table(spark, sf_dir, "languages"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", label(F.col("lang"), known).alias("label"))
    return docs.join(main, "doc_id", "left").select(
        "doc_id", F.col("lang").alias("given_label"), "found_lang", F.round("share", 4).alias("confidence"), "n_langs",
        F.coalesce(F.col("label") == F.col("found_lang"), F.lit(False)).alias("label_agrees"),
    )


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = materialize(_passages(spark, sf_dir).where("is_text").select("doc_id", "lang").distinct())
    count = found.groupBy("doc_id").agg(F.count("*").alias("n_langs"))
    known = labels(table(spark, sf_dir, "languages"))
    given = table(spark, sf_dir, "documents").select("doc_id", label(F.col("lang"), known).alias("label"))
    named = found.select("doc_id", F.col("lang").alias("label"), F.lit(True).alias("right"))
    cases = given.join(count, "doc_id").join(named, ["doc_id", "label"], "left").where("n_langs > 1 or right is null")
    return found.join(cases.select("doc_id"), "doc_id").select("doc_id", "lang")


QUERIES = {"p9_found": p9_found, "p9_documents": p9_documents, "p9_passages": p9_passages}
SQL: dict[str, str] = {}
