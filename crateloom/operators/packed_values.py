r"""Several values packed in one field, split by minimum description length.

A dialect is a quoting style (none, doubled quotes, JSON array) with a set of active delimiters.
Every field is parsed under each dialect that its characters allow; the length of a parse is the
code length of its values plus the cost of the dialect and its splits, and the shortest parse wins.

Value codes come from the whole corpus: the spans between delimiters are counted over all distinct
fields (map-side combined), joined with the known names and turned into code lengths. A value costs
-log2 of its share plus, unless it is a known name, its spelling divided by the number of fields
that share it (a dictionary entry is paid once). A span over delimiters is a candidate when a known
name begins as it does and holds as many delimiters; the beginnings travel as a filter of
``FILTER_BITS`` bits, whose false hits only add candidates.

The cheapest set of active delimiters is found by branch and bound over the classes that occur: a set
that is decided in part is bounded from below by the parse that may cut or keep at every undecided
delimiter. A JSON array of texts is one more dialect, priced like the others.

Null and blank fields give no value; pieces that are empty or only quotes and delimiters are not
values. A field that is one value gives one row. Malformed quotes and JSON are read literally.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateloom.runtime import materialize, spread

#: Delimiter classes. A class is active as a whole in a dialect.
DELIMITERS = {
    "comma": r"\s*[,，、]\s*",
    "semicolon": r"\s*[;；]\s*",
    "pipe": r"\s*\|\s*",
    "slash": r"\s*/\s*",
    "feat": r"\s*\(?\b(?:feat|ft|featuring)\b\.?\s+",
    "versus": r"\s+vs?\.?\s+",
    "ampersand": r"\s+&\s+",
    "plus": r"\s+\+\s+",
    "dot": r"\s+[·•]\s+",
    "times": r"\s+[x×]\s+",
    "with": r"\s+(?:with|con|com|avec|mit)\s+",
    "and": r"\s+(?:and|e|y|et|und|och|en|и)\s+",
}
_DELIMITER = re.compile("|".join(f"(?P<{k}>{v})" for k, v in DELIMITERS.items()), re.IGNORECASE)
#: Bits that an unknown value pays for holding a delimiter unsplit, and that a split costs.
KEEP_BITS = {"comma": 16, "semicolon": 20, "pipe": 20, "slash": 12, "feat": 20, "versus": 16, "ampersand": 9, "plus": 12, "dot": 16, "times": 14, "with": 12, "and": 8}
SPLIT_BITS, EMPTY_BITS, CLASS_BITS, QUOTE_BITS, LETTER_BITS, NEW_BITS = 1.0, 2.0, 2.0, 1.0, 5.0, 3.0
#: Size of the filter of the beginnings of known names that hold delimiters.
FILTER_BITS = 1 << 20
#: Characters by which known values over several pieces are looked up.
HEAD = 6


def _value(raw: str, quoted: bool) -> str:
    """The value of a raw piece: outer quotes and escapes removed in the quoting dialect."""
    raw = raw.strip()
    if quoted and len(raw) >= 2 and raw[0] == '"' and raw[-1] == '"':
        raw = raw[1:-1].replace('""', '"').replace('\\"', '"').replace("\\\\", "\\").strip()
    return raw


def _atoms(text: str, quoted: bool) -> tuple[list[tuple[int, int]], list[str]]:
    """Bounds of the pieces between all delimiters outside quotes, and the delimiters' classes."""
    pieces, classes, start, at = [], [], 0, 0
    closing = False
    while at < len(text):
        if quoted and text[at] == '"' and not text[start:at].strip():
            end = at + 1
            while end < len(text):
                if text[end] == "\\" and end + 1 < len(text):
                    end += 2
                elif text[end] == '"' and text[end + 1 : end + 2] == '"':
                    end += 2
                elif text[end] == '"':
                    break
                else:
                    end += 1
            if end < len(text):
                at = end + 1
                continue
        m = _DELIMITER.match(text, at)
        if m and m.end() > at:
            pieces.append((start, at))
            classes.append(m.lastgroup)
            closing |= m.lastgroup == "feat" and "(" in m.group()
            start = at = m.end()
        elif closing and text[at] == ")" and not text[at + 1 :].strip():
            pieces.append((start, at))
            return pieces, classes
        else:
            at += 1
    pieces.append((start, len(text)))
    return pieces, classes


def _json_values(text: str) -> list[str] | None:
    if not text.startswith("["):
        return None
    try:
        parsed = json.loads(text)
    except ValueError:
        return None
    if isinstance(parsed, list) and all(isinstance(x, str) for x in parsed):
        return [x.strip() for x in parsed if x.strip()]
    return None


def _modes(text: str) -> list[bool]:
    return [True, False] if '"' in text else [False]


def _slot(atom: str, width: int) -> int:
    return zlib.crc32(f"{width} {atom}".encode("utf-8", "replace")) % FILTER_BITS


def spans(text: str, widths, starts=None) -> set[str]:
    """Candidate values in every quoting dialect: single pieces, and spans of as many delimiters as known names hold.

    ``widths`` are the numbers of delimiters, or the greatest one; ``starts`` limits these spans to those that begin
    as a known name of that number of delimiters does.
    """
    widths = range(1, widths + 1) if isinstance(widths, int) else widths
    out = set(_json_values(text) or ())
    for quoted in _modes(text):
        pieces, _ = _atoms(text, quoted)
        for i, (a, end) in enumerate(pieces):
            first = text[a:end].strip()
            ends = [end] + [pieces[i + w][1] for w in widths if i + w < len(pieces) and (starts is None or starts[_slot(first, w)])]
            out.update(v for b in ends if (v := _value(text[a:b], quoted)))
    return out


def _cost(value: str, bits: dict[str, float], kept: list[str], unit: float) -> float:
    known = bits.get(value)
    if known is not None:
        return known
    return unit + NEW_BITS + LETTER_BITS * len(value) + sum(KEEP_BITS[k] for k in kept)


class _Field:
    """One field in one quoting dialect: its pieces, and the known values that end at each of them."""

    def __init__(self, text: str, quoted: bool, bits: dict[str, float], unit: float, widest: int):
        self.text, self.quoted, self.bits, self.unit = text, quoted, bits, unit
        self.pieces, self.classes = _atoms(text, quoted)
        values = [_value(text[a:b], quoted) for a, b in self.pieces]
        self.values = values
        #: For every end the known values as (first piece, cost, value).
        self.known: list[list[tuple[int, float, str]]] = [[] for _ in range(len(self.pieces) + 1)]
        for i, value in enumerate(values):
            if value in bits:
                self.known[i + 1].append((i, bits[value], value))
        # Values over several pieces are found by their first characters.
        lengths: dict[str, set[int]] = {}
        for value in bits:
            lengths.setdefault(value[:HEAD], set()).add(len(value))
        ends = {b: j for j, (_, b) in enumerate(self.pieces, 1)}
        if self.pieces:
            ends[len(text[: self.pieces[-1][1]].rstrip())] = len(self.pieces)
        for i, (a, b) in enumerate(self.pieces):
            a += len(text[a:b]) - len(text[a:b].lstrip())
            near = {n for k in range(1, HEAD + 1) for n in lengths.get(text[a : a + k], ()) if k == HEAD or n == k}
            for n in near:
                j = ends.get(a + n)
                if j is not None and i + 1 < j <= i + 1 + widest and (value := text[a : a + n]) in bits:
                    self.known[j].append((i, bits[value], value))
        #: What a piece adds at least to the spelling of an unknown value.
        self.letters = [LETTER_BITS * len(text[a:b].replace('"', "").replace("\\", "").strip()) for a, b in self.pieces]

    def bound(self, state: dict[str, bool]) -> float:
        """The least that any set costs that agrees with ``state``; classes that are not in it are open."""
        n, inf = len(self.pieces), math.inf
        cut, run = [0.0] + [inf] * n, inf  # at a cut; within an unknown value
        for j in range(1, n + 1):
            before = cut[j - 1]
            fee = SPLIT_BITS * (j > 1)
            if j > 1 and state.get(self.classes[j - 2]) is True:
                run = inf  # an unknown value ends at an active delimiter
            run = min(run + (KEEP_BITS[self.classes[j - 2]] if j > 1 else 0.0), before + fee + self.unit + NEW_BITS) + self.letters[j - 1]
            if j < n and state.get(self.classes[j - 1]) is False:
                continue
            best = min(run, before + fee + EMPTY_BITS if not self.values[j - 1] else inf)
            for i, cost, _ in self.known[j]:
                best = min(best, cut[i] + cost + SPLIT_BITS * (i > 0))
            cut[j] = best
        return cut[n] + CLASS_BITS * sum(state.values()) + QUOTE_BITS * self.quoted

    def parse(self, active: frozenset) -> tuple[float, list[str]]:
        """Shortest parse under one dialect; several pieces may join over an active delimiter only into a known value."""
        n, text = len(self.pieces), self.text
        cut = [k in active for k in self.classes]
        best: list[tuple[float, int, str] | None] = [(0.0, 0, "")]
        last = 0  # the last active cut before the piece at hand
        for j in range(1, n + 1):
            if j > 1 and cut[j - 2]:
                last = j - 1
            if j < n and not cut[j - 1]:
                best.append(None)
                continue
            value = self.values[j - 1] if last == j - 1 else _value(text[self.pieces[last][0] : self.pieces[j - 1][1]], self.quoted)
            cost = _cost(value, self.bits, self.classes[last : j - 1], self.unit) if value else EMPTY_BITS
            options = [(best[last][0] + cost + SPLIT_BITS * (last > 0), last, value)]
            options += [(best[i][0] + c + SPLIT_BITS * (i > 0), i, v) for i, c, v in self.known[j] if best[i] is not None]
            best.append(min(options))
        values, j = [], n
        while j > 0:
            _, i, value = best[j]
            if value:
                values.append(value)
            j = i
        return best[-1][0] + CLASS_BITS * len(active) + QUOTE_BITS * self.quoted, values[::-1]


def cheapest(text: str, bits: dict[str, float], widest: int, unit: float) -> list[str]:
    """Parse one field with its cheapest dialect; ties go to fewer values, then to the lesser ones."""
    best: tuple[float, int, list[str]] = (math.inf, 0, [])
    listed = _json_values(text)
    if listed is not None:
        cost = sum(_cost(v, bits, [], unit) for v in listed) + SPLIT_BITS * max(0, len(listed) - 1) + QUOTE_BITS
        best = (cost, len(listed), listed)
    for quoted in _modes(text):
        field = _Field(text, quoted, bits, unit, widest)
        order = [k for k, _ in Counter(field.classes).most_common()]
        stack: list[tuple[float, dict[str, bool]]] = [(0.0, {})]
        while stack:
            bound, state = stack.pop()
            if bound > best[0] + 1e-9:
                continue
            if len(state) == len(order):
                cost, values = field.parse(frozenset(k for k, on in state.items() if on))
                best = min(best, (cost, len(values), values))
                continue
            children = [state | {order[len(state)]: on} for on in (False, True)]
            if len(children[0]) < len(order):
                stack += sorted(((field.bound(c), c) for c in children), key=lambda x: -x[0])
            else:
                stack += [(bound, c) for c in children]
    return best[2]


def _starts(names: DataFrame) -> tuple[list[int], bytearray]:
    """The numbers of delimiters in known names, and the filter of the beginnings of names that have any."""

    def slots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = set()
            for name in b["value"]:
                pieces, classes = _atoms(name, False)
                if classes:
                    out |= {("slot", _slot(name[pieces[0][0] : pieces[0][1]].strip(), len(classes))), ("width", len(classes))}
            yield pd.DataFrame(sorted(out), columns=["what", "n"])

    starts, widths = bytearray(FILTER_BITS), []
    # At most FILTER_BITS rows and one for each number of delimiters, whatever the number of names.
    for r in names.mapInPandas(slots, "what string, n int").distinct().toLocalIterator():
        if r.what == "slot":
            starts[r.n] = 1
        else:
            widths.append(r.n)
    return sorted(widths), starts


def split_values(fields: DataFrame, known: DataFrame) -> DataFrame:
    """One row per value of every field.

    ``fields``: key columns and ``packed``; ``known``: ``name``, values that are one whatever they hold.
    Returns the key columns with ``position`` from 1, ``value`` and ``n_values``.
    """
    texts = materialize(
        fields.select(F.col("packed").alias("text")).where(F.trim("text") != "").distinct()
        .withColumn("text_id", F.md5("text")),
        even=True,
    )
    names = materialize(known.select(F.trim("name").alias("value")).where(F.col("value") != "").distinct())

    widths, starts = _starts(names)
    widest = max(widths, default=0)
    sent = fields.sparkSession.sparkContext.broadcast(starts)

    def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, v) for i, t in zip(b["text_id"], b["text"]) for v in spans(t, widths, sent.value)]
            yield pd.DataFrame(rows, columns=["text_id", "value"])

    cand = materialize(texts.mapInPandas(candidates, "text_id string, value string"))
    used = cand.groupBy("value").agg(F.count("*").alias("n"))
    total = max(1, cand.count())
    unit = math.log2(total + 1)
    codes = (
        used.join(names.withColumn("is_known", F.lit(True)), "value", "left")
        .where(F.col("is_known") | (F.col("n") > 1))
        .select(
            "value",
            (F.lit(unit) - F.log2(F.col("n"))
             + F.when(F.col("is_known"), 0.0).otherwise(F.lit(NEW_BITS) + F.lit(LETTER_BITS) * F.length("value") / F.col("n"))
             ).alias("bits"),
        )
    )
    priced = (
        cand.join(codes, "value").groupBy("text_id")
        .agg(F.collect_list("value").alias("names"), F.collect_list("bits").alias("codes"))
    )

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [
                cheapest(t, {} if n is None else dict(zip(n, c)), widest, unit)
                for t, n, c in zip(b["text"], b["names"], b["codes"])
            ]
            yield pd.DataFrame({"text_id": b["text_id"], "values": out})

    priced_texts = texts.join(priced, "text_id", "left").select("text_id", "text", "names", "codes")
    parsed = materialize(spread(priced_texts).mapInPandas(parse, "text_id string, values array<string>"))
    return (
        fields.withColumn("text_id", F.md5("packed")).join(parsed, "text_id")
        .select(*[c for c in fields.columns if c != "packed"], F.posexplode("values").alias("position", "value"),
                F.size("values").alias("n_values"))
        .withColumn("position", F.col("position") + 1)
    )
