"""Text normal forms. Column functions stay in the JVM; those that need Unicode tables use Arrow."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters without a glyph of their own.
IGNORABLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0"
_IGNORABLE = re.compile(f"[{IGNORABLE}]")
_SPACE = re.compile(r"\s+")


def clean(c: Column) -> Column:
    """Null becomes '', outer white space of any kind goes."""
    return F.coalesce(F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", ""), F.lit(""))


def collapse(c: Column) -> Column:
    """``clean`` with inner runs of white space as one blank."""
    return F.trim(F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"(?U)\s+", " "))


def nonblank(c: Column) -> Column:
    """The cleaned text, or null where nothing is left."""
    return F.nullif(clean(c), F.lit(""))


def strip_marks(text: str) -> str:
    return "".join(ch for ch in unicodedata.normalize("NFKD", text) if not unicodedata.combining(ch))


@lru_cache(maxsize=200_000)
def fold_words(text: str) -> str:
    """Accents and case removed, everything but letters and digits as single blanks."""
    return " ".join(re.findall(r"[^\W_]+", strip_marks(_IGNORABLE.sub("", text)).casefold()))


@lru_cache(maxsize=200_000)
def fold_ascii(text: str) -> str:
    """NFKD without marks, casefold, '&' as ' and ', only [a-z0-9] kept."""
    text = strip_marks(text).casefold().replace("&", " and ")
    return _SPACE.sub(" ", re.sub(r"[^a-z0-9\s]", " ", text)).strip()


@lru_cache(maxsize=200_000)
def fold_unicode(text: str) -> str:
    """NFC, casefold, straight quotes and dashes, only word characters, blanks, ' and - kept."""
    text = unicodedata.normalize("NFC", text).casefold()
    text = text.translate(str.maketrans({"‘": "'", "’": "'", "–": "-", "—": "-"}))
    return _SPACE.sub(" ", re.sub(r"[^\w\s'-]", "", text)).strip()


@lru_cache(maxsize=200_000)
def fold_identity(text: str) -> str:
    """NFKD without marks, casefold, non-word runs as one blank."""
    return re.sub(r"\W+", " ", strip_marks(text).casefold()).strip()


def visible(text: str) -> str:
    """Compatibility form without ignorable characters, white space as single blanks."""
    return _SPACE.sub(" ", unicodedata.normalize("NFKC", _IGNORABLE.sub("", text))).strip()


def _mapped(fn):
    @F.pandas_udf(T.StringType())
    def udf(values: pd.Series) -> pd.Series:
        return values.map(lambda v: "" if v is None else fn(v))

    return udf


fold_words_udf = _mapped(fold_words)
fold_ascii_udf = _mapped(fold_ascii)
fold_unicode_udf = _mapped(fold_unicode)
fold_identity_udf = _mapped(fold_identity)


def text_or_blank(c: Column) -> Column:
    """Null becomes '', nothing else changes."""
    return F.coalesce(c.cast("string"), F.lit(""))


def truthy_text(c: Column) -> Column:
    """The cleaned text of a value, '' for what counts as false: null, 0, false and ''."""
    return F.when(clean(c).isin("0", "0.0", "false", "False"), "").otherwise(clean(c))


@lru_cache(maxsize=200_000)
def fold_descriptor(text: str) -> str:
    """NFKD without marks, casefold, everything but word characters and blanks as a blank."""
    return _SPACE.sub(" ", re.sub(r"[^\w\s]+", " ", strip_marks(text).casefold())).strip()


@lru_cache(maxsize=200_000)
def fold_ascii_lower(text: str) -> str:
    """``fold_ascii`` with plain lower case, so a sharp s goes instead of becoming two letters."""
    text = strip_marks(text).lower().replace("&", " and ")
    return _SPACE.sub(" ", re.sub(r"[^a-z0-9\s]", " ", text)).strip()


fold_descriptor_udf = _mapped(fold_descriptor)
fold_ascii_lower_udf = _mapped(fold_ascii_lower)
