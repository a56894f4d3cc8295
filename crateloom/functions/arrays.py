"""Lists in JSON and comma text, as JVM column expressions. Malformed JSON is no list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crateloom.functions.text import clean

FIRST_NAMES = 5


def json_elements(c: Column) -> Column:
    """The elements of a JSON array as JSON texts, [] for anything else."""
    return F.coalesce(F.from_json(F.nullif(clean(c), F.lit("")), "array<string>"), F.array().cast("array<string>"))


def json_objects(c: Column) -> Column:
    """The objects among the elements of a JSON array, as JSON texts."""
    return F.filter(json_elements(c), lambda e: e.startswith("{"))


def comma_names(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), clean), lambda v: v != "")


def object_names(c: Column) -> Column:
    """The non-blank names of the objects of a JSON array."""
    names = F.transform(json_objects(c), lambda e: clean(F.get_json_object(e, "$.name")))
    return F.filter(names, lambda v: v != "")


def names(artists_json: Column, artist_names: Column) -> Column:
    """Names of the structured list, else of the comma text."""
    listed = object_names(artists_json)
    return F.when(F.size(listed) > 0, listed).otherwise(comma_names(artist_names))


def first_names(artists_json: Column, artist_names: Column, n: int = FIRST_NAMES) -> Column:
    return F.slice(names(artists_json, artist_names), 1, n)


def parse_functions(c: Column) -> Column:
    """The sorted distinct non-blank values of a JSON list; another JSON value fails, blank is []."""
    text = clean(c)
    parsed = F.from_json(text, "array<string>")
    checked = F.when(text == "", F.array().cast("array<string>")).when(text.startswith("["), parsed).otherwise(
        F.raise_error(F.concat(F.lit("not a JSON list: "), text)).cast("array<string>")
    )
    return sorted_set(checked)


def sorted_set(values: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.transform(values, clean), lambda v: v != "")))


def serialize_functions(values: Column) -> Column:
    """Compact JSON of the sorted set, '' for none."""
    kept = sorted_set(values)
    return F.when(F.size(kept) == 0, "").otherwise(F.to_json(kept))


def credit_list(c: Column) -> Column:
    """Objects of a credit list as struct(artist, role, source_role, url); elements of other kinds are dropped."""
    return F.transform(json_objects(c), lambda e: F.from_json(e, "artist string, role string, source_role string, whosampled_url string"))
