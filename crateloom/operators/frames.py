"""Relational operators with first-wins, last-wins, unique-match and cell-merge semantics.

Blank text is kept at the edges and never joins: keys go through ``nullif``. Where the order of rows
matters, the caller names a position column; ties on it fall to the remaining columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crateloom.functions.text import clean


def ensure_columns(df: DataFrame, columns: Sequence[str], default: str = "") -> DataFrame:
    return df.withColumns({c: F.lit(default) for c in columns if c not in df.columns})


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def key(c: str | Column) -> Column:
    """A join key: cleaned text, blank as null."""
    return F.nullif(clean(F.col(c) if isinstance(c, str) else c), F.lit(""))


def first_wins(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """The row of least position per key; the rank filter cuts groups in the map tasks already."""
    w = Window.partitionBy(*keys).orderBy(F.asc(position), *[F.asc(c) for c in df.columns if c not in (*keys, position)])
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def last_wins(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """The row of greatest position per key, at the position where the key was first seen."""
    row = F.struct(position, *[c for c in df.columns if c not in (*keys, position)])
    out = df.groupBy(*keys).agg(F.max(row).alias("_row"), F.min(position).alias("_first"))
    return out.select(*keys, F.col("_first").alias(position), *[F.col(f"_row.{c}").alias(c) for c in df.columns if c not in (*keys, position)])


def longest_wins(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """Of every key the longest text, ties to the lesser text."""
    return df.groupBy(*keys).agg(F.max_by(text, F.struct(F.length(text), F.concat(F.lit(""), F.col(text)))).alias(text))


def lookup(left: DataFrame, right: DataFrame, on: str, take: Mapping[str, str], position: str, last: bool = True) -> DataFrame:
    """Left join against one row per key of the right side: last or first wins; columns ``take`` as new names."""
    one = (last_wins if last else first_wins)(right.where(key(on).isNotNull()).select(on, position, *take), [on], position)
    build = one.select(key(on).alias("_k"), *[F.col(c).alias(n) for c, n in take.items()])
    return left.withColumn("_k", key(on)).join(build, "_k", "left").drop("_k")


def many_to_one(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join that fails where the right side repeats a key."""
    repeated = right.groupBy(*on).agg(F.count("*").alias("_n"))
    checked = right.join(
        repeated.withColumn("_ok", F.when(F.col("_n") > 1, F.raise_error(F.lit("repeated key on the one side"))).otherwise(F.lit(True))),
        list(on),
    ).where("_ok").drop("_n", "_ok")
    return left.join(checked, list(on), "left")


def unique_match(left: DataFrame, left_key: Column, right: DataFrame, right_key: Column, right_id: str) -> DataFrame:
    """Probe a key for the set of its ids: ``match_status`` resolved with ``match_id``, ambiguous or unresolved.

    Ids are counted by minimum, maximum and null-safe distinctness, never collected, so a hot key is one row.
    """
    sets = right.select(F.nullif(right_key, F.lit("")).alias("_k"), key(right_id).alias("_id")).where("_k is not null and _id is not null")
    sets = sets.groupBy("_k").agg(F.min("_id").alias("_lo"), F.max("_id").alias("_hi"))
    status = F.when(F.col("_lo").isNull(), "unresolved").when(F.col("_lo") == F.col("_hi"), "resolved").otherwise("ambiguous")
    return (
        left.withColumn("_k", F.nullif(left_key, F.lit(""))).join(sets, "_k", "left")
        .withColumn("match_status", status).withColumn("match_id", F.when(F.col("match_status") == "resolved", F.col("_lo")))
        .drop("_k", "_lo", "_hi")
    )


def ladder(left: DataFrame, rungs: Sequence[tuple[str, Column, DataFrame, Column, str]]) -> DataFrame:
    """Unique matches in order of precedence: (method, left key, right, right key, right id) per rung.

    The first rung that finds anything decides; an ambiguous earlier rung stops the row.
    """
    out = left
    for k, (_, left_key, right, right_key, right_id) in enumerate(rungs):
        out = unique_match(out, left_key, right, right_key, right_id)
        out = out.withColumnRenamed("match_status", f"_s{k}").withColumnRenamed("match_id", f"_i{k}")
    status, found, method = F.lit("unresolved"), F.lit(None).cast("string"), F.lit("")
    for k in reversed(range(len(rungs))):
        hit = F.col(f"_s{k}") != "unresolved"
        status = F.when(hit, F.col(f"_s{k}")).otherwise(status)
        found = F.when(hit, F.col(f"_i{k}")).otherwise(found)
        method = F.when(hit, F.lit(rungs[k][0])).otherwise(method)
    out = out.withColumns({"resolution_status": status, "resolved_id": found, "resolution_method": method})
    return out.drop(*[f"_{x}{k}" for k in range(len(rungs)) for x in "si"])


def fill_from(target: Column, source: Column) -> Column:
    """Keep the target unless it is blank."""
    return F.coalesce(F.nullif(clean(target), F.lit("")), F.nullif(clean(source), F.lit("")), F.lit(""))


def overlay(target: Column, source: Column) -> Column:
    """Take the source unless it is blank."""
    return fill_from(source, target)


def upsert(old: DataFrame, new: DataFrame, on: str) -> DataFrame:
    """New rows override old ones column by column, other columns and rows stay."""
    shared = [c for c in new.columns if c != on]
    o, n = old.alias("o"), new.alias("n")
    columns = [F.coalesce(f"o.{on}", f"n.{on}").alias(on)]
    for c in [c for c in old.columns if c != on] + [c for c in shared if c not in old.columns]:
        if c in shared and c in old.columns:
            columns.append(F.when(F.col(f"n.{on}").isNotNull(), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            columns.append(F.col(f"n.{c}" if c in shared else f"o.{c}").alias(c))
    return o.join(n, F.col(f"o.{on}") == F.col(f"n.{on}"), "full").select(*columns)


def merge_cells(library: DataFrame, proposed: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """Three-way cell merge by id: (merged rows, cells with their outcome).

    Outcome per cell: new, identical, enriched (library blank), preserved (proposal blank) or conflict, in
    which case the library keeps its value. Both sides must have unique ids.
    """
    columns = [c for c in library.columns if c != on]
    both = library.alias("l").join(proposed.alias("p"), F.col(f"l.{on}") == F.col(f"p.{on}"), "full")
    is_new, absent = F.col(f"l.{on}").isNull(), F.col(f"p.{on}").isNull()

    def outcome(c: str) -> Column:
        left, right = clean(F.col(f"l.{c}")), clean(F.col(f"p.{c}"))
        return (
            F.when(is_new, "new").when(absent | (left == right), "identical").when(left == "", "enriched")
            .when(right == "", "preserved").otherwise("conflict")
        )

    ident = F.coalesce(f"l.{on}", f"p.{on}").alias(on)
    merged = both.select(ident, *[
        F.when(is_new, clean(F.col(f"p.{c}"))).otherwise(fill_from(F.col(f"l.{c}"), F.col(f"p.{c}"))).alias(c) for c in columns
    ])
    cells = both.select(ident, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), outcome(c).alias("outcome")) for c in columns
    ])).alias("c")).select(on, "c.*")
    return merged, cells


def resume(work: DataFrame, state: DataFrame, on: Sequence[str]) -> DataFrame:
    """The work that the state table does not list as done."""
    return work.join(state.select(*on).distinct(), list(on), "left_anti")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def ordered_unique(values: Column) -> Column:
    """Order-keeping distinct of an array, ignoring case, blanks dropped."""
    kept = F.filter(values, lambda v: clean(v) != "")
    return F.aggregate(
        kept, F.array().cast("array<string>"),
        lambda acc, v: F.when(F.exists(acc, lambda a: F.lower(a) == F.lower(v)), acc).otherwise(F.concat(acc, F.array(v))),
    )


def split_list(c: Column) -> Column:
    """Values of comma, semicolon, pipe or ' / ' separated text, trimmed, blanks dropped."""
    return F.filter(F.transform(F.split(clean(c), r"\s*[,;|]\s*|\s+/\s+"), clean), lambda v: v != "")


def parse_artists(artists_json: Column, ids: Column, names: Column) -> Column:
    """array<struct(id,name)>: JSON objects, else the single id, else ids and names of equal number, else nothing.

    Comma borders are never guessed: unequal numbers give no pairs.
    """
    text = F.from_json(F.nullif(clean(artists_json), F.lit("")), "array<string>")
    objects = F.transform(F.filter(text, lambda e: e.startswith("{")), lambda e: F.from_json(e, "id string, name string"))
    id_list, name_list = split_list(ids), split_list(names)
    single = F.array(F.struct(F.element_at(F.when(F.size(id_list) == 1, id_list), 1).alias("id"), clean(names).alias("name")))
    zipped = F.zip_with(id_list, name_list, lambda i, n: F.struct(i.alias("id"), n.alias("name")))
    empty = F.array().cast("array<struct<id:string,name:string>>")
    return (
        F.when(F.size(objects) > 0, objects).when(F.size(id_list) == 1, single)
        .when((F.size(id_list) == F.size(name_list)) & (F.size(id_list) > 0), zipped).otherwise(empty)
    )
