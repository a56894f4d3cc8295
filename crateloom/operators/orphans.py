"""References to records that do not exist, kept as incremental state.

``OrphanState`` holds keyed tables: the parent index (first load of every id), the pending
orphans and, with ``reopen``, the resolved references. ``step`` takes the rows of one interval of
load time: new references probe the parent index, arriving parents move waiting orphans to
``later``, deletions move them to ``deleted`` and, with ``reopen``, reopen references that were
resolved. The pending orphans are written after each step. The parent index and the deletions are only
appended: a step adds the keys of its own interval, and reads of the earlier ones what meets its references;
parts are merged when there are more than ``MOST_PARTS``. A history that is replayed lies in tables
partitioned by interval, so no step reads rows of a later one.

Null and blank references are no references. A reference without load time is compared with all
parents and reported under a null month; a parent without load time was always there. Repeated
rows count once. Empty inputs give an empty result.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateloom.functions.text import clean
from crateloom.runtime import materialize, release

#: Parts of an appended table before they become one.
MOST_PARTS = 8
ALWAYS, NEVER = "0001-01-01", "9999-12-31"
REF = ["table_name", "field_name", "record_id", "ref_id", "loaded_at"]


def at(day: str) -> Column:
    return F.lit(day).cast("timestamp_ntz")


def references(df: DataFrame, table_name: str, field: str, record_id: str) -> DataFrame:
    """Non-blank references of one field as (table_name, field_name, record_id, ref_id, loaded_at)."""
    return df.where(clean(F.col(field)) != "").select(
        F.lit(table_name).alias("table_name"),
        F.lit(field).alias("field_name"),
        F.col(record_id).cast("string").alias("record_id"),
        F.col(field).cast("string").alias("ref_id"),
        F.col("loaded_at").cast("timestamp_ntz").alias("loaded_at"),
    )


def parents(df: DataFrame, id_col: str = "recording_id") -> DataFrame:
    return df.where(clean(F.col(id_col)) != "").select(
        F.col(id_col).cast("string").alias("ref_id"),
        F.coalesce(F.col("loaded_at").cast("timestamp_ntz"), at(ALWAYS)).alias("first_loaded"),
    )


def deletions(df: DataFrame, id_col: str = "recording_id") -> DataFrame:
    return df.where(clean(F.col(id_col)) != "").select(
        F.col(id_col).cast("string").alias("ref_id"),
        F.coalesce(F.col("deleted_at").cast("timestamp_ntz"), at(ALWAYS)).alias("deleted_at"),
    )


def _appended(parts: list[DataFrame], new: DataFrame) -> list[DataFrame]:
    """The parts with a new one; too many become one, with the least moment of each key."""
    parts = [*parts, new]
    if len(parts) <= MOST_PARTS:
        return parts
    rest = [c for c in new.columns if c != "ref_id"]
    merged = materialize(reduce(DataFrame.unionByName, parts).groupBy("ref_id").agg(*[F.min(c).alias(c) for c in rest] or [F.count("*").alias("_n")]).select(*new.columns))
    release(*parts[:-1])  # the step still reads the new one
    return [merged]


class OrphanState:
    """Pending orphans and the parent index after the steps so far.

    ``reopen``: a resolved reference becomes an orphan when its parent is deleted, also if the id still has
    rows. Without it an orphan is a reference whose parent was not there when it was loaded. ``keep``: earlier
    states stay readable.
    """

    def __init__(self, reopen: bool = False, keep: bool = False) -> None:
        self.reopen, self.keep = reopen, keep
        self.index: list[DataFrame] = []
        self.gone: list[DataFrame] = []
        self.pending: DataFrame | None = None

    def step(
        self, refs: DataFrame, new_parents: DataFrame, new_deletions: DataFrame, resolved: DataFrame | None = None,
        all_parents: DataFrame | None = None, all_deletions: DataFrame | None = None,
    ) -> "OrphanState":
        """Advance by one interval. ``resolved``: earlier references that the new deletions may reopen.

        ``all_parents`` and ``all_deletions`` up to this interval stand in for the index where the caller keeps them
        as tables; else the step appends its own rows to the index.
        """
        fresh = new_parents.groupBy("ref_id").agg(F.min("first_loaded").alias("first_loaded"))
        if all_parents is None:
            fresh, died = materialize(fresh), materialize(new_deletions.select("ref_id").distinct())
            self.index, self.gone = _appended(self.index, fresh), _appended(self.gone, died)
            all_parents, all_deletions = (reduce(DataFrame.unionByName, x) for x in (self.index, self.gone))
        refs = refs.dropDuplicates(REF)
        met = all_parents.join(refs.select("ref_id").distinct(), "ref_id", "left_semi")
        index = met.groupBy("ref_id").agg(F.min("first_loaded").alias("first_loaded"))
        gone = all_deletions.select("ref_id").distinct()

        absent = F.col("first_loaded").isNull() | (F.col("first_loaded") > F.coalesce("loaded_at", at(NEVER)))
        probed = refs.join(index, "ref_id", "left")
        if self.reopen:
            again = refs.select(*REF)
            resolved = again if resolved is None else resolved.select(*REF).unionByName(again)
        waiting = (
            probed.where(absent)
            .withColumn("kind", F.when(F.col("first_loaded").isNull(), "missing").otherwise("later"))
            .select(*REF, "kind")
        )
        if self.pending is not None:
            came = fresh.select("ref_id", F.lit(True).alias("came"))
            kind = F.when((F.col("kind") == "missing") & F.col("came"), "later").otherwise(F.col("kind"))
            waiting = waiting.unionByName(
                self.pending.join(came, "ref_id", "left").withColumn("kind", kind).select(*REF, "kind")
            )
        if resolved is not None:
            reopened = resolved.join(gone, "ref_id", "left_semi").withColumn("kind", F.lit("deleted"))
            waiting = waiting.unionByName(reopened.select(*REF, "kind")).dropDuplicates(REF)
        dead = gone.withColumn("dead", F.lit(True))
        pending = materialize(
            waiting.join(dead, "ref_id", "left")
            .withColumn("kind", F.when(F.col("dead"), "deleted").otherwise(F.col("kind")))
            .select(*REF, "kind")
        )
        if self.pending is not None and not self.keep:
            release(self.pending)
        self.pending = pending
        return self

    def report(self) -> DataFrame:
        """One row per orphan reference: table, field, month, record and kind."""
        month = F.date_format("loaded_at", "yyyy-MM").alias("load_month")
        return self.pending.select("table_name", "field_name", month, "record_id", "kind").distinct()

    def counts(self) -> DataFrame:
        """The snapshot: orphans by table, field, month and kind."""
        return self.report().groupBy("table_name", "field_name", "load_month", "kind").agg(F.count("*").alias("n_orphans"))


def months(refs: DataFrame, all_parents: DataFrame, all_deletions: DataFrame) -> list:
    """The starts of the calendar months from the second to the last of a history, empty months included."""
    moments = all_parents.select(F.col("first_loaded").alias("t")).union(refs.select("loaded_at")).union(all_deletions.select("deleted_at"))
    low, high = moments.where(F.col("t") > at(ALWAYS)).agg(*(f(F.date_trunc("month", "t")).cast("timestamp_ntz") for f in (F.min, F.max))).first()
    first, last = (0, 0) if low is None else (low.year * 12 + low.month, high.year * 12 + high.month)
    return [datetime((m - 1) // 12, (m - 1) % 12 + 1, 1) - timedelta(microseconds=1) for m in range(first + 1, last + 1)]


def replay(
    refs: DataFrame, all_parents: DataFrame, all_deletions: DataFrame, steps: int = 3, cuts: list | None = None, reopen: bool = False, keep: bool = False
):
    """Run a history through intervals of load time; yields the state after each.

    The intervals end with the moments ``cuts``, or are ``steps`` equal ones. Rows that arrive late in file
    order still fall into the interval of their load time.
    """
    if cuts is None:
        low, high = all_parents.select("first_loaded").union(refs.select("loaded_at")).agg(
            F.min(F.when(F.col("first_loaded") > at(ALWAYS), F.col("first_loaded"))), F.max("first_loaded")
        ).first()
        cuts = [] if low is None else [low + (high - low) * k / steps for k in range(1, steps)]
    ends = F.array(*[F.lit(x).cast("timestamp_ntz") for x in cuts]) if cuts else F.array().cast("array<timestamp_ntz>")

    def laid(df: DataFrame, moment: str) -> tuple[DataFrame, set[int]]:
        """The rows once as a table that is partitioned by interval, and the intervals that have any."""
        when = F.coalesce(F.col(moment), at(NEVER))
        out = materialize(df.withColumn("step", F.size(F.filter(ends, lambda e: e < when))), by=["step"])
        return out, {r.step for r in out.groupBy("step").agg(F.count("*").alias("n")).collect()}

    (refs, with_refs), (all_parents, with_parents), (all_deletions, with_deletions) = (
        laid(refs, "loaded_at"), laid(all_parents, "first_loaded"), laid(all_deletions, "deleted_at"))
    state = OrphanState(reopen, keep)
    for k in range(len(cuts) + 1):
        # An interval without rows leaves the state as it is.
        if k in with_refs | with_parents | with_deletions or state.pending is None:
            own, upto = F.col("step") == k, F.col("step") <= k
            old = refs.where(F.col("step") < k).join(all_deletions.where(own).select("ref_id").distinct(), "ref_id", "left_semi") if k in with_deletions else None
            state.step(refs.where(own).drop("step"), all_parents.where(own), all_deletions.where(own), old if reopen else None, all_parents.where(upto), all_deletions.where(upto))
        yield state
    release(refs, all_parents, all_deletions)
