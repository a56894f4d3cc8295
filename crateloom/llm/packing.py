"""Filling fixed-capacity containers by bulk-synchronous best fit.

Documents are range-sorted by size over the cluster and ranked within their size. Since sizes and
gaps are whole numbers up to the capacity, the successor sweeps run on the histogram of sizes and the
histogram of gaps, both bounded by the capacity whatever the number of documents: from the largest
size down, each superstep matches all documents of one size with the smallest gaps that hold them,
resolves who goes where by rank, updates the gaps and repeats; what fits nowhere opens containers.
The outcome is a short list of rank intervals, from which every document reads its container on its
own. It equals sequential best fit with decreasing sizes.

A text larger than the capacity gives full pieces, each a container of its own, and one remainder;
no other text is cut. Texts without tokens take no room; ``capacity`` of them at most share a container, those
beyond that get containers of their own, so contents stay bounded. Capacities must be positive. Ties in size go by a hash of the document id, then the id and the piece.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crateloom.llm.tokens import TOKENIZER, count_tokens
from crateloom.runtime import materialize, parallelism, table


def sweep(sizes: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best fit on a histogram: intervals (size, first rank, end rank, first container, items per container)."""
    gaps: dict[int, list[tuple[int, int]]] = {}
    levels: list[int] = []
    opened, out = 0, []

    def free(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(levels, gap)
            gaps[gap].append((first, count))

    for size in sorted((s for s, n in sizes.items() if n and s > 0), reverse=True):
        rank, left = 0, sizes[size]
        while left:
            at = bisect.bisect_left(levels, size)
            if at < len(levels):
                gap = levels[at]
                first, count = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    levels.pop(at)
            else:
                gap = capacity
                first, count = opened, -(-left // (capacity // size))
                opened += count
            per = gap // size
            full = min(count, left // per)
            if full:
                out.append((size, rank, rank + full * per, first, per))
                rank, left = rank + full * per, left - full * per
                free(gap - per * size, first, full)
                first, count = first + full, count - full
            if left and left < per and count:
                out.append((size, rank, rank + left, first, per))
                free(gap - left * size, first, 1)
                rank, left, first, count = rank + left, 0, first + 1, count - 1
            free(gap, first, count)
    return out, opened


def pieces(counts: DataFrame, capacities: DataFrame) -> DataFrame:
    """(capacity_name, capacity, doc_id, piece_no, token_from, size): whole texts, or cuts of larger ones."""
    listed = [F.struct(F.lit(r.capacity_name).alias("capacity_name"), F.lit(r.capacity_tokens).alias("capacity_tokens"))
              for r in capacities.where("capacity_tokens > 0").collect()]
    both = counts.withColumn("c", F.explode(F.array(*listed))).select("doc_id", "n_tokens", "c.*")
    last = "cast(greatest(ceil(n_tokens / capacity_tokens), 1) as int) - 1"
    return both.select(
        "capacity_name", F.col("capacity_tokens").alias("capacity"), "doc_id", "n_tokens",
        F.explode(F.expr(f"sequence(0, {last})")).alias("piece_no"),
    ).select(
        "capacity_name", "capacity", "doc_id", "piece_no",
        (F.col("piece_no") * F.col("capacity")).cast("long").alias("token_from"),
        F.least(F.col("capacity").cast("long"), F.col("n_tokens") - F.col("piece_no") * F.col("capacity")).cast("int").alias("size"),
    )


def pack(counts: DataFrame, capacities: DataFrame) -> DataFrame:
    """``pieces`` with their ``container_id``."""
    spark = counts.sparkSession
    order = ["capacity_name", "size", "h", "doc_id", "piece_no"]
    ranked = pieces(counts, capacities).withColumn("h", F.xxhash64("doc_id"))
    placed = materialize(
        ranked.repartitionByRange(parallelism(spark), *order).sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).drop("h")
    )
    runs = placed.groupBy("capacity_name", "capacity", "size", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    # Bounded by the capacities and the number of partitions: a size spans more than one row only at borders.
    histogram = sorted(map(tuple, runs.collect()))
    before: dict[tuple[str, int], int] = {}
    offsets, sizes, capacity_of = {}, {}, {}
    for name, capacity, size, part, first, n in histogram:
        seen = before.get((name, size), 0)
        offsets[name, size, part] = seen - first
        before[name, size] = seen + n
        sizes.setdefault(name, {})[size] = seen + n
        capacity_of[name] = capacity
    plans = {}
    for name in sizes:
        intervals, opened = sweep(sizes[name], capacity_of[name])
        by_size: dict[int, list] = {}
        for size, lo, hi, start, per in intervals:
            by_size.setdefault(size, []).append((lo, start, per))
        plans[name] = ({s: np.array(sorted(v), dtype=np.int64).T for s, v in by_size.items()}, max(1, opened))
    sent = spark.sparkContext.broadcast((offsets, plans))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        offsets, plans = sent.value
        for b in batches:
            out = np.zeros(len(b), dtype=np.int64)
            for (name, size, part), rows in b.groupby(["capacity_name", "size", "part"]).indices.items():
                rank = b["at"].to_numpy()[rows] + offsets[name, size, part]
                by_size, opened = plans[name]
                if size <= 0:
                    # the first round goes over the open containers, later ones open new containers
                    limit = int(b["capacity"].to_numpy()[rows[0]])
                    out[rows] = np.where(rank < opened * limit, rank % opened, opened + (rank - opened * limit) // limit)
                    continue
                low, start, per = by_size[size]
                k = np.searchsorted(low, rank, side="right") - 1
                out[rows] = start[k] + (rank - low[k]) // per[k]
            yield b.drop(columns=["part", "at"]).assign(container_id=out)

    schema = "capacity_name string, capacity int, doc_id long, piece_no int, token_from long, size int, container_id long"
    return placed.mapInPandas(assign, schema)


def _packed(spark: SparkSession, sf_dir: str, path: str = TOKENIZER) -> DataFrame:
    counts = materialize(count_tokens(table(spark, sf_dir, "documents"), ["doc_id"], path))
    return pack(counts, table(spark, sf_dir, "pack_capacities"))


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per container: its contents, the tokens used and the tokens left unused."""
    item = F.struct("doc_id", "piece_no", "token_from", F.col("size").alias("n_tokens"))
    return (
        _packed(spark, sf_dir).groupBy("capacity_name", "container_id")
        .agg(F.sort_array(F.collect_list(item)).alias("contents"), F.sum("size").alias("used_tokens"), F.first("capacity").alias("capacity"))
        .select("capacity_name", "container_id", "contents", "used_tokens", (F.col("capacity") - F.col("used_tokens")).alias("unused_tokens"))
    )


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per capacity: containers, tokens, share of the space that stays unused, and the least possible containers."""
    used = _packed(spark, sf_dir).groupBy("capacity_name", "capacity", "container_id").agg(F.sum("size").alias("used"))
    n, tokens = F.count("*"), F.sum("used")
    return used.groupBy("capacity_name", "capacity").agg(
        n.alias("n_containers"), tokens.alias("n_tokens"),
        F.round(1 - tokens / (n * F.col("capacity")), 6).alias("unused_share"),
        F.ceil(tokens / F.col("capacity")).alias("least_containers"),
    )


QUERIES = {"p7_containers": p7_containers, "p7_fill": p7_fill}
SQL: dict[str, str] = {}
