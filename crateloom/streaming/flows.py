"""Streams: windowed counts with a watermark, first-wins deduplication, and orphan state per micro-batch.

Sinks and states are folders below a checkpoint root, so a stopped stream resumes where it was. ``available_now``
runs a stream over the files that are there and returns the result as a frame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crateloom.operators.orphans import OrphanState
from crateloom.runtime import scratch_root, table


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder as a stream of its files, be it one file or a folder of parts."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parquet*")


def available_now(stream: DataFrame) -> DataFrame:
    """Run an append stream over all present input into a Parquet sink."""
    spark = stream.sparkSession
    root = f"{scratch_root(spark)}/crateloom-stream-{uuid.uuid4().hex}"
    running = (
        stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state")
        .outputMode("append").trigger(availableNow=True).start()
    )
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


def _numbered(stream: DataFrame) -> T.StructType:
    """The schema with the number of the batch."""
    return T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])


def latest(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Run a stream in update mode over all present input; the last row of each key, closed or still open."""
    spark = stream.sparkSession
    root = f"{scratch_root(spark)}/crateloom-stream-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{root}/out/{number}")

    running = (
        stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{root}/state")
        .outputMode("update").trigger(availableNow=True).start()
    )
    running.awaitTermination()
    keep(spark.createDataFrame([], stream.schema), -1)  # a table without files runs no batch
    given = spark.read.schema(_numbered(stream)).parquet(f"{root}/out/*")
    rest = [c for c in stream.columns if c not in keys]
    return given.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("last")).select(*keys, *[F.col(f"last.{c}").alias(c) for c in rest])


def window_counts(events: DataFrame, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Counts and sums by window and type; in append mode given out once the watermark has passed the window."""
    return (
        events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value").withWatermark("ts", late)
        .groupBy(F.window("ts", width).alias("w"), "event_type")
        .agg(F.count("*").alias("n_events"), F.round(F.sum("value"), 4).alias("total"))
        .select(F.col("w.start").alias("window_start"), "event_type", "n_events", "total")
    )


def first_seen(rows: DataFrame, keys: list[str], at: str, late: str = "30 days") -> DataFrame:
    """Drop repeated keys within the watermark; a key that comes back after ``late`` counts as new."""
    return rows.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def first_ever(stream: DataFrame, keys: list[str], root: str | None = None) -> DataFrame:
    """Rows of keys that no earlier batch had, over all present input, without a horizon.

    The keys seen lie as a table below ``root``, one folder per batch, so memory does not grow and a stopped
    stream goes on where it was; a batch that is run again replaces its own folder. Of equal keys in a batch one row stays.
    """
    spark = stream.sparkSession
    root = root or f"{scratch_root(spark)}/crateloom-stream-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, number: int) -> None:
        done = spark.read.schema(_numbered(stream)).parquet(f"{root}/out/*").where(F.col("batch") < number)
        new = batch.dropDuplicates(keys).join(done.select(*keys), keys, "left_anti")
        new.select(*stream.columns, F.lit(number).cast("long").alias("batch")).write.mode("overwrite").parquet(f"{root}/out/{number}")

    spark.createDataFrame([], _numbered(stream)).write.mode("overwrite").parquet(f"{root}/out/-1")
    running = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    running.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out/*")


PENDING = "table_name string, field_name string, record_id string, ref_id string, loaded_at timestamp_ntz, kind string"


def orphan_sink(root: str, parents: DataFrame, deletions: DataFrame):
    """A ``foreachBatch`` function that keeps the pending orphans as tables below ``root``, one folder per batch.

    A batch starts from the folder of the batch before it, so a stream that is stopped or fails goes on with all earlier
    references, and a batch that is run again replaces its own folder. Parents are read for the batch's references and the
    waiting ones only.
    """

    def advance(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = pending_of(spark, root, number)
        state = OrphanState()
        state.pending = before
        wanted = batch.select("ref_id") if before is None else batch.select("ref_id").union(before.select("ref_id"))
        known = parents.join(wanted.distinct(), "ref_id", "left_semi")
        state.keep = True
        state.step(batch, known, deletions, all_parents=known, all_deletions=deletions)
        state.pending.write.mode("overwrite").parquet(f"{root}/pending/{number}")

    return advance


def pending_of(spark: SparkSession, root: str, before: int | None = None) -> DataFrame | None:
    """The pending orphans after the last batch, or after the last one before ``before``; None at the start."""
    of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    folder = of(f"{root}/pending")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [int(f.getPath().getName()) for f in fs.listStatus(folder)] if fs.exists(folder) else []
    names = [n for n in names if before is None or n < before]
    return spark.read.schema(PENDING).parquet(f"{root}/pending/{max(names)}") if names else None
