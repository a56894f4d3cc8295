"""Queries p2: artist names packed in one field."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crateloom.operators.packed_values import split_values
from crateloom.runtime import table


def _values(spark: SparkSession, sf_dir: str) -> DataFrame:
    tracks = table(spark, sf_dir, "spotify_tracks").select(
        F.lit("spotify_tracks").alias("table_name"), F.col("entry_id").cast("string").alias("row_key"),
        F.col("artist_names").alias("packed"),
    )
    parsed = table(spark, sf_dir, "artist_catalog_recordings_parsed").select(
        F.lit("artist_catalog_recordings_parsed").alias("table_name"), F.col("recording_id").alias("row_key"),
        F.col("whosampled_artist_names").alias("packed"),
    )
    known = table(spark, sf_dir, "artists").select(F.col("canonical_name").alias("name"))
    return split_values(tracks.unionByName(parsed), known)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _values(spark, sf_dir).where(F.col("n_values") > 1)
        .select("table_name", "row_key", F.col("position").alias("name_position"), F.col("value").alias("name_value"))
        .distinct()
    )


def p2_name_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In how many fields of each table a name stands, alone and with others."""
    return _values(spark, sf_dir).groupBy("table_name", F.col("value").alias("name_value")).agg(
        F.count(F.when(F.col("n_values") == 1, 1)).alias("n_alone"),
        F.count(F.when(F.col("n_values") > 1, 1)).alias("n_packed"),
    )


QUERIES = {"p2_found": p2_found, "p2_name_counts": p2_name_counts}
SQL: dict[str, str] = {}
