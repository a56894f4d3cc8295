"""Sources: CSV, JSON maps, archived pages and playlist exports as typed frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crateloom.functions.text import clean


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def read_csv(spark: SparkSession, path: str, columns: list[str], required: bool = True) -> DataFrame:
    """All columns as text, empty fields as ''. A missing optional file is an empty frame of the schema."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    if not required and not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.csv(path, header=True, schema=schema, quote='"', escape='"', multiLine=True, enforceSchema=False).fillna("")


#: Texts that an inferring reader takes for missing.
MISSING = ["", "NA", "N/A", "NaN", "nan", "None", "null", "NULL", "n/a", "#N/A", "<NA>"]


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Columns typed by their values; texts that stand for missing become ''."""
    df = spark.read.csv(path, header=True, inferSchema=True, quote='"', escape='"', multiLine=True)
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(F.col(c).isin(MISSING), "").otherwise(F.coalesce(c, F.lit(""))) for c in texts})


def read_manifest(spark: SparkSession, path: str, columns: list[str], url: str) -> DataFrame:
    """A CSV manifest with one row per address key: the last one, at the place where the key was first seen."""
    from crateloom.functions.keys import url_absolute
    from crateloom.operators.frames import last_wins

    rows = read_csv(spark, path, columns, required=False).withColumn("position", F.monotonically_increasing_id())
    return last_wins(rows.withColumn("url_key", url_absolute(F.col(url))).where("url_key <> ''"), ["url_key"], "position")


def read_alias_map(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object whose values are a text or an array of texts, as (key, values)."""
    if not exists(spark, path):
        return spark.createDataFrame([], "key string, values array<string>")
    raw = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m")).select(F.explode("m").alias("key", "v"))
    listed = F.from_json("v", "array<string>")
    return raw.select("key", F.when(F.col("v").startswith("["), listed).when(clean(F.col("v")) == "", F.array().cast("array<string>")).otherwise(F.array("v")).alias("values"))


def open_index(index: DataFrame) -> DataFrame:
    """The evidence index, which has exactly its five columns and at least one row."""
    want = {"evidence_type", "source_url", "sha256", "bytes", "relative_path"}
    if set(index.columns) != want:
        raise ValueError(f"columns of the index: {sorted(set(index.columns) ^ want)}")
    if index.isEmpty():
        raise ValueError("the index has no rows")
    return index


def read_json_map(spark: SparkSession, path: str, value: str, strict: bool = False) -> DataFrame:
    """A JSON object of records as (key, value). Another shape is empty, or fails when strict."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"key string, value {value}")
    if spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(
        spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)).isDirectory():  # a folder of lines, as ``write_json_map`` leaves it
        lines = spark.read.schema(f"key string, value {value}").json(path)
        return lines.withColumn("key", F.coalesce("key", F.raise_error(F.lit("a line without key")))) if strict else lines.where("key is not null")
    parsed = F.from_json("value", f"map<string,{value}>")
    whole = spark.read.text(path, wholetext=True).select(parsed.alias("m"))
    if strict:
        whole = whole.select(F.coalesce("m", F.raise_error(F.lit("not a JSON object of records"))).alias("m"))
    return whole.select(F.explode("m").alias("key", "value"))


def read_pages(spark: SparkSession, root: str) -> DataFrame:
    """(path, html) of all archived pages below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{html,htm}").load(root)
    return files.select("path", F.decode("content", "UTF-8").alias("html"))


_TRACK = "struct<id:string,uri:string,name:string,duration_ms:bigint,external_ids:struct<isrc:string>,external_urls:struct<spotify:string>,artists:array<struct<id:string,name:string,uri:string>>,album:struct<id:string,name:string,release_date:string,release_date_precision:string,label:string,images:array<struct<url:string>>>>"


def _track_columns() -> list:
    col = lambda c, n: clean(F.col(c)).alias(n)
    return [
        F.col("id").alias("spotify_track_id"), F.col("uri").alias("spotify_uri"), col("external_urls.spotify", "spotify_url"), col("external_ids.isrc", "isrc"), F.col("name").alias("title"),
        F.concat_ws(", ", F.col("artists.name")).alias("artist_names"), F.concat_ws(", ", F.col("artists.id")).alias("artist_ids"), F.to_json("artists").alias("artists_json"), F.col("album.name").alias("album_name"),
        col("album.id", "album_id"), F.col("album.release_date").alias("album_release_date"), col("album.release_date_precision", "album_release_precision"),
        F.try_element_at(F.col("album.images.url"), F.lit(1)).alias("album_image_url"), col("album.label", "album_label"), "duration_ms",
    ]


def flatten_playlist(pages: DataFrame, value: str = "value", old: bool = False) -> DataFrame:
    """Rows of saved playlist pages (JSON text) as flat track rows; ``old``: the shorter shape of earlier exports."""
    tracks = pages.select(F.explode(F.from_json(value, f"struct<items:array<struct<track:{_TRACK}>>>")["items"]).alias("i")).select("i.track.*")
    out = tracks.where("id is not null").select(*_track_columns())
    return out.select("spotify_track_id", "title", "artist_names", "album_name", "album_release_date", "duration_ms", "spotify_url") if old else out


def flatten_tracks(objects: DataFrame, value: str = "value") -> DataFrame:
    """Saved track objects (JSON text) as flat rows."""
    return objects.select(F.from_json(value, _TRACK).alias("t")).select("t.*").where("id is not null").select(*_track_columns())


def flatten_artists(objects: DataFrame, value: str = "value") -> DataFrame:
    """Saved artist objects (JSON text) as flat rows."""
    shape = "struct<id:string,name:string,uri:string,popularity:int,genres:array<string>,followers:struct<total:bigint>,external_urls:struct<spotify:string>,images:array<struct<url:string>>>"
    return objects.select(F.from_json(value, shape).alias("a")).select("a.*").where("id is not null").select(
        F.col("id").alias("spotify_artist_id"), clean(F.col("name")).alias("spotify_artist_name"), clean(F.col("uri")).alias("spotify_artist_uri"), clean(F.col("external_urls.spotify")).alias("spotify_artist_url"),
        F.coalesce("popularity", F.lit(0)).alias("popularity"), F.coalesce("followers.total", F.lit(0).cast("bigint")).alias("followers"), F.coalesce("genres", F.array().cast("array<string>")).alias("genres"),
        F.try_element_at(F.col("images.url"), F.lit(1)).alias("image_url"))


def verified(index: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """Evidence rows with ``ok``: the file is there, inside the root, with the recorded hash and length."""
    base = root.rstrip("/") + "/"
    relative = F.regexp_replace(F.regexp_replace("path", r"^file:/+", "/"), "^" + base.replace(".", r"\\."), "")
    got = files.select(relative.alias("_p"), F.sha2("content", 256).alias("_sha"), F.length("content").alias("_len"))
    inside = ~F.col("relative_path").rlike(r"(^|/)\.\.(/|$)|^/")
    ok = inside & F.coalesce((F.col("_sha") == F.col("sha256")) & (F.col("_len") == F.col("bytes").cast("long")), F.lit(False))
    return index.join(got, F.col("relative_path") == F.col("_p"), "left").withColumn("ok", ok).drop("_p", "_sha", "_len")
