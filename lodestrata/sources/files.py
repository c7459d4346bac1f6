"""File sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestrata.functions import wall_clock
from lodestrata.session import path_exists

# Declared layout of the assessment export; `asmed` is JSON text.
ASSESSMENT_SCHEMA = (
    "id_asesmen STRING, id_kunjungan STRING, nama STRING, asmed STRING, jenis_asmed STRING,"
    " waktu_input TIMESTAMP_NTZ, user_input STRING, waktu_hapus TIMESTAMP_NTZ"
)


def _timed(rows: DataFrame) -> DataFrame:
    """(value, file_time): the time is the file's, so reading again gives the same."""
    time = wall_clock(F.col("_metadata.file_modification_time"))
    return rows.select("value", time.alias("file_time"))


def read_documents(spark: SparkSession, path: str, timed: bool = False) -> DataFrame:
    """One row per file, the whole file in ``value``. A missing path is no rows."""
    if not path_exists(spark, path):
        extra = ", file_time timestamp_ntz" if timed else ""
        return spark.createDataFrame([], f"value string{extra}")
    rows = spark.read.option("ignoreMissingFiles", True).text(path, wholetext=True)
    return _timed(rows) if timed else rows.select("value")


def read_document_stream(
    spark: SparkSession, path: str, whole: bool = True, timed: bool = False
) -> DataFrame:
    """The same as a stream; ``whole=False`` takes one JSON document per line."""
    rows = spark.readStream.text(path, wholetext=whole)
    return _timed(rows) if timed else rows.select("value")


def read_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Job bodies queued as JSON lines, as a stream.

    Run it with ``trigger(availableNow=True)``: the run ends when the queue is
    empty, and the checkpoint remembers what was taken.
    """
    return read_document_stream(spark, path, whole=False).filter(F.trim("value") != "")


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Song catalogue (CSV with header, or parquet); all columns as they come.

    Columns are strings, so a sheet with extra columns needs no schema here.
    """
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return spark.read.option("header", True).option("multiLine", True).csv(path)


def catalogue_songs(
    catalogue: DataFrame,
    title: str = "SONG TITLE",
    code: str = "CODE",
    artist: str = "ORIGINAL ARTIST",
) -> DataFrame:
    """(song, song_code, original_artist); an absent artist column is ''."""
    original = F.col(f"`{artist}`") if artist in catalogue.columns else F.lit("")
    return catalogue.select(
        F.coalesce(F.col(f"`{title}`").cast("string"), F.lit("")).alias("song"),
        F.coalesce(F.col(f"`{code}`").cast("string"), F.lit("")).alias("song_code"),
        F.coalesce(original.cast("string"), F.lit("")).alias("original_artist"),
    )


def read_delimited(
    spark: SparkSession, path: str, schema: str = ASSESSMENT_SCHEMA, sep: str = ";"
) -> DataFrame:
    """Delimited file with quoted JSON (doubled quotes) and an optional BOM."""
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", True)
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss[.SSS]")
        .csv(path)
    )


def string_or_object(document: Column | str, path: str) -> tuple[Column, Column]:
    """A JSON field that is text in some rows and an object in others.

    Returns (text, object as VARIANT); at most one is not null.
    """
    doc = F.col(document) if isinstance(document, str) else document
    field = F.try_variant_get(F.try_parse_json(doc), path, "variant")
    is_object = F.schema_of_variant(field).startswith("OBJECT")
    text = F.when(~is_object, F.try_variant_get(F.try_parse_json(doc), path, "string"))
    return text, F.when(is_object, field)


def column_subset(df: DataFrame, columns: list[str]) -> DataFrame:
    """Chosen columns, NaN turned into null."""
    floating = {n for n, t in df.dtypes if t in ("double", "float")}
    return df.select(
        *[
            F.when(~F.isnan(c), F.col(c)).alias(c) if c in floating else F.col(c)
            for c in columns
        ]
    )
