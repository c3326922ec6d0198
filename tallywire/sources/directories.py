"""Directories of part files, read with a declared schema.

The schema is never inferred, so an empty directory is an empty table and a file
that lacks a field gives nulls. Listing, concatenating and pruning are Spark's.
A directory with one folder per batch reads like one without.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parquet_directory(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """Part files of a folder, or of several."""
    paths = [path] if isinstance(path, str) else path
    if not paths:
        return spark.createDataFrame([], schema)
    files = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(*paths)
    return files.select(*schema.names)


def json_directory(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    skip_malformed: bool = True,
    pattern: str = "*.json",
) -> DataFrame:
    """JSON lines of the files matching ``pattern``.

    With ``skip_malformed`` a line that is no object, or in which any field is of another
    type, is left out, whichever columns are used later; otherwise its fields are null
    where they can't be read. The rest of its file is kept either way, and blank lines are
    no lines. Lines are decoded here and not by the JSON reader, which looks only at the
    columns a query needs and so would keep different lines for different queries.
    """
    if not path:
        return spark.createDataFrame([], schema)
    lines = spark.read.option("pathGlobFilter", pattern).text(path)
    broken = _free_name("_broken", schema)
    rows = lines.where(F.trim("value") != "").select(F.inline(F.array(_decoded(schema, broken))))
    if skip_malformed:
        rows = rows.where(F.col(broken).isNull())
    return rows.select(*schema.names)


def _free_name(name: str, schema: T.StructType) -> str:
    while name in schema.names:
        name = f"_{name}"
    return name


def _decoded(schema: T.StructType, broken: str):
    """A line as a struct; ``broken`` has its text if any field can't be read."""
    return F.from_json("value", T.StructType([*schema.fields, T.StructField(broken, T.StringType())]),
                       {"columnNameOfCorruptRecord": broken})


# Why a line was left out.
NO_JSON, NO_OBJECT, OTHER_TYPE = "no json", "no object", "other type"


def json_lines(
    spark: SparkSession, path: str | list[str], schema: T.StructType, pattern: str = "*.json"
) -> DataFrame:
    """All lines of JSON files, kept or left out: the schema's columns, ``file, line, reject``.

    ``reject`` is null for a line that ``json_directory`` keeps; otherwise it says why it is
    left out, ``line`` is its text and the columns are null. Both outputs of a scan are one table
    with a condition each, so a caller who writes or caches it reads the files once.
    """
    if not path:
        return spark.createDataFrame([], schema).select(
            "*", *(F.lit("").alias(name) for name in ("file", "line", "reject")))
    broken = _free_name("_broken", schema)
    lines = (spark.read.option("pathGlobFilter", pattern).text(path)
             .select("value", F.col("_metadata.file_path").alias("_file")).where(F.trim("value") != ""))
    rows = lines.select("value", "_file", F.inline(F.array(_decoded(schema, broken))))
    bad = F.col(broken).isNotNull()
    kind = F.schema_of_variant(F.try_parse_json("value"))
    return rows.select(
        *(F.when(~bad, F.col(name)).alias(name) for name in schema.names),
        F.col("_file").alias("file"), F.when(bad, F.col("value")).alias("line"),
        F.when(~bad, F.lit(None)).when(kind.isNull(), NO_JSON)
        .when(kind.startswith("OBJECT"), OTHER_TYPE).otherwise(NO_OBJECT).alias("reject"))


def json_rejects(spark: SparkSession, path: str | list[str], schema: T.StructType,
                 pattern: str = "*.json") -> DataFrame:
    """The lines that ``json_directory`` leaves out: ``file, line, reject``."""
    return json_lines(spark, path, schema, pattern).where("reject is not null").select(
        "file", "line", "reject")


def day_rows(spark: SparkSession, path: str, schema: T.StructType, days: list[str] | None = None,
             fmt: str = "parquet") -> DataFrame:
    """Rows of a folder that is written by day, with their ``day``; of some days, only these are read."""
    if fmt == "json":
        # Text files have no columns of dates.
        lines = spark.read.schema("value string, day string").option("pathGlobFilter", "*.json").text(path)
        if days is not None:
            lines = lines.where(F.col("day").isin(days))
        broken = _free_name("_broken", schema)
        return (lines.where(F.trim("value") != "").select("day", F.inline(F.array(_decoded(schema, broken))))
                .where(F.col(broken).isNull()).select(*schema.names, F.col("day").cast("date").alias("day")))
    rows = spark.read.schema(T.StructType([*schema.fields, T.StructField("day", T.DateType())])).option(
        "pathGlobFilter", "*.parquet").parquet(path)
    return rows if days is None else rows.where(F.col("day").isin([date.fromisoformat(day) for day in days]))
