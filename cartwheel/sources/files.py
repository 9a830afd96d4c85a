"""Batch and stream readers over files, and the name → path catalog."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.schemas import BEHAVIOUR_CSV, change_schema, ddl, landed_click_schema

# year / month / day folders below a landing folder; our own landing job has a folder per batch below the day
LANDED_JSON = "*/*/*/{*.json,*.txt,*/*.txt}"
LANDING_ZONE = "Asia/Ho_Chi_Minh"
# column of a line that could not be read
BROKEN_LINE = "broken_line"


def missing_ok(read: Callable[[], DataFrame]) -> DataFrame | None:
    """None instead of an error when the source path is not there yet."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def change_stream(spark: SparkSession, table: str, landing: str, files_per_trigger: int | None = None,
                  versions: tuple[str, ...] = ()) -> DataFrame:
    """Change events of a table from its dated JSON landing folder; lines that do not fit the schema are in ``BROKEN_LINE``.

    ``versions`` are later versions of the table's columns: lines of all versions are read as one schema that holds them.
    A value that this schema does not hold, as when a producer turns a number into text, makes its line a broken one.
    """
    schema = T.StructType([*change_schema(table, *versions).fields, T.StructField(BROKEN_LINE, T.StringType())])
    reader = (spark.readStream.schema(schema).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", BROKEN_LINE))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(f"{landing}/{LANDED_JSON}")


def unknown_columns(spark: SparkSession, table: str, landing: str, versions: tuple[str, ...] = ()) -> DataFrame:
    """(column, lines) of row images that no version of the table has: what a reader would leave out without a word."""
    known = change_schema(table, *versions)["after"].dataType.names
    line = F.get_json_object("value", "$.after")
    names = spark.read.text(f"{landing}/{LANDED_JSON}").select(F.explode(F.json_object_keys(line)).alias("column"))
    return names.filter(~F.col("column").isin(known)).groupBy("column").agg(F.count("*").alias("lines"))


def landed_click_stream(spark: SparkSession, path: str, files_per_trigger: int = 100,
                        schema: T.StructType | None = None) -> DataFrame:
    """Event files as a stream; ``schema`` is that of the landed clicks unless given."""
    return (
        spark.readStream.schema(schema or landed_click_schema())
        .option("maxFilesPerTrigger", files_per_trigger).option("basePath", path).parquet(path)
    )


def fx_documents(spark: SparkSession, landing: str, files: str = LANDED_JSON) -> DataFrame:
    """FX documents, one pretty-printed JSON object per file; the rates object has a column per currency. If there are
    documents that could not be parsed, their text is in ``BROKEN_LINE``, a column that is not there otherwise."""
    reader = (spark.read.option("multiLine", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", BROKEN_LINE))
    documents = reader.json(f"{landing}/{files}")
    if documents.columns == [BROKEN_LINE]:  # all are broken; Spark does not read that column alone
        documents = reader.schema(f"base_code STRING, {BROKEN_LINE} STRING").json(f"{landing}/{files}")
    return documents


def behaviour_csv(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """Chosen columns of the historical CSV, lines with too many or too few fields skipped. ``file`` is the file name.

    The parser's own column pruning is off: with it a bad line would not be noticed. The columns
    not chosen still end at the scan.
    """
    schema = ddl(BEHAVIOUR_CSV)
    columns = columns or schema.fieldNames()
    rows = spark.read.schema(schema).option("header", True).option("mode", "DROPMALFORMED").option(
        "columnPruning", False).csv(paths)
    return rows.select(*columns, F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"))


def with_landing_parts(df: DataFrame, ts: Column, zone: str = "UTC") -> DataFrame:
    """Add the year / month / day folder columns of a landing time, read in ``zone``."""
    local = F.from_utc_timestamp(ts, zone)
    return (
        df.withColumn("year", F.date_format(local, "yyyy"))
        .withColumn("month", F.date_format(local, "MM"))
        .withColumn("day", F.date_format(local, "dd"))
    )


def audited(documents: DataFrame, at: Column) -> DataFrame:
    """Add the ingestion time as ISO text in UTC."""
    return documents.withColumn("_ingested_at", F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"))


def changes_only(messages: DataFrame) -> DataFrame:
    """Feed messages without the NULL tombstones that follow deletes."""
    return messages.filter(F.col("value").isNotNull())


def land_json(df: DataFrame, path: str, per_file: int = 0) -> None:
    """Append rows with year / month / day columns as JSON lines below dated folders, at most ``per_file`` in a file if given."""
    df.write.mode("append").option("maxRecordsPerFile", per_file).partitionBy("year", "month", "day").json(path)


class Catalog:
    """Logical table name → stored path."""

    def __init__(self, spark: SparkSession, paths: dict[str, str]):
        self.spark = spark
        self.paths = paths

    def source(self, name: str) -> DataFrame:
        if name not in self.paths:
            raise KeyError(f"unknown table {name!r}; known: {', '.join(sorted(self.paths))}")
        return self.spark.read.parquet(self.paths[name])
