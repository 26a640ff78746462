"""Sources."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexiloom.sources.shared import stored

#: Folders of stages: the stage and its round.
ROUND = r"(translate|judge|correct)(?:_r(\d+))?/"


def jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines, split at \\n alone; a bad line is an error, blank lines are skipped."""
    reader = spark.read.option("mode", "FAILFAST").option("lineSep", "\n")
    return (reader.schema(schema) if schema else reader).json(path)


def jsonl_permissive(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows, and the lines that do not parse with the file they are in."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    read = spark.read.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("lineSep", "\n").json(path)
    rows = stored(read.withColumn("file", F.input_file_name()), "lines")  # a scan of _corrupt alone is not allowed
    return rows.where("_corrupt IS NULL").drop("_corrupt", "file"), rows.where("_corrupt IS NOT NULL").select("file", F.col("_corrupt").alias("line"))


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    """File and number (from 1) of each line that is not JSON, for error messages; files are read in splits.

    Each split counts its lines and keeps its bad ones; the lines of the splits
    before it, a row for each split, give their numbers in the file.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    bad = (F.trim("line") != "") & F.try_parse_json("line").isNull()
    splits = lines.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"), F.collect_list(F.when(bad, F.struct("at", "line"))).alias("bad"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = splits.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    found = placed.select("file", "before", "first", F.inline("bad"))
    return found.select("file", (F.col("before") + F.col("at") - F.col("first") + 1).alias("line_number"), "line")


def collect_records(spark: SparkSession, root: str, filename: str = "records.jsonl", schema: T.StructType | str | None = None, required: bool = True) -> DataFrame:
    """All files of one name under a folder, with stage, round, file and place from their paths.

    Without such a file: an error, or an empty table if not required (a schema is
    needed then).
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", filename).option("lineSep", "\n").option("mode", "FAILFAST")
    try:
        df = (reader.schema(schema) if schema else reader).json(root)
        if not df.inputFiles():
            raise FileNotFoundError(f"no {filename} under {root}")
    except (AnalysisException, FileNotFoundError):
        if required or schema is None:
            raise
        return spark.createDataFrame([], schema)
    path = F.col("_metadata.file_path")
    return df.withColumns(
        {
            "file": path,
            "position": F.monotonically_increasing_id(),
            "stage_dir": F.regexp_extract(path, ROUND, 1),
            "round_dir": F.coalesce(F.nullif(F.regexp_extract(path, ROUND, 2), F.lit("")).cast("int"), F.lit(0)),
        }
    )


def json_document(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document, or an array of them, over several lines."""
    return spark.read.option("multiLine", True).json(path)


def csv_with_quotes(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header, quoted line breaks and doubled quotes, of any cell size; a byte order mark is removed."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("maxCharsPerColumn", -1).option("encoding", "UTF-8")
    df = (reader.schema(schema) if schema else reader).csv(path)
    return df.withColumnsRenamed({c: c.lstrip("﻿") for c in df.columns})


def parquet_columns(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Named columns only; the others are not read."""
    return spark.read.parquet(path).select(*[F.col(f"`{c}`") for c in columns])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its store."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder of a store; none if there is no such folder."""
    if not exists(spark, path):
        return []
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    return sorted(f.getPath().getName() for f in found if f.isDirectory())


def placed(df: DataFrame) -> DataFrame:
    """Rows of files with their place: __file, __block (where the split of the file begins) and __at (the row in the split); for other rows __at alone tells."""
    try:
        of = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"))
        of.schema  # noqa: B018  an error here if the rows are not of files
    except AnalysisException:
        of = df.withColumns({"__file": F.lit(""), "__block": F.lit(0).cast("long")})
    return of.withColumn("__at", F.monotonically_increasing_id())


def head(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first n rows in an order; 0 means all."""
    return df.orderBy(*order).limit(n) if n else df
