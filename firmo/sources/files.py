"""File scans (O-IO-01..06, O-IO-11).

CSV files are read by byte ranges (``csv_ranges``); fields are matched to the target
schema by header name (case-insensitive, trimmed), so files may order their columns
differently, lack columns or carry extra ones: each row finds its fields by the
positions in its own file's header.
Listing is left to Spark's file index; nothing on the driver is done per file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from firmo.session import scratch_path
from firmo.sources import csv_ranges

# Text that the staging load reads as NULL.
NULL_TOKENS = ("NULL", "null", "\\N")

# An unquoted empty field reads as this marker (-> null); a quoted "" stays an empty
# string.  Spark's default ("") cannot tell the two apart.
UNQUOTED_EMPTY = "\u0001"

# Headers of up to so many files are broadcast (some 200 bytes each).
BROADCAST_FILES = 200_000


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def data_files(spark: SparkSession, root: str, glob: str, pattern: str | None = None) -> DataFrame | None:
    """(path) of the data files under ``root`` whose name fits ``glob`` and whose path
    fits a regex (O-IO-03); None where the folder does not exist.  Contents are not read."""
    if not _exists(spark, root):
        return None
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root).select("path")
    return files.filter(F.col("path").rlike(pattern)) if pattern else files


def _has(files: DataFrame | None) -> bool:
    return files is not None and not files.isEmpty()


def csv_options(reader):
    """How the streaming load reads CSV: quoted fields may hold quotes and line ends."""
    return (reader.option("multiLine", True).option("quote", '"').option("escape", '"')
            .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
            .option("mode", "PERMISSIVE").option("nullValue", UNQUOTED_EMPTY))


def typed_fields(schema: T.StructType, field) -> tuple[list[Column], Column]:
    """Columns of the schema from text (``field(name)``, None where the file has no
    such column), and whether a row is bad: a non-empty text that does not convert."""
    typed, bad = [], F.lit(False)
    for f in schema.fields:
        txt = field(f.name)
        if txt is None:
            typed.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        txt = F.when(txt.isin(*NULL_TOKENS, UNQUOTED_EMPTY), F.lit(None).cast("string")).otherwise(txt)
        if isinstance(f.dataType, T.StringType):
            typed.append(txt.alias(f.name))
        else:
            val = F.trim(txt).try_cast(f.dataType)
            typed.append(val.alias(f.name))
            bad = bad | (txt.isNotNull() & (F.trim(txt) != "") & val.isNull())
    return typed, bad


def scan_csv(spark: SparkSession, root: str, schema: T.StructType, pattern: str | None = None, paths: list[str] | None = None,
             range_bytes: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """O-IO-01/02: (loaded rows, rejected rows, files).  Rows have their file and byte
    offset, rejects the cause as well: a non-empty field that does not convert to its
    column type, or a quote that is never closed; the load goes on.  Short rows and
    extra fields are accepted.  Files: (source_file, n_bytes, print)."""
    place = [T.StructField("source_file", T.StringType()), T.StructField("byte_offset", T.LongType())]
    if not paths and not _exists(spark, root):
        empty = spark.createDataFrame([], T.StructType([*schema.fields, *place, T.StructField("cause", T.StringType())]))
        return empty.drop("cause"), empty, spark.createDataFrame([], "source_file string, n_bytes long, print decimal(38,0)")
    rows, about = csv_ranges.read_records(spark, root, lambda name: scratch_path(spark, name), UNQUOTED_EMPTY, pattern, paths, range_bytes)
    headers = about.select("file", F.transform("cells", lambda x: F.lower(F.trim(x))).alias("names"))
    rows = rows.join(F.broadcast(headers) if about.count() <= BROADCAST_FILES else headers, "file")

    def field(name: str) -> Column:
        at = F.array_position("names", name.lower())
        return F.when(at > 0, F.get("cells", (at - 1).cast("int")))

    typed, bad = typed_fields(schema, field)
    cause = F.when(F.col("open"), F.lit(csv_ranges.OPEN_QUOTE)).when(bad, F.lit(csv_ranges.BAD_FIELD))
    flagged = rows.select(*typed, F.col("file").alias("source_file"), F.col("at").alias("byte_offset"), cause.alias("cause"))
    return (flagged.where("cause IS NULL").drop("cause"), flagged.where("cause IS NOT NULL"),
            about.select(F.col("file").alias("source_file"), "n_bytes", "print"))


def scan_csv_by_name(spark: SparkSession, root: str, schema: T.StructType, pattern: str | None = None,
                     with_file: bool = False) -> tuple[DataFrame, DataFrame]:
    """O-IO-01/02: (loaded rows, rejected rows with their file)."""
    good, rejects, _ = scan_csv(spark, root, schema, pattern)
    return good.drop("byte_offset", *([] if with_file else ["source_file"])), rejects.drop("byte_offset", "cause")


def load_audit(loaded: DataFrame, rejected: DataFrame, by: Column | None = None, last: int = 5) -> DataFrame:
    """O-IO-04: rows loaded and rejected per load unit, most recent ``last`` units.

    A load unit is the folder of a file (dated sub-folders), or ``by``."""
    unit = by if by is not None else F.regexp_extract("source_file", r"^(.*)/[^/]+$", 1)
    a = loaded.select(unit.alias("load_unit"), F.lit(1).alias("_ok"))
    b = rejected.select(unit.alias("load_unit"), F.lit(0).alias("_ok"))
    return (a.unionByName(b).groupBy("load_unit")
              .agg(F.sum("_ok").cast("long").alias("rows_loaded"),
                   F.sum(1 - F.col("_ok")).cast("long").alias("rows_rejected"))
              .orderBy(F.col("load_unit").desc()).limit(last))


def scan_multi_file(spark: SparkSession, folder: str, schema: T.StructType | None = None) -> DataFrame:
    """O-IO-05: all CSV files of a folder (columns aligned by name), else all Parquet files."""
    if _has(data_files(spark, folder, "*.csv")):
        if schema is None:
            raise ValueError("a target schema is needed for CSV files")
        return scan_csv_by_name(spark, folder, schema)[0]
    if not _has(data_files(spark, folder, "*.parquet")):
        raise FileNotFoundError(folder)
    return (spark.read.option("mergeSchema", True).option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet").parquet(folder))


def scan_first_available(spark: SparkSession, locations: list[str], schema: T.StructType | None = None) -> DataFrame:
    """O-IO-06: the first location that holds data files."""
    for loc in locations:
        if _has(data_files(spark, loc, "*.{csv,parquet}")):
            return scan_multi_file(spark, loc, schema)
    raise FileNotFoundError(f"no data in any of {locations}")


def preview_sample(df: DataFrame, n: int = 5, order: list[Column] | None = None) -> DataFrame:
    """O-IO-11: the first ``n`` rows (in ``order`` when given, for a stable preview)."""
    return (df.orderBy(*order) if order else df).limit(n)
