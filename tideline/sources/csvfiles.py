"""CSV datasets: header row, every column read as text.

A dataset is a file ``<name>.csv`` or a Spark-written folder ``<name>.csv/``
of part files; its name comes from the path.  Typing happens later, in one
aggregate pass (``operators.shape.infer_types``)."""

from __future__ import annotations

from fnmatch import fnmatch

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..constants import KAGGLE_GLOB, LOCAL_PREFIX
from ..functions.naming import dataset_from_path
from ..session import list_names, path_exists, touch
from .csvrecords import PARSE_OPTIONS, count_records, read_csv_records

#: Blanks around a value are part of it (Spark's default drops them on writing).
CSV_OPTIONS = {"header": "true", "escape": '"', "multiLine": "false",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
#: File in a written dataset's folder that says that every record is one line.
ONE_LINE = "_ONE_LINE"


def read_csv_dataset(spark: SparkSession, path: str, with_position: bool = False,
                     multi_line: bool | None = None) -> DataFrame:
    """All columns as strings.  A record may go over line ends; whether any does
    is known for datasets that ``write_csv_dataset`` wrote, and is looked up by a
    scan for others unless ``multi_line`` says it.  A record with too many or too
    few fields, or an unclosed quote, stops the read;
    ``csvrecords.read_csv_records`` sets such records aside instead.

    ``with_position`` adds ``_src_file``, ``_src_block`` and ``_src_row``, which
    together give the input order (rows of one file split are read in order by
    one task); it needs records of one line."""
    one_line = not multi_line if multi_line is not None else path_exists(spark, f"{path}/{ONE_LINE}")
    if one_line or with_position:
        df = spark.read.options(**PARSE_OPTIONS, header="true", mode="FAILFAST").csv(path)
        if with_position:
            df = df.select("*", F.col("_metadata.file_path").alias("_src_file"),
                           F.col("_metadata.file_block_start").alias("_src_block"),
                           F.monotonically_increasing_id().alias("_src_row"))
        return df
    found = read_csv_records(spark, path, one_line=False if multi_line else None)
    stop = F.raise_error(F.concat("_bad_reason", F.lit(": "), F.left("_bad_text", F.lit(200)))).cast("string")
    names = [c for c in found.columns if c not in ("_src_file", "_bad_reason", "_bad_text")]
    return found.select(*[F.when(F.col("_bad_reason").isNotNull(), stop).otherwise(F.col(f"`{c}`")).alias(c) for c in names])


def read_local_csv_files(spark: SparkSession, paths: list[str], with_position: bool = False):
    """``local_<stem>`` -> DataFrame for each existing path; missing paths
    are skipped and returned, so one bad path does not stop the others."""
    frames, missing = {}, []
    for path in paths:
        if not path_exists(spark, path):
            missing.append(path)
            continue
        stem = path.rstrip("/").rsplit("/", 1)[-1]
        stem = stem[:-4] if stem.endswith(".csv") else stem
        frames[f"{LOCAL_PREFIX}{stem}"] = read_csv_dataset(spark, path, with_position)
    return frames, missing


def dataset_row_counts(spark: SparkSession, root: str, pattern: str = KAGGLE_GLOB) -> DataFrame:
    """Records per dataset (header lines excluded), whatever lines they take: one
    partial aggregate where every dataset is marked as one line a record."""
    root = root.rstrip("/")
    names = [n for n in list_names(spark, root) if fnmatch(n, pattern)]
    if names and all(path_exists(spark, f"{root}/{n}/{ONE_LINE}") for n in names):
        df = spark.read.options(**CSV_OPTIONS).csv(f"{root}/{pattern}").select(F.col("_metadata.file_path").alias("_src_file"))
        per_file = df.groupBy("_src_file").agg(F.count(F.lit(1)).alias("rows"))
    else:
        per_file = count_records(spark, f"{root}/{pattern}")
    return per_file.groupBy(dataset_from_path(F.col("_src_file")).alias("dataset")).agg(F.sum("rows").alias("rows"))


def write_csv_dataset(df: DataFrame, path: str) -> None:
    """Dataset -> CSV with a header and no index column (B5).  The write itself
    counts values with line breaks; without any the folder is marked, and readers
    need not look."""
    if any(ch in c for c in df.columns for ch in "\n\r"):
        raise ValueError("a column name holds a line break")
    seen = Observation()
    breaks = [F.coalesce(F.col(f"`{f.name}`").rlike(r"[\n\r]"), F.lit(False)) for f in df.schema.fields
              if f.dataType.simpleString() == "string"]
    any_break = breaks[0] if breaks else F.lit(False)
    for b in breaks[1:]:
        any_break = any_break | b
    df.observe(seen, F.count_if(any_break).alias("broken")).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    if not seen.get["broken"]:
        touch(df.sparkSession, f"{path.rstrip('/')}/{ONE_LINE}")
