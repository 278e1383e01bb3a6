"""CSV records that go over line ends, and records that are not well formed.

A quoted value may hold line breaks.  A line ends inside one exactly if the
file holds an odd number of quotes up to it, so the start of every record
follows from running sums of quotes: per line inside a file split, and over the
splits of a file by a two-level prefix sum.  Large files thus stay split into
many tasks; only the lines of records longer than one line are shuffled to be
joined.  Quotes must be balanced as writers of CSV leave them: a bare quote in
an unquoted value counts as an opening one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ids import BROADCAST_GROUPS_MAX, prefix_offsets
from ..session import fresh_path, is_blank_file, path_exists

#: Blanks around a value are part of it.  Null and the empty text differ: nothing between two delimiters is null, ``""`` is empty.
NULL_MARK = "\u0001null"
PARSE_OPTIONS = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
                 "nullValue": NULL_MARK, "maxCharsPerColumn": "-1"}
#: Lines of one record at most; what is longer is taken for an unclosed quote, and its lines are set aside one by one.
MAX_LINES = 10_000
RAGGED, UNCLOSED, TOO_LONG = "wrong number of fields", "unclosed quote", f"record of more than {MAX_LINES} lines"
_POSITION = ("_src_file", "_src_block", "_src_row")


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """Lines with the file, the start of the file split and a number that grows
    within it, and whether they hold an odd number of quotes."""
    df = spark.read.option("lineSep", "\n").option("ignoreCorruptFiles", "true").text(paths)
    df = df.select(F.col("_metadata.file_path").alias("_src_file"), F.col("_metadata.file_block_start").alias("_src_block"),
                   F.monotonically_increasing_id().alias("_src_row"), "value")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return df.withColumn("odd", (quotes % 2).cast("int"))


def _splits(lines: DataFrame) -> DataFrame:
    """Per file split: quotes open at its start (``open``), at its end
    (``open_after``), and the number of records that start before it (``base``)."""
    spark = lines.sparkSession
    stats = lines.groupBy("_src_file", "_src_block").agg(
        F.sum("odd").alias("odd"), F.count_if(F.col("before") % 2 == 0).alias("even"), F.count(F.lit(1)).alias("n"))
    path = fresh_path(spark, "csv-records")
    order = ["_src_file", "_src_block"]
    stats.write.parquet(f"{path}/splits")
    seen = prefix_offsets(spark.read.parquet(f"{path}/splits"), order, "odd", f"{path}/quotes")
    first = seen.groupBy(F.col("_src_file").alias("_f")).agg(F.min("_off").alias("_first"))   # sums grow along a file
    seen = seen.join(first, seen["_src_file"] == first["_f"]).withColumn("open", (F.col("_off") - F.col("_first")) % 2)
    seen = seen.select(*order, "open", ((F.col("open") + F.col("odd")) % 2).alias("open_after"),
                       F.when(F.col("open") == 0, F.col("even")).otherwise(F.col("n") - F.col("even")).alias("starts"))
    seen.write.parquet(f"{path}/starts")
    return prefix_offsets(spark.read.parquet(f"{path}/starts"), order, "starts", f"{path}/records").select(
        *order, "open", "open_after", F.col("_off").alias("base"))


def _assemble(lines: DataFrame, max_lines: int) -> DataFrame:
    """Records ``(_src_file, _src_block, _src_row, text, reason)`` without header lines and blank records."""
    within = Window.partitionBy("_src_file", "_src_block").orderBy("_src_row")
    lines = lines.withColumn("before", F.sum("odd").over(within) - F.col("odd")).withColumn(
        "header", (F.col("_src_block") == 0) & (F.row_number().over(within) == 1))
    splits = _splits(lines)
    if splits.limit(BROADCAST_GROUPS_MAX + 1).count() <= BROADCAST_GROUPS_MAX:
        splits = F.broadcast(splits)
    lines = lines.join(splits, ["_src_file", "_src_block"]).withColumn("start", (F.col("before") + F.col("open")) % 2 == 0)
    lines = lines.withColumn("rec", F.col("base") + F.sum(F.col("start").cast("long")).over(within)).withColumn(
        "goes_on", F.coalesce(~F.lead("start").over(within), F.col("open_after") == 1))
    alone = lines.where(F.col("start") & ~F.col("goes_on") & ~F.col("header")).select(
        *_POSITION, F.col("value").alias("text"), F.lit(None).cast("string").alias("reason"))
    parts = lines.where(~F.col("start") | F.col("goes_on")).select(*_POSITION, "rec", "value", "odd")
    sizes = parts.groupBy("rec").agg(F.count(F.lit(1)).alias("lines"))
    endless = sizes.where(F.col("lines") > max_lines).select("rec")
    joined = parts.join(endless, "rec", "left_anti").groupBy("rec").agg(
        F.min(F.struct(*_POSITION)).alias("p"), F.sum("odd").alias("odd"),
        F.array_sort(F.collect_list(F.struct("_src_block", "_src_row", "value"))).alias("v"))   # max_lines at most
    joined = joined.select("p.*", F.array_join(F.transform("v", lambda x: x["value"]), "\n").alias("text"),
                           F.when(F.col("odd") % 2 == 1, UNCLOSED).alias("reason"))
    aside = parts.join(endless, "rec", "left_semi").select(*_POSITION, F.col("value").alias("text"), F.lit(TOO_LONG).alias("reason"))
    out = alone.unionByName(joined).unionByName(aside).withColumn("text", F.regexp_replace("text", r"\r$", ""))
    return out.where(F.col("text") != "")


def header_of(spark: SparkSession, paths) -> list[str]:
    """Column names: the first line of the first file."""
    return spark.read.options(**PARSE_OPTIONS, header="true", ignoreCorruptFiles="true").csv(paths).columns


def read_csv_records(spark: SparkSession, paths, columns: list[str] | None = None, max_lines: int = MAX_LINES,
                     one_line: bool | None = None) -> DataFrame:
    """All records of one dataset (a path or several), every column as text, with
    ``_src_file``, ``_bad_reason`` (null for a good record) and ``_bad_text``.

    ``one_line`` says that no record goes over a line end; when it is not given,
    a scan looks for a line with an odd number of quotes.  Files that cannot be
    read are skipped (:func:`file_status` names them).  Repeated rows stay;
    blank lines are no records; a file without a line gives none."""
    columns = columns or header_of(spark, paths)
    taken = {c.lower() for c in columns} & {"_src_file", "_bad_reason", "_bad_text"}
    if taken:
        raise ValueError(f"the data already has a column {sorted(taken)[0]!r}")
    fields = ", ".join(f"`{c.replace('`', '``')}` string" for c in [*columns, "_bad_text"])
    options = PARSE_OPTIONS | {"columnNameOfCorruptRecord": "_bad_text"}
    cols = [F.col(f"`{c}`") for c in columns]
    lines = read_lines(spark, paths)
    if one_line or one_line is None and lines.where("odd = 1").isEmpty():
        df = spark.read.schema(fields).options(**options, header="true", ignoreCorruptFiles="true").csv(paths)
        return df.select(*cols, F.col("_metadata.file_path").alias("_src_file"),
                         F.when(F.col("_bad_text").isNotNull(), RAGGED).alias("_bad_reason"), "_bad_text")
    records = _assemble(lines, max_lines)
    parsed = records.select("_src_file", "text", "reason", F.from_csv("text", F.lit(fields), options).alias("r"))
    reason = F.coalesce("reason", F.when(F.col("r._bad_text").isNotNull(), F.lit(RAGGED)))
    return parsed.select(*[F.col("r")[c].alias(c) for c in columns], "_src_file", reason.alias("_bad_reason"),
                         F.when(reason.isNotNull(), F.col("text")).alias("_bad_text"))


def count_records(spark: SparkSession, paths) -> DataFrame:
    """``_src_file, rows``: records of every file, its header line excluded."""
    lines = read_lines(spark, paths)
    if lines.where("odd = 1").isEmpty():
        df = spark.read.options(**PARSE_OPTIONS, header="true").csv(paths).select(F.col("_metadata.file_path").alias("_src_file"))
    else:
        df = _assemble(lines, MAX_LINES)
    return df.groupBy("_src_file").agg(F.count(F.lit(1)).alias("rows"))


def good_records(records: DataFrame) -> DataFrame:
    return records.where(F.col("_bad_reason").isNull()).drop("_src_file", "_bad_reason", "_bad_text")


def bad_records(records: DataFrame) -> DataFrame:
    """``file, reason, text`` of the records set aside."""
    return records.where(F.col("_bad_reason").isNotNull()).select(
        F.col("_src_file").alias("file"), F.col("_bad_reason").alias("reason"), F.col("_bad_text").alias("text"))


def file_status(spark: SparkSession, paths: list[str], records: DataFrame) -> DataFrame:
    """``file, status, rows, bad_rows`` of every file below ``paths``, counted on one
    read of the ``records``: ``loaded``, ``empty`` (no bytes or no record),
    ``unreadable`` (bytes, but nothing could be read) or ``missing`` (a given
    path that does not exist, under its own name).  Files are listed by Spark,
    their contents are not read again."""
    there = [p for p in paths if path_exists(spark, p)]
    counts = records.groupBy(F.col("_src_file").alias("file")).agg(
        F.count_if(F.col("_bad_reason").isNull()).alias("rows"), F.count_if(F.col("_bad_reason").isNotNull()).alias("bad_rows"))
    blank = {p for p in there if is_blank_file(spark, p)}           # Spark lists no file of no bytes
    out = spark.createDataFrame([(p, "empty" if p in blank else "missing", 0, 0) for p in paths if p in blank or p not in there],
                                "file string, status string, rows long, bad_rows long")
    there = [p for p in there if p not in blank]
    if not there:
        return out
    listed = spark.read.format("binaryFile").load(there).select(F.col("_metadata.file_path").alias("file"), "length")
    lines = read_lines(spark, there).groupBy(F.col("_src_file").alias("file")).agg(F.count(F.lit(1)).alias("lines"))
    seen = listed.join(counts, "file", "left").join(lines, "file", "left")
    status = (F.when(F.coalesce(F.col("rows"), F.lit(0)) + F.coalesce(F.col("bad_rows"), F.lit(0)) > 0, "loaded")
              .when((F.col("length") > 0) & F.col("lines").isNull(), "unreadable").otherwise("empty"))
    zero = F.lit(0).cast("long")
    return out.unionByName(seen.select("file", status.alias("status"), F.coalesce("rows", zero).alias("rows"),
                                       F.coalesce("bad_rows", zero).alias("bad_rows")))
