"""Batch sinks: replaced tables, CSV files, time-clustered lake files, JSON
reports and JDBC tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .constants import TABLE_PREFIX
from .functions.naming import normalize_name
from .operators.ids import by_ranges
from .operators.shape import fill_missing, normalize_columns
from .sources.csvfiles import write_csv_dataset


def replace_table(df: DataFrame, warehouse: str, name: str, fmt: str = "parquet") -> str:
    """Drop-and-recreate as an overwrite of ``<warehouse>/<name>``.  The old
    files go before the new ones are committed, so a plain file table must not
    be read meanwhile; a lake format (``fmt="delta"``) swaps versions."""
    path = f"{warehouse.rstrip('/')}/{name}"
    df.write.mode("overwrite").format(fmt).save(path)
    return path


def swap_table(df: DataFrame, warehouse: str, name: str) -> str:
    """Replace as one catalog change: the rows go to a new folder, and the view
    ``name`` is then pointed at it.  A reader sees all of the old table or all of
    the new one, whatever their columns; a write that fails changes nothing, and
    the table may be replaced by rows that were read from itself.  Folders of
    earlier versions stay for readers under way (remove them when none is left)."""
    spark = df.sparkSession
    path = f"{warehouse.rstrip('/')}/{name}/{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    spark.sql(f"CREATE OR REPLACE VIEW `{name}` AS SELECT * FROM parquet.`{path}`")
    return path


def replace_jdbc_table(df: DataFrame, url: str, name: str, properties: dict) -> None:
    """Same, into a relational database (needs its JDBC driver jar);
    partitions write in parallel, one connection each."""
    df.write.mode("overwrite").jdbc(url, name, properties=properties)


def business_table(dataset: str) -> str:
    return f"{TABLE_PREFIX}{dataset}"


def cluster_by_time(df: DataFrame, column: str, num_partitions: int | None = None) -> DataFrame:
    """Range-partition and sort on a time column so that every file and row
    group covers a narrow time slice: range filters on it skip the rest via
    parquet min/max statistics.  (A streaming append is already clustered by
    arrival time; this is for batch rewrites.)"""
    # A bulk load stamps many rows with one time; the content hash splits
    # such a value over several ranges instead of one task.
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    tied, by = df.withColumn("_tie", tie), (F.col(column), F.col("_tie"))
    ranged = by_ranges(tied, by, num_partitions)
    return ranged.sortWithinPartitions(column).drop("_tie")


def write_record_sets(sets: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Record sets -> one CSV dataset each, named after the set: lower-case
    normalised names, missing values filled.  Sets without rows are skipped; an
    error when none has rows.  Returns the path of each set written."""
    paths = {}
    for name, rows in sets.items():
        if rows.isEmpty():
            continue
        paths[name] = f"{folder.rstrip('/')}/{normalize_name(name, lowercase=True)}"
        write_csv_dataset(fill_missing(normalize_columns(rows, lowercase=True)), paths[name])
    if not paths:
        raise ValueError("no record set has data")
    return paths


def produce_json(df: DataFrame, topic: str, key: list[str] | None = None, value: str | None = None) -> DataFrame:
    """Rows as messages ``key, value, topic`` for a Kafka or wire sink.  The value is
    the row (or the struct column ``value``) as a JSON object in which null
    fields are written as null; the key is the JSON object of the ``key``
    columns, or null, which spreads the messages over the partitions."""
    keep = {"ignoreNullFields": "false"}
    body = F.col(value) if value else F.struct(*[F.col(f"`{c}`") for c in df.columns])
    name = F.to_json(F.struct(*[F.col(f"`{c}`") for c in key]), keep).cast("binary") if key else F.lit(None).cast("binary")
    return df.select(name.alias("key"), F.to_json(body, keep).cast("binary").alias("value"), F.lit(topic).alias("topic"))


def write_json_report(df: DataFrame, path: str) -> None:
    """Report rows as JSON lines; non-JSON types are written as text."""
    df.write.mode("overwrite").json(path)
