"""Staged copies of derived inputs in the shared scratch folder.

A staged table is written once per state of the input folder (the names, sizes
and times of its files) and reused; it also cuts
lineage, so a lost executor re-reads files instead of recomputing."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from ..schemas import WIRE_SCHEMA
from ..session import fresh_path, path_exists, scratch_path


LAYOUT_VERSION = "6"   # bump when a staged layout changes; old copies are left alone


def input_stamp(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the input's files (a listing, no data)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    seen = []
    for entry in fs.listStatus(root):
        for f in (fs.listStatus(entry.getPath()) if entry.isDirectory() else [entry]):
            seen.append(f"{entry.getPath().getName()}/{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}")
    return "|".join(sorted(seen))


def input_key(spark: SparkSession, sf_dir: str) -> str:
    text = f"{sf_dir.rstrip('/')}|{LAYOUT_VERSION}|{input_stamp(spark, sf_dir)}"
    return hashlib.sha1(text.encode()).hexdigest()[:12]


def staged(spark: SparkSession, sf_dir: str, name: str, build, fmt: str = "parquet",
           options: dict | None = None, write=None) -> str:
    """Path of ``build()`` written under the scratch folder (once), by
    ``write(df, path)`` if given."""
    path = scratch_path(spark, "staged", input_key(spark, sf_dir), name)
    if not path_exists(spark, f"{path}/_SUCCESS"):
        df: DataFrame = build()
        if write is not None:
            write(df, path)
            return path
        df.write.mode("overwrite").options(**(options or {})).format(fmt).save(path)
    return path


def staged_wire(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """A wire table written by ``build()`` once; the query only reads it."""
    return spark.read.schema(WIRE_SCHEMA).parquet(staged(spark, sf_dir, name, build))


def fresh(spark: SparkSession, name: str) -> str:
    return fresh_path(spark, "runs", name)
