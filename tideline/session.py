"""Session helpers: conventions every job relies on, and the shared scratch
area (the cluster's ``spark.checkpoint.dir``)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "tideline", master: str | None = None,
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests.  On a cluster, pass ``master=None``
    and let spark-submit supply the master and sizing."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_conventions(spark)
    return spark


def apply_conventions(spark: SparkSession) -> None:
    """Text timestamps are rendered in UTC, as the oracles expect; of a key that
    a JSON object repeats the last value counts, as in the original consumer."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged tables and stream checkpoints.

    Read from ``spark.checkpoint.dir``; only a local-mode session without
    one gets a private temporary folder (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="tideline-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    elif spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([scratch_root(spark), "tideline", *parts])


def fresh_path(spark: SparkSession, *parts: str) -> str:
    """A new, unused folder below the scratch root."""
    return scratch_path(spark, *parts, uuid.uuid4().hex[:12])


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def is_blank_file(spark: SparkSession, path: str) -> bool:
    """True for a file of no bytes (metadata only)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    status = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p)
    return status.isFile() and status.getLen() == 0


def touch(spark: SparkSession, path: str, content: bytes = b"") -> None:
    """A small file, written by the driver."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p)
    try:
        if content:
            out.write(content)
    finally:
        out.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries in a folder (metadata only, no data)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


__all__ = ["build_session", "apply_conventions", "scratch_root", "scratch_path",
           "fresh_path", "path_exists", "touch", "list_names"]
