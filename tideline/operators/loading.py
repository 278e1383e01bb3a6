"""Loading datasets into tables, with what became of each.

Rows are counted by the write itself (an observed metric), so the report needs
no scan of its own.  A dataset that cannot be read or stored is recorded with
its error, and the others are still loaded."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..constants import LOCAL_PREFIX, SOURCE_DOWNLOADED, SOURCE_LOCAL
from ..sinks import business_table, replace_table

LOADED, EMPTY, FAILED, MISSING = "loaded", "empty", "failed", "missing"


@dataclass(frozen=True)
class DatasetLoad:
    dataset: str
    status: str
    rows: int = 0
    columns: int = 0
    error: str | None = None


def load_datasets(frames: dict[str, DataFrame], warehouse: str, missing: tuple = (),
                  prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> list[DatasetLoad]:
    """Writes ``prepare(frame)`` of every dataset to its table ``business_<dataset>``
    and says how it went; ``missing`` names datasets whose files are not there.
    A dataset without rows gets an (empty) table and the status ``empty``."""
    out = []
    for name, frame in frames.items():
        seen = Observation()
        try:
            ready = prepare(frame)
            replace_table(ready.observe(seen, F.count(F.lit(1)).alias("rows")), warehouse, business_table(name))
            rows = int(seen.get["rows"])
            out.append(DatasetLoad(name, LOADED if rows else EMPTY, rows, len(frame.columns)))
        except (PySparkException, ValueError) as e:
            out.append(DatasetLoad(name, FAILED, error=str(e).split("\n")[0][:500]))
    return out + [DatasetLoad(name, MISSING) for name in missing]


def load_status(spark: SparkSession, loads: list[DatasetLoad]) -> DataFrame:
    """``dataset, source, status, rows, error``: one row a dataset."""
    rows = [(x.dataset, SOURCE_LOCAL if x.dataset.startswith(LOCAL_PREFIX) else SOURCE_DOWNLOADED, x.status, x.rows, x.error)
            for x in loads]
    return spark.createDataFrame(rows, "dataset string, source string, status string, rows long, error string")


def load_report(spark: SparkSession, loads: list[DatasetLoad]) -> DataFrame:
    """One row: time, datasets loaded and their records, datasets by source, files
    not found, datasets that failed, and whether all went well.  An error when
    no dataset has data."""
    done = [x for x in loads if x.status == LOADED]
    if not done:
        raise ValueError("no dataset has data")
    local = sum(x.dataset.startswith(LOCAL_PREFIX) for x in done)
    missing, failed = (sum(x.status == s for x in loads) for s in (MISSING, FAILED))
    row = (datetime.now(timezone.utc).isoformat(), len(done), sum(x.rows for x in done), len(done) - local, local, missing,
           failed, not missing and not failed)
    return spark.createDataFrame([row], "timestamp string, total_datasets int, total_records long, kaggle_datasets int, "
                                        "local_datasets int, missing_files int, failed_datasets int, success boolean")
