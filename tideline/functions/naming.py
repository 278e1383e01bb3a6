"""Names of columns, datasets and tables.

Column names are schema metadata, so they are rewritten on the driver; dataset
names come from file paths and are computed per row with Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import LOCAL_PREFIX, TABLE_PREFIX


def normalize_name(name: str, lowercase: bool = False) -> str:
    """Space and '-' -> '_', '(' and ')' dropped; '.', '/', '+' survive.
    The record-set seeder also lower-cases; the table loader does not."""
    out = name.replace(" ", "_").replace("-", "_").replace("(", "").replace(")", "")
    return out.lower() if lowercase else out


def normalize_names(names: list[str], lowercase: bool = False) -> list[str]:
    """Normalise every name; two columns mapping to one name is an error."""
    out = [normalize_name(n, lowercase) for n in names]
    seen: dict[str, str] = {}
    for src, dst in zip(names, out):
        if dst in seen:
            raise ValueError(f"column names {seen[dst]!r} and {src!r} both normalise to {dst!r}")
        seen[dst] = src
    return out


def dataset_from_path(path: Column) -> Column:
    """Dataset name of a CSV file: its name without '.csv'.  A Spark-written
    dataset is a folder ``<name>.csv/part-*.csv``; then the folder names it."""
    return F.regexp_extract(path, r"/([^/]+?)\.csv(?:/[^/]+)?$", 1)


def table_name(dataset: Column, local: bool | Column = False) -> Column:
    """``business_<dataset>``; local files get ``local_`` in front first."""
    if isinstance(local, bool):
        local = F.lit(local)
    return F.concat(F.lit(TABLE_PREFIX),
                    F.when(local, F.concat(F.lit(LOCAL_PREFIX), dataset)).otherwise(dataset))
