"""Dataset profiles and the load report.

All datasets are profiled by one aggregate job (row count, inference stats,
text bytes per column); everything the driver receives is per-column
metadata."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import LOCAL_PREFIX, SOURCE_DOWNLOADED, SOURCE_LOCAL
from .shape import ColumnType, column_stats_of_many, data_columns, decide_types

FIXED_WIDTH = {"int64": 8, "uint64": 8, "float64": 8, "bool": 1}


@dataclass
class DatasetProfile:
    name: str
    rows: int
    types: list[ColumnType]
    text_bytes: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [t.column for t in self.types]

    @property
    def source(self) -> str:
        return SOURCE_LOCAL if self.name.startswith(LOCAL_PREFIX) else SOURCE_DOWNLOADED

    @property
    def data_bytes(self) -> int:
        """Fixed width for numbers and booleans, UTF-8 bytes for text (the
        interpreter's per-object overhead is not modelled)."""
        return sum(FIXED_WIDTH.get(t.pandas_dtype, 0) * self.rows if t.pandas_dtype in FIXED_WIDTH
                   else self.text_bytes.get(t.column, 0) for t in self.types)


def profile_datasets(frames: dict[str, DataFrame]) -> list[DatasetProfile]:
    """Profiles of several datasets from one Spark job."""
    stats = column_stats_of_many(frames)
    return [DatasetProfile(n, stats[n]["rows"], decide_types(df, stats[n]),
                           {c: stats[n].get(f"bytes{i}") or 0 for i, c in enumerate(data_columns(df))})
            for n, df in frames.items()]


def profiles_frame(spark: SparkSession, profiles: list[DatasetProfile]) -> DataFrame:
    """One row per dataset: rows, columns, names, dtypes, bytes, source."""
    rows = [(p.name, p.rows, len(p.types), json.dumps(p.columns, separators=(",", ":")),
             json.dumps({t.column: t.pandas_dtype for t in p.types}, separators=(",", ":")),
             p.data_bytes, p.source) for p in profiles]
    return spark.createDataFrame(rows, "dataset string, rows long, columns int, column_names string, "
                                       "data_types string, memory_usage long, source string")


def report_rows(profile: DataFrame) -> DataFrame:
    """The profile as a report nests it: names as a list, dtypes as a map, and
    the time of the report."""
    return profile.withColumns({
        "column_names": F.from_json("column_names", "array<string>"),
        "data_types": F.from_json("data_types", "map<string,string>"),
        "timestamp": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")})


def string_widths(df: DataFrame) -> DataFrame:
    """Longest text per string column (NULLs ignored), one aggregate job,
    unpivoted in Spark to (column_name, max_length)."""
    cols = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"
            and not f.name.startswith("_src_")]
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, max_length int")
    wide = df.agg(*[F.max(F.length(F.col(f"`{c}`"))).alias(f"w{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', w{i}" for i, c in enumerate(cols))
    return wide.select(F.expr(f"stack({len(cols)}, {pairs}) AS (column_name, max_length)"))
