"""Column names, missing values, type inference and typed loading.

Inference reproduces what a pandas ``read_csv`` + dtype mapping decides,
in **one** aggregate pass over the text columns: each cell gets a class once,
and only classes are counted (partial aggregation; the driver receives one row
of per-column counts):

* no rows                                   -> VARCHAR(255)
* every value missing                       -> DECIMAL(15,4)
* all integers (blanks around allowed)      -> INTEGER, if none is missing
  and all fit int64 or all fit uint64; with a missing value -> DECIMAL(15,4);
  out of range -> VARCHAR
* all numbers (fraction, exponent, inf)     -> DECIMAL(15,4)
* all True/False tokens, none missing       -> BOOLEAN
* otherwise                                 -> VARCHAR(min(2 * width, 1000)),
  width = longest text, a missing value counting as 3
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import (FALSE_TOKENS, FLOAT_SQL_TYPE, MISSING_TEXT_WIDTH, TRUE_TOKENS,
                         VARCHAR_CAP, VARCHAR_DEFAULT)
from ..functions.cleaning import fill_missing_text, is_missing
from ..functions.naming import normalize_names

INT_RE = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_RE = r"(?i)^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity)\s*$"
INT64_MIN, INT64_MAX, UINT64_MAX = -(2 ** 63), 2 ** 63 - 1, 2 ** 64 - 1
INT32_MIN, INT32_MAX = -(2 ** 31), 2 ** 31 - 1


@dataclass(frozen=True)
class ColumnType:
    column: str
    sql_type: str          # the loader's DDL type
    spark_type: str        # what the typed table stores
    pandas_dtype: str      # what the profile reports


def normalize_columns(df: DataFrame, lowercase: bool = False) -> DataFrame:
    """Rename columns (space/hyphen -> '_', parentheses dropped[, lower])."""
    return df.toDF(*normalize_names(df.columns, lowercase))


def fill_missing(df: DataFrame, columns=None) -> DataFrame:
    """Missing values (NULL or a missing token) -> the text ``NULL``."""
    cols = set(columns or df.columns)
    return df.select(*[fill_missing_text(F.col(f"`{c}`")).alias(c) if c in cols else F.col(f"`{c}`")
                       for c in df.columns])


# what a cell can be; the class is computed once per cell
MISSING, INT, NUMBER, BOOL, TEXT = range(5)


def cells_of(name: str, df: DataFrame) -> DataFrame:
    """One row a cell: ``dataset, i, x`` (number of the data column and its text)."""
    texts = F.array(*[F.col(f"`{c}`").cast("string") for c in data_columns(df)])
    return df.select(F.lit(name).alias("dataset"), F.posexplode(texts).alias("i", "x"))


def classify_cells(cells: DataFrame) -> DataFrame:
    """Adds to each cell its class ``k``, integer ``n`` (its wide form ``d`` only
    beyond 64 bits), and length ``l`` and UTF-8 bytes ``b`` of a present text."""
    x, k, n = F.col("x"), F.col("k"), F.col("n")
    kind = (F.when(is_missing(x), MISSING).when(x.rlike(INT_RE), INT).when(x.rlike(FLOAT_RE), NUMBER)
            .when(x.isin(*(TRUE_TOKENS + FALSE_TOKENS)), BOOL).otherwise(TEXT))
    return (cells.withColumn("k", kind).withColumn("n", F.when(k == INT, F.trim(x).try_cast("bigint")))
            .withColumn("d", F.when((k == INT) & n.isNull(), F.trim(x).try_cast("decimal(38,0)")))
            .withColumn("l", F.when(k != MISSING, F.length(x))).withColumn("b", F.when(k != MISSING, F.octet_length(x))))


def _cell_stats() -> list:
    k, n, d = F.col("k"), F.col("n"), F.col("d")
    return [F.count(F.lit(1)).alias("rows"), F.count_if(k == MISSING).alias("miss"), F.count_if(k == INT).alias("int"),
            F.count_if(k == NUMBER).alias("num"), F.count_if(k == BOOL).alias("bool"), F.count_if(k == TEXT).alias("text"),
            F.count_if((k == INT) & n.isNull() & d.isNull()).alias("over"), F.min(n).alias("lo"), F.max(n).alias("hi"),
            F.min(d).alias("dlo"), F.max(d).alias("dhi"), F.max("l").alias("width"), F.sum("b").alias("bytes")]


def _decide(c: str, i: int, s: dict) -> ColumnType:
    miss, n_int, n_num, n_bool, n_text = (s.get(f"{k}{i}") or 0 for k in ("miss", "int", "num", "bool", "text"))
    pres, width = n_int + n_num + n_bool + n_text, s.get(f"width{i}") or 0
    if miss + pres == 0:
        return ColumnType(c, f"VARCHAR({VARCHAR_DEFAULT})", "string", "object")
    if pres == 0:
        return ColumnType(c, FLOAT_SQL_TYPE, "decimal(15,4)", "float64")
    if n_int == pres:
        if miss:
            return ColumnType(c, FLOAT_SQL_TYPE, "decimal(15,4)", "float64")
        ends = [int(s[k]) for k in (f"lo{i}", f"hi{i}", f"dlo{i}", f"dhi{i}") if s.get(k) is not None]
        if not s.get(f"over{i}") and min(ends) >= INT64_MIN and max(ends) <= INT64_MAX:
            spark_t = "int" if min(ends) >= INT32_MIN and max(ends) <= INT32_MAX else "bigint"
            return ColumnType(c, "INTEGER", spark_t, "int64")
        if not s.get(f"over{i}") and min(ends) >= 0 and max(ends) <= UINT64_MAX:
            return ColumnType(c, "INTEGER", "decimal(20,0)", "uint64")
    elif n_int + n_num == pres:
        return ColumnType(c, FLOAT_SQL_TYPE, "decimal(15,4)", "float64")
    elif n_bool == pres and not miss:
        return ColumnType(c, "BOOLEAN", "boolean", "bool")
    if miss:
        width = max(width, MISSING_TEXT_WIDTH)
    n = VARCHAR_DEFAULT if width == 0 else min(2 * width, VARCHAR_CAP)
    return ColumnType(c, f"VARCHAR({n})", "string", "object")


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if not c.startswith("_src_")]


def infer_types(df: DataFrame) -> list[ColumnType]:
    """One aggregate job over all columns; returns per-column types."""
    return infer_types_many({"": df})[""]


def column_stats_of_many(frames: dict[str, DataFrame]) -> dict[str, dict]:
    """Row count and column statistics of several datasets from one Spark job.
    Cells become rows, so one small aggregate serves every column of every
    dataset, however many there are; the shuffle carries one row a column and
    map task, and the driver gets one row a column."""
    out: dict[str, dict] = {name: {"rows": 0} for name in frames}
    cells = reduce(DataFrame.unionByName, [cells_of(name, df) for name, df in frames.items()])
    for r in classify_cells(cells).groupBy("dataset", "i").agg(*_cell_stats()).collect():
        stats = r.asDict()
        name, i = stats.pop("dataset"), stats.pop("i")
        out[name]["rows"] = stats.pop("rows")
        out[name].update({f"{k}{i}": v for k, v in stats.items()})
    return out


def decide_types(df: DataFrame, stats: dict) -> list[ColumnType]:
    return [_decide(c, i, stats) for i, c in enumerate(data_columns(df))]


def infer_types_many(frames: dict[str, DataFrame]) -> dict[str, list[ColumnType]]:
    """Types of several datasets from one Spark job."""
    stats = column_stats_of_many(frames)
    return {n: decide_types(df, stats[n]) for n, df in frames.items()}


def types_frame(spark: SparkSession, found: dict[str, list[ColumnType]], lowercase: bool = False) -> DataFrame:
    """Inference result of datasets as rows (one per column: metadata, not data)."""
    rows = [(dataset, i + 1, t.column, n, t.sql_type, t.spark_type, t.pandas_dtype) for dataset, types in found.items()
            for i, (t, n) in enumerate(zip(types, normalize_names([t.column for t in types], lowercase)))]
    schema = ("dataset string, ordinal int, column_name string, table_column string, "
              "sql_type string, spark_type string, pandas_dtype string")
    return spark.createDataFrame(rows, schema)


def _parsed(x: Column, spark_type: str) -> Column:
    """Present text -> value, NULL where the type rejects it."""
    if spark_type == "boolean":
        return F.when(x.isin(*TRUE_TOKENS), True).when(x.isin(*FALSE_TOKENS), False)
    return F.trim(x).try_cast(spark_type)


def typed_columns(types: list[ColumnType], rejects: str = "raise") -> list[Column]:
    """Cast expressions: numbers and booleans parsed (missing -> NULL), text
    columns get the ``NULL`` fill.  A present value that the type rejects (too
    many digits, ``inf`` in a decimal) stops the load as it does in a database,
    or becomes NULL with ``rejects="null"``; ``cast_failures`` counts them."""
    if rejects not in ("raise", "null"):
        raise ValueError("rejects is 'raise' or 'null'")
    out = []
    for t in types:
        x = F.col(f"`{t.column}`")
        if t.spark_type == "string":
            out.append(fill_missing_text(x).alias(t.column))
            continue
        value = _parsed(x, t.spark_type)
        if rejects == "raise":
            value = F.coalesce(value, F.raise_error(F.concat(
                F.lit(f"column {t.column}: {t.sql_type} cannot hold "), x)).cast(t.spark_type))
        out.append(F.when(~is_missing(x), value).alias(t.column))
    return out


def typed_load(df: DataFrame, types: list[ColumnType] | None = None,
               lowercase: bool = False, keep=(), rejects: str = "raise") -> DataFrame:
    """Text dataset -> typed columns with normalised names."""
    types = types or infer_types(df)
    names = normalize_names([t.column for t in types], lowercase)
    cols = [e.alias(n) for e, n in zip(typed_columns(types, rejects), names)]
    return df.select(*keep, *cols)


def cast_failures(df: DataFrame, types: list[ColumnType]) -> DataFrame:
    """``column_name, sql_type, failures``: present values that each column's
    type rejects, from one aggregate pass."""
    aggs, rows = [], []
    for i, t in enumerate(types):
        x = F.col(f"`{t.column}`")
        lost = F.lit(False) if t.spark_type == "string" else ~is_missing(x) & _parsed(x, t.spark_type).isNull()
        aggs.append(F.count_if(lost).alias(f"f{i}"))
        rows.append(F.struct(F.lit(t.column).alias("column_name"), F.lit(t.sql_type).alias("sql_type"),
                             F.col(f"f{i}").alias("failures")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def add_audit_columns(df: DataFrame) -> DataFrame:
    """``created_at``/``updated_at`` = time of the write; a data column of
    either name is an error, not overwritten."""
    taken = {c.lower() for c in df.columns} & {"created_at", "updated_at"}
    if taken:
        raise ValueError(f"the data already has a column {sorted(taken)[0]!r}")
    now = F.current_timestamp()
    return df.withColumn("created_at", now).withColumn("updated_at", now)
