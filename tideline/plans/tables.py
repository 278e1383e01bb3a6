"""Queries for the load side: CSV datasets, names, type inference, typed
tables with surrogate ids and audit columns, profiles and the report."""

from __future__ import annotations

import json
from pyspark.sql import functions as F

from ..constants import (KAGGLE_GLOB, LOCAL_PREFIX, MISSING_TOKENS, PRODUCER_TOPIC, SOURCE_DOWNLOADED, SOURCE_LOCAL,
                         TABLE_PREFIX)
from ..functions.naming import dataset_from_path, normalize_name, table_name
from ..operators.flatten import flatten_changes
from ..operators.ids import surrogate_ids
from ..operators.loading import load_datasets, load_report, load_status
from ..operators.profile import profile_datasets, profiles_frame, report_rows, string_widths
from ..operators.shape import (ColumnType, add_audit_columns, cast_failures, fill_missing, infer_types,
                               infer_types_many, normalize_columns, typed_load, types_frame)
from ..sinks import business_table, cluster_by_time, produce_json, replace_table, swap_table, write_json_report, write_record_sets
from ..sources.csvfiles import (read_csv_dataset, read_local_csv_files, dataset_row_counts,
                                write_csv_dataset)
from ..session import scratch_path, touch
from ..sources.csvrecords import bad_records, file_status, good_records, read_csv_records
from .fixtures import (CSV_DATASETS, LOCAL_FILES, RAW_LINES, capture_wire, customer_view, load,
                       load_ordered, messy_lines, note_view, orders_view)
from .registry import register
from .sqlparts import CSV_VIEWS, CUST_TYPED, CUST_V, EVENTS_CTE, MESSY_CSV_CTE, NOTE_CTE, ORD_V, TS_TEXT
from .staging import fresh, input_key, staged

CUSTOMERS = "ncr_ride_bookings_customers"


def csv_root(spark, sf_dir) -> str:
    """Folder holding every CSV dataset (staged once per input folder)."""
    for name, (table, key, view) in CSV_DATASETS.items():
        staged(spark, sf_dir, f"csv/{name}.csv",
               lambda t=table, k=key, v=view: v(load_ordered(spark, sf_dir, t, k)), write=write_csv_dataset)
    return scratch_path(spark, "staged", input_key(spark, sf_dir), "csv")


def _customers(spark, sf_dir, with_position=False):
    return read_csv_dataset(spark, f"{csv_root(spark, sf_dir)}/{CUSTOMERS}.csv", with_position)


def _all_frames(spark, sf_dir, with_position=False):
    root = csv_root(spark, sf_dir)
    frames = {n: read_csv_dataset(spark, f"{root}/{n}.csv", with_position)
              for n in CSV_DATASETS if n.startswith("ncr_ride_bookings")}
    local, missing = read_local_csv_files(spark, [f"{root}/{f}" for f in LOCAL_FILES], with_position)
    frames.update(local)
    return frames, missing


@register("csv_scan", f"""
WITH {CUST_V}
SELECT '{CUSTOMERS}' AS dataset, "Customer Key", "Customer-Name", "Nation Key", "Account Balance (USD)",
       "Market Segment", "Active" FROM cust_v
""")
def csv_scan(spark, sf_dir):
    """A CSV dataset with a header, every column as text, named by its file."""
    df = _customers(spark, sf_dir)
    return df.select(dataset_from_path(F.col("_metadata.file_path")).alias("dataset"), *df.columns)


@register("csv_glob_scan", """
SELECT 'ncr_ride_bookings' AS dataset, count(*) AS rows FROM orders
UNION ALL SELECT 'ncr_ride_bookings_customers', count(*) FROM customer
""")
def csv_glob_scan(spark, sf_dir):
    """Rows per dataset among the files matching the download pattern."""
    return dataset_row_counts(spark, csv_root(spark, sf_dir), KAGGLE_GLOB)


_NAMES = [(n, SOURCE_DOWNLOADED if n.startswith("ncr_ride_bookings") else SOURCE_LOCAL)
          for n in CSV_DATASETS]


@register("dataset_names", "SELECT * FROM (VALUES " + ", ".join(
    f"('{n}', '{s}', '{TABLE_PREFIX}{'' if s == SOURCE_DOWNLOADED else LOCAL_PREFIX}{n}')"
    for n, s in _NAMES)
    + ") AS t(dataset, source, table_name)")
def dataset_names_q(spark, sf_dir):
    """Dataset and table names of every CSV file in the data folder
    (``.csv`` stripped; ``local_`` for local files; ``business_`` prefix)."""
    df = spark.read.options(header="true").csv(f"{csv_root(spark, sf_dir)}/*.csv")
    ds = df.select(dataset_from_path(F.col("_metadata.file_path")).alias("dataset")).distinct()
    local = ~ds["dataset"].startswith("ncr_ride_bookings")
    return ds.select("dataset", F.when(local, SOURCE_LOCAL).otherwise(SOURCE_DOWNLOADED).alias("source"),
                     table_name(F.col("dataset"), local).alias("table_name"))


@register("normalize_columns", f"""
WITH {CUST_V}
SELECT "Customer Key" AS "Customer_Key", "Customer-Name" AS "Customer_Name", "Nation Key" AS "Nation_Key",
       "Account Balance (USD)" AS "Account_Balance_USD", "Market Segment" AS "Market_Segment", "Active"
FROM cust_v
""")
def normalize_columns_q(spark, sf_dir):
    """Loader column names: space/hyphen -> '_', parentheses dropped."""
    return normalize_columns(_customers(spark, sf_dir))


@register("fill_missing", f"""
WITH {CUST_V}
SELECT "Customer Key" AS "Customer_Key", COALESCE("Customer-Name", 'NULL') AS "Customer_Name",
       "Nation Key" AS "Nation_Key",
       CASE WHEN "Account Balance (USD)" = 'NA' THEN 'NULL' ELSE "Account Balance (USD)" END AS "Account_Balance_USD",
       COALESCE("Market Segment", 'NULL') AS "Market_Segment", COALESCE("Active", 'NULL') AS "Active"
FROM cust_v
""")
def fill_missing_q(spark, sf_dir):
    """Missing values (NULL or a missing token such as NA) -> text NULL."""
    return fill_missing(normalize_columns(_customers(spark, sf_dir)))


#: dataset -> (oracle view, columns); what each column is follows from its values.
_VIEWS = {
    "ncr_ride_bookings": ("ord_v", ["Booking ID", "Customer ID", "Booking Status", "Booking Value", "Date",
                                    "Priority (Level)"]),
    CUSTOMERS: ("cust_v", ["Customer Key", "Customer-Name", "Nation Key", "Account Balance (USD)", "Market Segment",
                           "Active"]),
    "parts": ("part_v", ["Part Key", "Name", "Brand", "Type", "Size", "Retail Price", "Promo"]),
    "regions": ("region", ["r_regionkey", "r_name"]),
    "nations": ("nation", ["n_nationkey", "n_name", "n_regionkey"]),
    "suppliers": ("supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]),
}
_MISSING_SQL = ", ".join(f"'{t}'" for t in MISSING_TOKENS)


def _infer_row(ds, view, i, col):
    return f"""
SELECT '{ds}' AS dataset, {i} AS ordinal, '{col}' AS column_name, '{normalize_name(col)}' AS table_column,
       CASE kind WHEN 'text' THEN 'VARCHAR(' || least(2 * w, 1000) || ')' WHEN 'none' THEN 'VARCHAR(255)'
            WHEN 'number' THEN 'DECIMAL(15,4)' WHEN 'bool' THEN 'BOOLEAN' ELSE 'INTEGER' END AS sql_type,
       CASE kind WHEN 'int' THEN 'int' WHEN 'long' THEN 'bigint' WHEN 'number' THEN 'decimal(15,4)'
            WHEN 'bool' THEN 'boolean' ELSE 'string' END AS spark_type,
       CASE WHEN kind IN ('int', 'long') THEN 'int64' WHEN kind = 'number' THEN 'float64' WHEN kind = 'bool' THEN 'bool'
            ELSE 'object' END AS pandas_dtype
FROM (SELECT w, CASE WHEN n = 0 THEN 'none' WHEN p = 0 THEN 'number'
             WHEN ints = p THEN CASE WHEN p < n THEN 'number' WHEN small = p THEN 'int' ELSE 'long' END
             WHEN nums = p THEN 'number' WHEN bools = n THEN 'bool' ELSE 'text' END AS kind
      FROM (SELECT count(*) AS n, count(x) AS p,
                   count(TRY_CAST(x AS BIGINT)) FILTER (regexp_full_match(x, '[+-]?[0-9]+')) AS ints,
                   count(TRY_CAST(x AS INTEGER)) FILTER (regexp_full_match(x, '[+-]?[0-9]+')) AS small,
                   count(TRY_CAST(x AS DOUBLE)) AS nums,
                   count(*) FILTER (x IN ('True', 'TRUE', 'true', 'False', 'FALSE', 'false')) AS bools,
                   greatest(max(length(x)), CASE WHEN count(x) < count(*) THEN 3 ELSE 0 END) AS w
            FROM (SELECT CASE WHEN v NOT IN ({_MISSING_SQL}) THEN v END AS x
                  FROM (SELECT CAST("{col}" AS VARCHAR) AS v FROM {view}))))"""


@register("infer_types", f"WITH {CSV_VIEWS}\n" + "\nUNION ALL ".join(
    _infer_row(ds, view, i + 1, c) for ds, (view, cols) in _VIEWS.items() for i, c in enumerate(cols)))
def infer_types_q(spark, sf_dir):
    """Column types of all six CSV datasets from one aggregate job."""
    root = csv_root(spark, sf_dir)
    frames = {ds: read_csv_dataset(spark, f"{root}/{ds}.csv") for ds in CSV_DATASETS}
    return types_frame(spark, infer_types_many(frames))


_DECLARED = [ColumnType("Booking ID", "INTEGER", "int", "int64"),
             ColumnType("Booking Status", "BOOLEAN", "boolean", "bool"),
             ColumnType("Booking Value", "DECIMAL(7,2)", "decimal(7,2)", "float64"),
             ColumnType("Date", "VARCHAR(255)", "string", "object"),
             ColumnType("Priority (Level)", "INTEGER", "int", "int64")]


@register("cast_failures", f"""
WITH {ORD_V}
SELECT 'Booking ID' AS column_name, 'INTEGER' AS sql_type,
       count(*) FILTER (TRY_CAST("Booking ID" AS INTEGER) IS NULL) AS failures FROM ord_v
UNION ALL SELECT 'Booking Status', 'BOOLEAN', count(*) FILTER ("Booking Status" NOT IN
       ('True', 'TRUE', 'true', 'False', 'FALSE', 'false')) FROM ord_v
UNION ALL SELECT 'Booking Value', 'DECIMAL(7,2)', count(*) FILTER ("Booking Value" <> 'NULL'
       AND TRY_CAST("Booking Value" AS DECIMAL(7,2)) IS NULL) FROM ord_v
UNION ALL SELECT 'Date', 'VARCHAR(255)', count(*) FILTER (false) FROM ord_v
UNION ALL SELECT 'Priority (Level)', 'INTEGER', count(*) FILTER ("Priority (Level)" IS NOT NULL
       AND TRY_CAST("Priority (Level)" AS INTEGER) IS NULL) FROM ord_v
""")
def cast_failures_q(spark, sf_dir):
    """Values of a dataset that the declared column types reject."""
    return cast_failures(read_csv_dataset(spark, f"{csv_root(spark, sf_dir)}/ncr_ride_bookings.csv"), _DECLARED)


@register("string_widths", f"WITH {CUST_V}\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(max(length(\"{c}\")) AS INTEGER) AS max_length FROM cust_v"
    for c in ("Customer Key", "Customer-Name", "Nation Key", "Account Balance (USD)",
              "Market Segment", "Active")))
def string_widths_q(spark, sf_dir):
    """Longest text per column of a CSV dataset."""
    return string_widths(_customers(spark, sf_dir))


@register("typed_load", f"WITH {CUST_V}\nSELECT {CUST_TYPED} FROM cust_v")
def typed_load_q(spark, sf_dir):
    """CSV text -> inferred types (missing -> NULL for numbers, text NULL
    for strings), loader column names."""
    return typed_load(_customers(spark, sf_dir))


@register("surrogate_ids", """
SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey, o_custkey, o_totalprice FROM orders
""")
def surrogate_ids_q(spark, sf_dir):
    """Contiguous ids 1..n in key order without a global window."""
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return surrogate_ids(orders, fresh(spark, "surrogate_ids"), order_by=["o_orderkey"])


@register("table_replace", f"""
WITH {CUST_V}
SELECT row_number() OVER (ORDER BY k) AS id, {CUST_TYPED} FROM cust_v
""")
def table_replace(spark, sf_dir):
    """CSV dataset -> typed table ``business_<name>`` with ids in input
    order and audit columns, replacing any earlier table; read back."""
    text = _customers(spark, sf_dir, with_position=True)
    typed = typed_load(text, infer_types(text), keep=("_src_file", "_src_block", "_src_row"))
    with_ids = surrogate_ids(typed, fresh(spark, "table_replace_stage"))
    warehouse = fresh(spark, "warehouse")
    path = replace_table(add_audit_columns(with_ids), warehouse, business_table(CUSTOMERS))
    table = spark.read.parquet(path)
    return table.where(F.col("created_at").isNotNull() & F.col("updated_at").isNotNull()) \
        .drop("created_at", "updated_at")


@register("table_swap", f"""
WITH {CUST_V}, typed AS (SELECT row_number() OVER (ORDER BY k) AS id, {CUST_TYPED} FROM cust_v)
SELECT 'before' AS reader, "Customer_Key", "Nation_Key" FROM typed
UNION ALL SELECT 'after', "Customer_Key", NULL FROM typed WHERE "Nation_Key" < 10
""")
def table_swap(spark, sf_dir):
    """A table replaced while it is read: a reader from before the swap goes on
    with the old rows, one from after it gets the new rows and columns."""
    typed = typed_load(_customers(spark, sf_dir))
    warehouse = fresh(spark, "swap")
    name = f"{business_table(CUSTOMERS)}_{warehouse.rsplit('/', 1)[-1]}"
    swap_table(typed, warehouse, name)
    before = spark.table(name).select(F.lit("before").alias("reader"), "Customer_Key", "Nation_Key")
    swap_table(spark.table(name).where("Nation_Key < 10").select("Customer_Key"), warehouse, name)
    after = spark.table(name).select(F.lit("after").alias("reader"), "*", F.lit(None).cast("int").alias("Nation_Key"))
    spark.sql(f"DROP VIEW `{name}`")
    return before.unionByName(after)


_RS_COLS = [("Customer Key", '"Customer Key"'), ("Customer-Name", "COALESCE(\"Customer-Name\", 'NULL')"),
            ("Nation Key", '"Nation Key"'),
            ("Account Balance (USD)", "CASE WHEN \"Account Balance (USD)\" = 'NA' THEN 'NULL' "
                                      "ELSE \"Account Balance (USD)\" END"),
            ("Market Segment", "COALESCE(\"Market Segment\", 'NULL')"),
            ("Active", "COALESCE(\"Active\", 'NULL')")]
_RS = f"{CUSTOMERS}.csv"


def _rs_name(c: str) -> str:
    return normalize_name(f"{_RS}/{c.replace(' ', '+')}", lowercase=True)


@register("recordset_ingest", f"WITH {CUST_V}\nSELECT " + ", ".join(
    f'{e} AS "{_rs_name(c)}"' for c, e in _RS_COLS) + " FROM cust_v")
def recordset_ingest(spark, sf_dir):
    """A record set (fields named ``<set>/<Field+Name>``) -> lower-case
    normalised names -> missing filled with NULL -> CSV file named after the
    set; read back."""
    rs = _record_set(customer_view(load(spark, sf_dir, "customer")), _RS)
    return read_csv_dataset(spark, write_record_sets({_RS: rs}, fresh(spark, "data"))[_RS])


def _record_set(df, name):
    return df.toDF(*[f"{name}/{c.replace(' ', '+')}" for c in df.columns])


@register("recordset_files", " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, count(*) AS rows FROM {table}" for name, (table, _, _) in CSV_DATASETS.items()))
def recordset_files(spark, sf_dir):
    """Every record set ingested into its own file, one without rows skipped:
    rows of each file written."""
    sets = {f"{name}.csv": _record_set(view(load(spark, sf_dir, table)), f"{name}.csv")
            for name, (table, _, view) in CSV_DATASETS.items()}
    sets["Empty Set.csv"] = sets["parts.csv"].where(F.lit(False))
    folder = fresh(spark, "record_sets")
    write_record_sets(sets, folder)
    return dataset_row_counts(spark, folder, "*.csv")


@register("csv_roundtrip", f"""
WITH {ORD_V}
SELECT "Booking ID", "Customer ID", "Booking Status", "Booking Value", "Date", "Priority (Level)" FROM ord_v
""")
def csv_roundtrip(spark, sf_dir):
    """Dataset -> CSV (header, no index) -> read back."""
    out = f"{fresh(spark, 'csv_roundtrip')}/ncr_ride_bookings.csv"
    write_csv_dataset(orders_view(load(spark, sf_dir, "orders")), out)
    return read_csv_dataset(spark, out)


@register("csv_text_roundtrip", f"WITH {NOTE_CTE} SELECT * FROM notes")
def csv_text_roundtrip(spark, sf_dir):
    """Texts with line breaks, quotes, delimiters, blanks, empty and missing values
    -> CSV -> read back as they were."""
    out = f"{fresh(spark, 'csv_text_roundtrip')}/notes.csv"
    write_csv_dataset(note_view(load(spark, sf_dir, "orders")), out)
    return read_csv_dataset(spark, out)


def _messy_csv(spark, sf_dir) -> str:
    return staged(spark, sf_dir, "csv_messy/order_lines.csv",
                  lambda: messy_lines(load_ordered(spark, sf_dir, "orders", "o_orderkey")), fmt="csv", options=RAW_LINES)


@register("csv_good_records", f"WITH {MESSY_CSV_CTE} SELECT \"Order Key\", \"Note\", \"Priority\" FROM messy WHERE reason IS NULL")
def csv_good_records(spark, sf_dir):
    """Well-formed records of a dataset that also holds ragged ones."""
    return good_records(read_csv_records(spark, _messy_csv(spark, sf_dir)))


@register("csv_bad_records", f"WITH {MESSY_CSV_CTE} SELECT 'order_lines' AS dataset, reason, bad AS text FROM messy WHERE reason IS NOT NULL")
def csv_bad_records(spark, sf_dir):
    """Records set aside, with their dataset, reason and text."""
    bad = bad_records(read_csv_records(spark, _messy_csv(spark, sf_dir)))
    return bad.select(dataset_from_path(F.col("file")).alias("dataset"), "reason", "text")


@register("csv_file_status", f"""
WITH {MESSY_CSV_CTE}
SELECT 'loaded' AS status, count(*) FILTER (reason IS NULL) AS rows, count(*) FILTER (reason IS NOT NULL) AS bad_rows FROM messy
UNION ALL SELECT 'unreadable', 0, 0 UNION ALL SELECT 'missing', 0, 0
""")
def csv_file_status(spark, sf_dir):
    """Files by status, with the records they gave: the dataset's own files, one
    that is no gzip file, and one that is not there."""
    path = _messy_csv(spark, sf_dir)
    broken = f"{fresh(spark, 'csv_file_status')}/broken.csv.gz"
    touch(spark, broken, b"this is no gzip file")
    records = read_csv_records(spark, [path, broken], columns=["Order Key", "Note", "Priority"])
    status = file_status(spark, [path, broken, f"{broken}.missing"], records)
    return status.where("status <> 'empty'").groupBy("status").agg(F.sum("rows").alias("rows"), F.sum("bad_rows").alias("bad_rows"))


@register("json_produce", "SELECT * FROM customer")
def json_produce(spark, sf_dir):
    """Rows -> JSON message values on a wire table -> read and parsed back
    with the table's schema."""
    customer = load(spark, sf_dir, "customer")
    out = fresh(spark, "json_produce")
    produce_json(customer, PRODUCER_TOPIC).write.parquet(out)
    back = spark.read.parquet(out)
    return back.select(F.from_json(F.col("value").cast("string"), customer.schema).alias("r")) \
        .select("r.*")


@register("json_produce_messages", f"""
SELECT '{PRODUCER_TOPIC}' AS topic, '{{"c_custkey":' || c_custkey || '}}' AS key_text,
       '{{"id":' || c_custkey || ',"name":' || CASE WHEN c_custkey % 3 = 0 THEN 'null' ELSE '"' || c_name || '"' END
       || ',"segment":' || CASE WHEN c_custkey % 5 = 0 THEN 'null' ELSE '"' || c_mktsegment || '"' END || '}}' AS value_text
FROM customer
""")
def json_produce_messages(spark, sf_dir):
    """Produced messages as they stand on the topic: key, and the value with its
    null fields."""
    k = F.col("c_custkey")
    rows = load(spark, sf_dir, "customer").select(
        "c_custkey", F.struct(k.alias("id"), F.when(k % 3 != 0, F.col("c_name")).alias("name"),
                              F.when(k % 5 != 0, F.col("c_mktsegment")).alias("segment")).alias("m"))
    out = fresh(spark, "json_produce_messages")
    produce_json(rows, PRODUCER_TOPIC, key=["c_custkey"], value="m").write.parquet(out)
    return spark.read.parquet(out).select("topic", F.col("key").cast("string").alias("key_text"),
                                          F.col("value").cast("string").alias("value_text"))


TIME_LO, TIME_HI = "2024-01-10 00:00:00", "2024-01-12 00:00:00"


@register("time_range_lookup", f"""
WITH {EVENTS_CTE}
SELECT i AS id, op_code AS op, {TS_TEXT.format('ts')} AS created_at_ts,
       {TS_TEXT.format("ts + to_microseconds(updated_us - created_us)")} AS updated_at_ts,
       CASE WHEN i % 7 <> 0 THEN value END AS booking_value,
       CASE WHEN i % 11 <> 0 THEN CAST(user_id AS DOUBLE) / 10 END AS ride_distance
FROM ev WHERE NOT bad AND ts >= TIMESTAMP '{TIME_LO}' AND ts < TIMESTAMP '{TIME_HI}'
""")
def time_range_lookup(spark, sf_dir):
    """Lake table clustered on created_at; a time-range filter reads only
    the files and row groups whose min/max overlap the range."""
    def build():
        flat = flatten_changes(capture_wire(load(spark, sf_dir, "events")), typed_time=True,
                               processed_at=False)
        return cluster_by_time(flat, "created_at")
    path = staged(spark, sf_dir, "lake_by_time", build)
    table = spark.read.parquet(path)
    hit = (F.col("created_at") >= F.lit(TIME_LO).cast("timestamp")) & \
          (F.col("created_at") < F.lit(TIME_HI).cast("timestamp"))
    return table.where(hit).select("id", "op", "created_at_ts", "updated_at_ts", "booking_value",
                                   "ride_distance")


_TOTALS = """SELECT 6 AS total_datasets,
       (SELECT count(*) FROM orders) + (SELECT count(*) FROM customer) + (SELECT count(*) FROM part)
       + (SELECT count(*) FROM region) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM supplier)
       AS total_records,
       2 AS kaggle_datasets, 4 AS local_datasets, 1 AS missing_files"""


def _load_all(spark, sf_dir, extra=None):
    """Every dataset into its typed table; types of the well-formed ones from one job."""
    frames, missing = _all_frames(spark, sf_dir)
    types = infer_types_many(frames)
    known = {id(df): types[n] for n, df in frames.items()}
    return load_datasets(frames | (extra or {}), fresh(spark, "warehouse"),
                         tuple(f"{LOCAL_PREFIX}{p.rsplit('/', 1)[-1].removesuffix('.csv')}" for p in missing),
                         lambda df: add_audit_columns(typed_load(df, known.get(id(df)))))


@register("load_report", f"{_TOTALS}, 0 AS failed_datasets, false AS success")
def load_report_q(spark, sf_dir):
    """Datasets loaded, records, datasets by source, files not found, datasets that
    failed and the verdict, all from the load itself; the time is checked here."""
    report = load_report(spark, _load_all(spark, sf_dir))
    return report.where(F.col("timestamp").try_cast("timestamp").isNotNull()).drop("timestamp")


@register("load_status", """
SELECT 'ncr_ride_bookings' AS dataset, 'kaggle' AS source, 'loaded' AS status, count(*) AS rows, false AS has_error FROM orders
UNION ALL SELECT 'ncr_ride_bookings_customers', 'kaggle', 'loaded', count(*), false FROM customer
UNION ALL SELECT 'local_parts', 'local', 'loaded', count(*), false FROM part
UNION ALL SELECT 'local_regions', 'local', 'loaded', count(*), false FROM region
UNION ALL SELECT 'local_nations', 'local', 'loaded', count(*), false FROM nation
UNION ALL SELECT 'local_suppliers', 'local', 'loaded', count(*), false FROM supplier
UNION ALL SELECT 'local_order_lines', 'local', 'failed', 0, true
UNION ALL SELECT 'local_missing', 'local', 'missing', 0, false
""")
def load_status_q(spark, sf_dir):
    """What became of each dataset, one with ragged records among them."""
    ragged = read_csv_dataset(spark, _messy_csv(spark, sf_dir))
    loads = _load_all(spark, sf_dir, {f"{LOCAL_PREFIX}order_lines": ragged})
    return load_status(spark, loads).select("dataset", "source", "status", "rows", F.col("error").isNotNull().alias("has_error"))


_PROFILE_EXPECT = {
    "ncr_ride_bookings": ("orders", "ord_v", [("Booking ID", "int64"), ("Customer ID", "int64"),
                          ("Booking Status", "object"), ("Booking Value", "float64"), ("Date", "object"),
                          ("Priority (Level)", "object")], "kaggle"),
    CUSTOMERS: ("customer", "cust_v", [("Customer Key", "int64"), ("Customer-Name", "object"),
                ("Nation Key", "int64"), ("Account Balance (USD)", "float64"),
                ("Market Segment", "object"), ("Active", "object")], "kaggle"),
    "local_parts": ("part", "part_v", [("Part Key", "int64"), ("Name", "object"), ("Brand", "object"),
                    ("Type", "object"), ("Size", "int64"), ("Retail Price", "float64"),
                    ("Promo", "bool")], "local"),
    "local_regions": ("region", "region", [("r_regionkey", "int64"), ("r_name", "object")], "local"),
    "local_nations": ("nation", "nation", [("n_nationkey", "int64"), ("n_name", "object"),
                      ("n_regionkey", "int64")], "local"),
    "local_suppliers": ("supplier", "supplier", [("s_suppkey", "int64"), ("s_name", "object"),
                        ("s_nationkey", "int64"), ("s_acctbal", "float64")], "local"),
}
_WIDTH = {"int64": 8, "float64": 8, "bool": 1}


def _profile_sql(with_meta: bool) -> str:
    parts = []
    for ds, (_, view, cols, source) in _PROFILE_EXPECT.items():
        size = " + ".join(f"{_WIDTH[t]} * count(*)" if t in _WIDTH else f'coalesce(sum(strlen("{c}")), 0)'
                          for c, t in cols)
        names = json.dumps([c for c, _ in cols], separators=(",", ":"))
        dtypes = json.dumps({c: t for c, t in cols}, separators=(",", ":"))
        meta = (f"count(*) AS rows, {len(cols)} AS columns, '{names}' AS column_names, "
                f"'{dtypes}' AS data_types, " if with_meta else "")
        tail = f", '{source}' AS source" if with_meta else ""
        parts.append(f"SELECT '{ds}' AS dataset, {meta}CAST({size} AS BIGINT) AS memory_usage{tail} FROM {view}")
    return f"WITH {CSV_VIEWS}\n" + "\nUNION ALL ".join(parts)


@register("dataset_profile", _profile_sql(True))
def dataset_profile(spark, sf_dir):
    """Per dataset: rows, column count and names, inferred dtypes, data
    bytes and source; one aggregate job for all."""
    frames, _ = _all_frames(spark, sf_dir)
    return profiles_frame(spark, profile_datasets(frames))


@register("dataset_bytes", _profile_sql(False))
def dataset_bytes(spark, sf_dir):
    """Data bytes per dataset: fixed width for numbers and booleans, UTF-8
    bytes for text."""
    frames, _ = _all_frames(spark, sf_dir)
    return profiles_frame(spark, profile_datasets(frames)).select("dataset", "memory_usage")


@register("report_json", _profile_sql(True))
def report_json(spark, sf_dir):
    """The per-dataset report, nested and with its time, written as JSON lines
    and read back (list and map shown as JSON text)."""
    frames, _ = _all_frames(spark, sf_dir)
    report = report_rows(profiles_frame(spark, profile_datasets(frames)))
    out = fresh(spark, "report_json")
    write_json_report(report, out)
    back = spark.read.schema(report.schema).json(out).where(F.col("timestamp").isNotNull()).drop("timestamp")
    return back.withColumns({c: F.to_json(c) for c in ("column_names", "data_types")})
