"""Column -> Column helpers built from pyspark.sql.functions only."""

from .cleaning import clean_byte_literal, to_double, is_missing, fill_missing_text
from .timefmt import micros_to_text, micros_to_timestamp, ts_to_micros
from .jsonkinds import add_validation, is_valid_reason
from .naming import (normalize_name, normalize_names, dataset_from_path,
                     table_name)

__all__ = [
    "clean_byte_literal", "to_double", "is_missing", "fill_missing_text",
    "micros_to_text", "micros_to_timestamp", "ts_to_micros",
    "add_validation", "is_valid_reason",
    "normalize_name", "normalize_names", "dataset_from_path",
    "table_name",
]
