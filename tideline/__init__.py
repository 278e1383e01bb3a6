"""tideline: a Spark-native change-data pipeline.

Batch and streaming share one set of DataFrame transformations built from
``pyspark.sql.functions`` only.  Sub-packages:

* ``sources``   - topic (Kafka or wire-table) readers, CSV dataset scans
* ``functions`` - Column -> Column helpers (cleaning, time, JSON kinds, names)
* ``operators`` - DataFrame -> DataFrame operators (flatten, validate, capture,
  offsets, schema shaping, profiling, surrogate ids)
* ``streaming`` - Structured Streaming jobs and sinks
* ``plans``     - the registered queries, their derived inputs and SQL oracles
"""

__version__ = "0.1.0"
