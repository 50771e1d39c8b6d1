"""ledgerlake: a Spark-native library for medallion invoicing warehouses.

Sub-packages
------------
functions  pure ``Column`` helpers (text, numeric, dates, casts)
sources    readers: parquet / JDBC / CSV / typed seeds, run-mode registry, calendar
operators  ``DataFrame -> DataFrame`` transforms, dedup, joins, merges, keys, quality
plans      the layered models (silver, gold, marts, bronze loads) and driver queries
streaming  micro-batch incremental loads (file stream -> foreachBatch merge)
"""

__version__ = "0.1.0"
