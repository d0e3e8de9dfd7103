"""daybook: daily regional analytics on Spark DataFrames.

Subpackages
-----------
sources    scans and sinks (JSON lines, CSV, Parquet, catalog tables)
functions  column helpers built from Spark built-ins
operators  filters, joins, aggregates, fills, reshaping, report layouts
plans      the stages of the daily regional roll-up, the analysis questions and
           the registered queries with their SQL oracles
"""

__version__ = "0.1.0"
