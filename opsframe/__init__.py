"""opsframe: fleet-operations analytics on Spark DataFrames.

Sub-packages: ``sources`` (tables, files, role views), ``functions`` (column
expressions), ``operators`` (filters, joins, aggregates, windows, sets, row
changes), ``plans`` (composite jobs), ``streaming`` (Structured Streaming
forms), ``driver`` (the registered queries and their DuckDB oracles).
"""

__version__ = "0.1.0"
