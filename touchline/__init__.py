"""touchline: entity-level season statistics on Spark DataFrames.

Subpackages: ``functions`` (column helpers), ``operators`` (generic
DataFrame operators), ``sources`` (delimited files, tables, catalogue),
``plans`` (the query catalogue and its SQL oracles), ``streaming``
(incremental file ingest).
"""
