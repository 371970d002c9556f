"""adfunnel: advertising event logs on Spark.

Cleans raw bid / impression / click events, derives URL, IP and date columns,
loads them hour by hour into a partitioned event table, and stitches the events
that share an exposure id into one funnel row per exposure and time slot.

Everything is written with DataFrame / Spark SQL built-ins; the functions take
and return DataFrames so Catalyst sees one declarative plan per job.

Parts: ``functions`` (Column expressions), ``operators`` (slot assignment,
funnel, membership, profiles), ``sources`` (fixture views, TSV, SSP list,
tables), ``plans`` (ingest, daily build, lifecycle), ``streaming`` (hourly
ingest as a stream), ``queries`` / ``oracle`` (registered queries and their
DuckDB SQL), ``cli`` (command line).
"""

__all__ = ["cli", "functions", "operators", "oracle", "plans", "queries", "schema", "session",
           "sources", "streaming"]
