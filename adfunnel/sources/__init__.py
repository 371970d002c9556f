"""Sources and sinks: fixture views, TSV load/dump, dimension load, tables."""
