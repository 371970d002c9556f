"""Jobs: hourly ingest, daily funnel build, and the table lifecycle."""
