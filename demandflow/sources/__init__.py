"""Sources and sinks: driver parquet tables, the observations view, CSV/JSON files."""
