"""Input scans: driver tables, landed market records, delimited/JSON/parquet files."""
