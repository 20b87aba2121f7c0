"""Sources and sinks: JDBC, CSV/parquet files, versioned snapshot tables."""
