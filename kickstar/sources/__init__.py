"""Sources and sinks: driver parquet tables, staging CSV with audit columns, table sinks."""
