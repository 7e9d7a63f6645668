"""Sources and sinks: task files, the Parquet store, export publication."""
