"""Sources (CSV / parquet tables, policy, driver-table views) and sinks."""
