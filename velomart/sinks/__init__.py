"""Writers: partitioned Parquet mart, report tables, JDBC."""
