"""Where the input tables come from: Parquet, JDBC, tuple text, or views over the sample data."""
