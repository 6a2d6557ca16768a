"""Registry tables: schemas, Parquet/JDBC readers, fixture views, landed-file inventory."""
