"""Writers: CSV at the edges, Parquet between stages, JDBC for publishing."""
