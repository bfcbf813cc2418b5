"""Every operator as a query on the given parquet tables, with the same query in SQL."""
