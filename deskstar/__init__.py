"""Service-desk and database-capacity warehouse built from Spark DataFrame operations."""
