"""folioflow: the life cycle of a large document corpus as composable PySpark jobs."""
