"""Registry dumps to analysis-ready tables, as plain PySpark DataFrame operators."""
