"""Bank reporting marts as PySpark DataFrame operators."""
