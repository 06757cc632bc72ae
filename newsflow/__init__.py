"""News-article analytics as PySpark DataFrame operators."""
