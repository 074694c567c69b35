"""Business-registry extracts to scored leads, as PySpark DataFrame operators."""
