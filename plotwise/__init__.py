"""Property-assessment analytics as PySpark DataFrame operators."""
