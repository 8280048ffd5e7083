"""Data-quality checks. Each returns the failing rows."""
