"""Column-level helpers; every one of them stays inside Spark expressions."""
