"""Batch jobs that clean landed files into typed tables."""
