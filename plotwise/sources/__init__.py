"""Readers, writers and the deltas that are published from them."""
