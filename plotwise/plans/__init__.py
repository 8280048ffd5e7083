"""Domain tables composed from the operators."""
