"""Column-level building blocks: money, hashing, special functions."""
