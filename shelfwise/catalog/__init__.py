"""Named queries with their output contracts and their SQL checks."""
