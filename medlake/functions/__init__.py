"""Column-level building blocks (native expressions) and small per-batch helpers."""
