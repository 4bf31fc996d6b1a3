"""Plan-level helpers (skew, bounds, durable cuts) and the composed jobs."""
