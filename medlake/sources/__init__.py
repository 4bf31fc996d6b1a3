"""File-lake sources, sinks and seeded table generation."""
