"""End-to-end builds and the registered query catalogue."""
