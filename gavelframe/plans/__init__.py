"""Whole runs: read, transform, write. Each returns the counters of its run."""
