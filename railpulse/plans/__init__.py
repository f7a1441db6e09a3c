"""Whole runs: read tables, apply operators, write tables."""
