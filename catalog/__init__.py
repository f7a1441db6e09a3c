"""Queries over the driver's tables: inputs shaped from them, and checks in SQL."""
