"""Whole jobs: dashboard queries over rollups, bulk load, synthetic data."""
