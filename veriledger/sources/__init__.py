"""Feeds, reference tables, run tables and generated data."""
