"""Operators on managed tables: store, load, views and the run log."""
