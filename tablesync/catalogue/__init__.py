"""Queries that exercise every operator on the given tables, and their oracle SQL."""
