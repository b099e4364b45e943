"""Operators for preparing training data: mixing, search, filtering, packing, archives,
scoring and near-duplicates. Nothing else in the library imports this subpackage."""
