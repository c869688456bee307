"""Operators for preparing training data: search, packing, joins, extraction, mixing, sharding."""
