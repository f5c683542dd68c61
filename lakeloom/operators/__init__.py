"""Operators with policy: duplicates, upserts, keys, running sums, cubes, models, checks."""
