"""Reusable plan shapes: exact quantiles, running totals, nearest neighbours, the derived profile."""
