"""Interval signal analytics on Spark: fragments, binned tracks, scaling factors, ratios."""
