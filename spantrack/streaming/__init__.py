"""Tracks over arriving alignments."""
