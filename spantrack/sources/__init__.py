"""Readers, writers and views."""
