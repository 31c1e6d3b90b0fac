"""Delimited files and snapshot tables."""
