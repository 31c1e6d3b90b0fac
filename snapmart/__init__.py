"""Snapshot-partitioned credit-risk datamart, built from DataFrame transformations."""
