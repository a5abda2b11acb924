"""Readers and writers of the partitioned lake layout."""
