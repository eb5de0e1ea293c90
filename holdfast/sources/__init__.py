"""Readers, writers, the governed SQL entry point and the sample-table adapter."""
