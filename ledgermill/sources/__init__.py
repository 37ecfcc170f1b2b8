"""Readers, sinks and the mapping from the test tables to raw finance tables."""
