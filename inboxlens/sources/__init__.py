"""Readers, connector option builders and the test-table adapter."""
