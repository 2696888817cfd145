"""Readers, writers and the binding of the sample tables to the canonical schemas."""
