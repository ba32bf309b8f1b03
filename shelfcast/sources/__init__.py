"""Readers, loaders and writers."""
