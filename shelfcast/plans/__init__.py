"""Larger jobs composed from the operators."""
