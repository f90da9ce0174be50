"""Queries and pipelines composed from the operators."""
