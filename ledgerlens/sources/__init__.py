"""Readers, writers, the schema catalogue and the model registry."""
