"""Monitoring of predictions and requests, in batch form and on streams."""
