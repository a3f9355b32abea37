"""Readers for change logs, metric samples, alert events and the catalog."""
