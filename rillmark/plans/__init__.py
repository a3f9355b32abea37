"""Runs that combine operators, and the registered queries."""
