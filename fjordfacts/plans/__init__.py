"""Composed flows and the named queries."""
