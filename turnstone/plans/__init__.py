"""Fixtures, whole plans and the registered queries."""
