"""Whole jobs: SQL features, model search, and the registered queries."""
