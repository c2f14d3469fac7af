"""Operators on the event log and on the session and user tables."""
