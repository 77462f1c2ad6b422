"""Registered queries and, next to each, the same result as plain SQL for another engine."""
