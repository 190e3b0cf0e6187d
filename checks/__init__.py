"""Registered queries over the generated tables, each next to its SQL."""
