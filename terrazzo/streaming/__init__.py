"""Append-only experiment logs as streams."""
