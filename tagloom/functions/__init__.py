"""Reusable column expressions and row filters."""
