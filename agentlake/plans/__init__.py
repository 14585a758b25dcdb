"""Whole questions answered by several operators."""
