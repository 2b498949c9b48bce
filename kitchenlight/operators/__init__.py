"""Reusable table operators."""
