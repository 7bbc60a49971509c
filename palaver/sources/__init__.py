"""Landed files."""
