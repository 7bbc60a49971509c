"""Whole passes as one logical plan each."""
