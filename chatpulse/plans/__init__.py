"""Whole branches, put together from the operators."""
