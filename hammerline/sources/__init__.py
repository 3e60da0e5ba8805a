"""Readers: stored tables, web pages, literal seeds."""
