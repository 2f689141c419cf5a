"""Typed calls, NULL contract and settings, and the functions that do real table work."""
