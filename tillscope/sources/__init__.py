"""Readers of purchase lines, country names and address blocks."""
