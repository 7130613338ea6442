"""Readers for the feed, reference dimensions and stored tables."""
