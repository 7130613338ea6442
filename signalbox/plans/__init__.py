"""Composed jobs: batch analysis, detection, report, and the query catalog."""
