"""Writers for fact, anomaly and window-statistics tables."""
