"""Writers: extracts, daily metrics, period metrics."""
