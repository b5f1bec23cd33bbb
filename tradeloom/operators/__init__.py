"""DataFrame operators: sliding windows, block scans, cooldown, band joins, detectors, features, forest."""
