"""City analytics on Spark: scans, cleaning, zoning, daily marts, serving and live state."""
