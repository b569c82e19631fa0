"""meridian.sources."""
