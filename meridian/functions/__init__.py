"""meridian.functions."""
