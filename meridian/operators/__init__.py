"""meridian.operators."""
