"""meridian.plans."""
