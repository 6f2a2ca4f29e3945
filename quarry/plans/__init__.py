"""quarry.plans."""
