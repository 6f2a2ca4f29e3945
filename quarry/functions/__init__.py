"""quarry.functions."""
