"""tierwise.functions."""
