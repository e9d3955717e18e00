"""tierwise.sources."""
