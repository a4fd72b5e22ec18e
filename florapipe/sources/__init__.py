"""florapipe.sources."""
