"""florapipe.streaming."""
