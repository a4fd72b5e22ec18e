"""florapipe.functions."""
