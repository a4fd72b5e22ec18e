"""florapipe.operators."""
