"""notegraph.functions."""
