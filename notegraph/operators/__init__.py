"""notegraph.operators."""
