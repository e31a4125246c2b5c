"""notegraph.plans."""
