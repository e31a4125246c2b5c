"""notegraph.sources."""
