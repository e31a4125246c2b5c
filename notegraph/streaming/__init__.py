"""notegraph.streaming."""
