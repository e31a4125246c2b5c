"""notegraph: note-corpus analytics as composable PySpark DataFrame operators."""
