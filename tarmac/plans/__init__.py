"""Jobs: read inputs, apply operators, write outputs."""
