"""User-level queries that chain the operators."""
