"""General DataFrame operators."""
