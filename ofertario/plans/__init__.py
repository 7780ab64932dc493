"""End-to-end builds composed from the operators."""
