"""Landing zone, seeds, assembled items and versioned tables."""
