"""The streaming forms of landing loads and run alerts."""
