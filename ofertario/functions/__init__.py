"""Column helpers: JSON access, scalar rules, keys and labels."""
