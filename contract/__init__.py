"""The registered queries over the supplied tables, and their SQL twins."""
