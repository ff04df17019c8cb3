"""Reading feeds and reading and writing tables."""
