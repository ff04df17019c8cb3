"""The silver operators on file streams."""
