"""The score job over arriving files."""
