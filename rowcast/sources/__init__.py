"""Delimited files and model folders."""
