"""The jobs, as functions and from the command line."""
