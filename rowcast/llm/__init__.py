"""Operators of a large-scale training-data pipeline (one module each).

Import the modules directly, e.g. ``from rowcast.llm import simhash``.
Nothing outside this subpackage imports it.
"""
