"""Training-data operators: mixing, counting, formatting, de-duplication, scans and filters.

Nothing else in the library imports this subpackage.
"""
