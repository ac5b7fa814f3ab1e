"""Training-data operators: formatting, filtering, deduplication, encoding.

Each module holds one operator with its own general interface; ``queries``
registers the thin driver queries.  Nothing else in the library imports
this subpackage.
"""
