"""Operators of a large-scale training-data pipeline.

Every module holds one operator with its own general interface; ``queries``
registers the thin ``opN_*`` queries.  Nothing else in the library imports
this subpackage.
"""
